"""Vocabularies, tuning parameters and naming rules users rely on."""

# Default vocabulary. Its order is meaningful: a tag's position is its coordinate.
PROGRAMMING_LANGUAGES = (
    "JavaScript", "Java", "PHP", "Python", "C#", "C++", "Ruby", "CSS",
    "Objective-C", "Perl", "Scala", "Haskell", "MATLAB", "Clojure", "Groovy",
)

# Clustering parameters.
TAG_SPREAD = 50000
SMALL_SPREAD = 500
CLUSTERS = 45
ETA = 20.0
MAX_UPDATES = 120
SAMPLE_SEED = 42

# Article line layout: 14 characters, title, marker, text, 16 characters.
ARTICLE_PREFIX_CHARS = 14
ARTICLE_SUFFIX_CHARS = 16
ARTICLE_MARKER = "</title><text>"

# Activity groups by column name prefix; the first group that matches wins.
ACTIVITY_GROUPS = {
    "primaryNeeds": ("t01", "t03", "t11", "t1801", "t1803"),
    "work": ("t05", "t1805"),
    "other": (
        "t02", "t04", "t06", "t07", "t08", "t09", "t10",
        "t12", "t13", "t14", "t15", "t16", "t18",
    ),
}
