"""The same queries as plain SQL over the same tables, for an independent engine."""

from __future__ import annotations

import math

from loomtally.functions.ordering import PRIME
from loomtally.plans import catalog as K, views as V

SAMPLE_SEED = 42


def _strings(values) -> str:
    return "[" + ", ".join(f"'{value}'" for value in values) + "]"


def _order(key: str, seed: str) -> str:
    """Seeded order of a non-negative key."""
    folded = f"({key} % {PRIME} + xor({key}, {key} >> 31) % 65521)"
    first = f"(({folded} + {seed} % {PRIME}) * 48271 % {PRIME})"
    mixed = f"((xor({first}, {first} >> 13) * 69621 + 374761393) % {PRIME})"
    return f"((xor({mixed}, {mixed} >> 16) * 39373 + 668265263) % {PRIME})"


def _position(tag: str, vocabulary) -> str:
    return f"greatest(coalesce(list_position({_strings(vocabulary)}, {tag}), 0) - 1, 0)"


# --- terms ---------------------------------------------------------------------------

HITS = f"""
hits AS (
  SELECT v.term, d.doc_id
  FROM documents d, (SELECT unnest({_strings(V.DOCUMENT_TERMS)}) AS term) v
  WHERE list_contains(string_split(d.text, ' '), v.term)
)"""
RANKING = f"WITH {HITS} SELECT term, count(*) AS n FROM hits GROUP BY term"

LINE = (
    f"concat('{V.LINE_PREFIX}', CAST(doc_id AS VARCHAR), '</title><text>', text, '{V.LINE_SUFFIX}')"
)

# --- questions and clusters ----------------------------------------------------------


def _postings(offset: int = 0) -> str:
    return f"""
asked AS (
  SELECT o_orderkey AS id, o_orderpriority AS tags, CAST(o_custkey % 100 AS INTEGER) AS score FROM orders
),
replied AS (
  SELECT l_orderkey * 10 + l_linenumber AS id, coalesce(l_orderkey, 0) AS parent_id,
         CAST(trunc(l_quantity) AS INTEGER) + {offset} AS score
  FROM lineitem
),
postings AS (
  SELECT 1 AS posting_type, o_orderkey AS id, CAST(NULL AS BIGINT) AS accepted_answer,
         CAST(NULL AS BIGINT) AS parent_id, CAST(o_custkey % 100 AS INTEGER) AS score,
         o_orderpriority AS tags
  FROM orders
  UNION ALL
  SELECT 2, l_orderkey * 10 + l_linenumber, NULL, l_orderkey,
         CAST(trunc(l_quantity) AS INTEGER) + {offset}, NULL
  FROM lineitem
),
pairs AS (
  SELECT q.id AS qid, q.tags, q.score AS question_score,
         a.id AS answer_id, a.score AS answer_score
  FROM asked q JOIN replied a ON q.id = a.parent_id
),
scored AS (
  SELECT qid AS id, tags, question_score AS score,
         CAST(greatest(0, max(answer_score)) AS INTEGER) AS high_score
  FROM pairs GROUP BY qid, tags, question_score
)"""


def _vectors(vocabulary=V.PRIORITIES) -> str:
    return f"""{_postings()},
vectors AS (
  SELECT id, CAST({_position('tags', vocabulary)} * {K.SPREAD} AS INTEGER) AS x,
         high_score AS y
  FROM scored
)"""


STRATIFIED = f"""
drawn AS (
  SELECT id, x, y FROM (
    SELECT *, row_number() OVER (PARTITION BY x ORDER BY {_order('id', 'x')}, id) AS rn
    FROM vectors)
  WHERE rn <= {K.QUOTA}
)"""

START = f"""{_vectors()},{STRATIFIED},
seeds AS (
  SELECT CAST(row_number() OVER (ORDER BY x, y) - 1 AS INTEGER) AS cluster, x, y FROM drawn
),
points AS (SELECT x, y, count(*) AS w FROM vectors GROUP BY x, y)"""


def _assigned(points: str, centers: str, keep: str) -> str:
    """Rows with the nearest centre, the lowest index on equal distance."""
    distance = "(CAST(x AS DOUBLE) - cx) ** 2 + (CAST(y AS DOUBLE) - cy) ** 2"
    return f"""
  SELECT {keep}, cluster FROM (
    SELECT p.*, c.cluster, row_number() OVER (PARTITION BY {keep}
             ORDER BY {distance}, c.cluster) AS nearness
    FROM {points} p, (SELECT cluster, x AS cx, y AS cy FROM {centers}) c)
  WHERE nearness = 1"""


STEP = f"""
step AS (
  SELECT cluster, CAST(sum(x * w) // sum(w) AS INTEGER) AS x,
         CAST(sum(y * w) // sum(w) AS INTEGER) AS y
  FROM ({_assigned('points', 'seeds', 'x, y, w')}) GROUP BY cluster
)"""

# One row per update: all centres as a list, and the shift that led to them.
LOOP = f"""
loop(update_no, means, shift) AS (
  SELECT 0, (SELECT list({{'x': x, 'y': y}} ORDER BY cluster) FROM seeds), CAST(1e18 AS DOUBLE)
  UNION ALL
  SELECT update_no + 1, moved,
         list_sum(list_transform(range(1, len(moved) + 1), lambda i:
           (CAST(moved[i].x AS DOUBLE) - means[i].x) ** 2
           + (CAST(moved[i].y AS DOUBLE) - means[i].y) ** 2))
  FROM (
    SELECT update_no, means,
           list_transform(range(1, len(means) + 1), lambda i: coalesce(
             list_filter(stepped, lambda s: s.cluster = i)[1].center, means[i])) AS moved
    FROM (
      SELECT update_no, means, list({{'cluster': c, 'center': center}}) AS stepped
      FROM (
        SELECT update_no, means, c,
               {{'x': CAST(sum(x * w) // sum(w) AS INTEGER),
                 'y': CAST(sum(y * w) // sum(w) AS INTEGER)}} AS center
        FROM (
          SELECT l.update_no, l.means, p.x, p.y, p.w,
                 list_position(
                   list_transform(l.means, lambda m: (CAST(p.x AS DOUBLE) - m.x) ** 2
                                              + (CAST(p.y AS DOUBLE) - m.y) ** 2),
                   list_min(list_transform(l.means, lambda m: (CAST(p.x AS DOUBLE) - m.x) ** 2
                                              + (CAST(p.y AS DOUBLE) - m.y) ** 2))) AS c
          FROM loop l, points p WHERE l.shift >= 20 AND l.update_no < 120)
        GROUP BY update_no, means, c)
      GROUP BY update_no, means)
  )
),
found AS (SELECT * FROM loop ORDER BY update_no DESC LIMIT 1),
centers AS (
  SELECT CAST(i - 1 AS INTEGER) AS cluster, means[i].x AS x, means[i].y AS y, update_no
  FROM (SELECT means, update_no, unnest(range(1, len(means) + 1)) AS i FROM found)
),
members AS ({_assigned('points', 'centers', 'x, y, w')})"""

HISTOGRAM = f"""
histogram AS (
  SELECT cluster, CAST(x // {K.SPREAD} AS INTEGER) AS tag_index, CAST(sum(w) AS BIGINT) AS n
  FROM members GROUP BY ALL
)"""

CLUSTERED = f"WITH RECURSIVE {START},{LOOP},{HISTOGRAM}"


def _report(percent: str) -> str:
    return f"""{CLUSTERED},
tops AS (
  SELECT cluster, tag_index, n, sum(n) OVER (PARTITION BY cluster) AS size,
         row_number() OVER (PARTITION BY cluster ORDER BY n DESC, tag_index) AS place
  FROM histogram
),
medians AS (
  SELECT cluster, CAST(trunc(quantile_cont(y, 0.5)) AS INTEGER) AS median_score
  FROM (SELECT cluster, y, unnest(range(w)) FROM members) GROUP BY cluster
)
SELECT cluster, {_strings(V.PRIORITIES)}[tag_index + 1] AS label,
       CAST({percent} AS DOUBLE) AS percent, CAST(size AS BIGINT) AS cluster_size, median_score
FROM tops JOIN medians USING (cluster) WHERE place = 1"""


# --- survey --------------------------------------------------------------------------

ACTIVITY = """
activity AS (
  SELECT concat(CAST(user_id AS VARCHAR), '-', CAST(CAST(ts AS DATE) AS VARCHAR)) AS tucaseid,
         CAST(user_id * 7 % 90 AS DOUBLE) / 2 + 14 AS teage,
         CAST(user_id % 5 + 1 AS DOUBLE) AS telfs,
         CAST(user_id % 2 + 1 AS DOUBLE) AS tesex,
         """ + ",\n         ".join(
    f"coalesce(CAST(sum(CAST(value AS DECIMAL(18,2))) FILTER (WHERE {rule}) AS DOUBLE), 0) AS {name}"
    for name, rule in V.ACTIVITIES.items()
) + """
  FROM events GROUP BY user_id, CAST(ts AS DATE)
)"""

HOURS = {
    "primaryNeeds": "(t010101 + t110101) / 60",
    "work": "(t050101 + t180501) / 60",
    "other": "(t020101 + t180201) / 60",
}
BUCKETS = """
       CASE WHEN telfs >= 1 AND telfs < 3 THEN 'working' ELSE 'not working' END AS working,
       CASE WHEN tesex = 1 THEN 'male' ELSE 'female' END AS sex,
       CASE WHEN teage >= 15 AND teage <= 22 THEN 'young'
            WHEN teage >= 23 AND teage <= 55 THEN 'active' ELSE 'elder' END AS age"""
EXACT_HOURS = ", ".join(f"{e} AS {m}" for m, e in HOURS.items())
ROUNDED_HOURS = ", ".join(f"round({e}, 6) AS {m}" for m, e in HOURS.items())


def _summary(hours: str) -> str:
    return f"{ACTIVITY},\nsummary AS (SELECT {BUCKETS}, {hours} FROM activity WHERE telfs <= 4)"


def _averages(digits: int) -> str:
    averages = ", ".join(f"round(avg({m}), {digits}) AS {m}" for m in HOURS)
    return f"""WITH {_summary(EXACT_HOURS)}
SELECT working, sex, age, {averages} FROM summary GROUP BY working, sex, age"""


LONG_FORM = " UNION ALL ".join(
    f"SELECT tucaseid, '{name}' AS column_name, '{group}' AS activity_group, "
    f"{name} AS minutes FROM activity"
    for name, group in {
        "t010101": "primaryNeeds", "t110101": "primaryNeeds", "t050101": "work",
        "t180501": "work", "t020101": "other", "t180201": "other",
    }.items()
)

FRAGMENTS = "fragments AS (SELECT l_orderkey AS k, l_linenumber AS pos, l_returnflag AS v FROM lineitem)"
CONCAT = f"WITH {FRAGMENTS} SELECT k, string_agg(v, '' ORDER BY pos, v) AS text FROM fragments GROUP BY k"

SQL: dict[str, str] = {
    "rank_combined": RANKING,
    "rank_from_index": f"""WITH {HITS}
SELECT term, CAST(sum(n) AS BIGINT) AS n
FROM (SELECT term, doc_id // {K.ID_SPAN} AS block, count(*) AS n FROM hits GROUP BY ALL)
GROUP BY term""",
    "rank_terms": f"""WITH {HITS}
SELECT v.term, count(h.doc_id) AS n
FROM (SELECT unnest({_strings(V.DOCUMENT_TERMS)}) AS term) v LEFT JOIN hits h ON h.term = v.term
GROUP BY v.term""",
    "inverted_index": f"WITH {HITS} SELECT term, doc_id FROM hits",
    "range_layout": f"WITH {HITS} SELECT term, doc_id FROM hits ORDER BY term, doc_id",
    "posting_blocks": f"""WITH {HITS}
SELECT term, doc_id // {K.ID_SPAN} AS block, min(doc_id) AS lo, max(doc_id) AS hi,
       CAST(count(DISTINCT doc_id) AS INTEGER) AS n, count(*) AS mentions
FROM hits GROUP BY term, doc_id // {K.ID_SPAN}""",
    "posting_intersect": f"""WITH {HITS}
SELECT doc_id FROM hits WHERE list_contains({_strings(K.MET_TERMS)}, term)
GROUP BY doc_id HAVING count(DISTINCT term) = {len(K.MET_TERMS)}""",
    "rank_from_lists": RANKING,
    "ordered_positions": """
SELECT l_suppkey, l_quantity, l_returnflag,
       row_number() OVER (ORDER BY l_returnflag, l_quantity, l_suppkey) AS position FROM lineitem""",
    "index_blocks": f"""WITH {HITS}
SELECT term, doc_id // {K.ID_SPAN} AS block, CAST(count(*) AS INTEGER) AS n_articles,
       string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY doc_id) AS articles
FROM hits GROUP BY term, doc_id // {K.ID_SPAN}""",
    "mention_count": """SELECT count(*) AS n FROM documents
WHERE list_contains(string_split(text, ' '), 'the')""",
    "mention_filter": """SELECT doc_id, CAST(doc_id AS VARCHAR) AS title, text FROM documents
WHERE list_contains(string_split(text, ' '), 'the')""",
    "mention_join": """
WITH vocabulary AS (SELECT DISTINCT unnest(string_split(text, ' ')) AS term FROM benchmark),
words AS (SELECT doc_id, unnest(list_distinct(string_split(text, ' '))) AS term FROM documents)
SELECT term, doc_id FROM words JOIN vocabulary USING (term)""",
    "phrase_join": f"""
WITH items AS (SELECT string_split(text, ' ') AS w FROM benchmark),
runs AS (SELECT w, m, unnest(range(1, len(w) - m + 2)) AS i FROM items, (SELECT unnest({list(K.PHRASE_WORDS)}) AS m)),
vocabulary AS (SELECT DISTINCT array_to_string(w[i : i + m - 1], ' ') AS term FROM runs),
split AS (SELECT doc_id, string_split(text, ' ') AS w FROM documents),
places AS (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM split, (SELECT unnest({list(K.PHRASE_WORDS)}) AS m)),
found AS (SELECT doc_id, array_to_string(w[i : i + m - 1], ' ') AS term FROM places)
SELECT term, doc_id, count(*) AS n FROM found JOIN vocabulary USING (term) GROUP BY term, doc_id""",
    "top_terms": f"{RANKING} ORDER BY n DESC, term LIMIT 3",
    "article_parse": f"""
WITH lines AS (SELECT doc_id, {LINE} AS line FROM documents),
marked AS (SELECT *, instr(line, '</title><text>') AS p FROM lines)
SELECT doc_id, substr(line, 15, p - 15) AS title,
       substr(line, p + 14, length(line) - p - 29) AS text FROM marked""",
    "posting_parse": f"WITH {_postings()} SELECT * FROM postings",
    "survey_file": _averages(1),
    "survey_files_mixed": _averages(1),
    "qa_join": f"WITH {_postings()} SELECT * FROM pairs",
    "qa_grouped": f"""WITH {_postings()}
SELECT qid, 0 AS block, CAST(count(*) AS INTEGER) AS n_pairs,
       string_agg(CAST(answer_id AS VARCHAR), ',' ORDER BY answer_id) AS answers
FROM pairs GROUP BY qid""",
    "nested_exists": f"""WITH {_postings()}
SELECT qid, 0 AS block, CAST(count(*) AS INTEGER) AS n_pairs,
       string_agg(CAST(answer_id AS VARCHAR), ',' ORDER BY answer_id) AS answers
FROM pairs WHERE qid = {K.NESTED_PARENT} GROUP BY qid""",
    "best_answer": f"""WITH {_postings(K.BELOW_ZERO)}
SELECT q.posting_type, q.id, q.accepted_answer, q.parent_id, q.score, q.tags, s.high_score
FROM postings q JOIN scored s ON q.posting_type = 1 AND q.id = s.id""",
    "tag_vectors": f"WITH {_vectors(K.KNOWN_TAGS)} SELECT id, x, y FROM vectors",
    "nearest_center": f"WITH {START} {_assigned('vectors', 'seeds', 'id, x, y')}",
    "nearest_center_table": """
WITH centers AS (
  SELECT p_partkey AS cluster, CAST(p_size AS INTEGER) AS cx, CAST(trunc(p_retailprice) AS INTEGER) % 100 AS cy FROM part),
points AS (
  SELECT o_orderkey AS id, CAST(o_custkey % 53 AS INTEGER) AS x, CAST(trunc(o_totalprice) AS INTEGER) % 103 AS y FROM orders),
places AS (SELECT DISTINCT x, y FROM points),
nearest AS (
  SELECT x, y, arg_min(cluster, ((CAST(x AS DOUBLE) - cx) ** 2 + (CAST(y AS DOUBLE) - cy) ** 2) * 1e9 + cluster) AS cluster
  FROM places, centers GROUP BY x, y)
SELECT id, x, y, CAST(cluster AS BIGINT) AS cluster FROM points JOIN nearest USING (x, y)""",
    "point_distance": f"""WITH {_vectors()}
SELECT id, x, y, (CAST(x AS DOUBLE) - {K.DISTANT_POINT[0]}) ** 2
       + (CAST(y AS DOUBLE) - {K.DISTANT_POINT[1]}) ** 2 AS sq_distance FROM vectors""",
    "kmeans_step": f"WITH {START},{STEP} SELECT cluster, x, y FROM step",
    "centroid_shift": f"""WITH {START},{STEP}
SELECT sum((CAST(a.x AS DOUBLE) - b.x) ** 2 + (CAST(a.y AS DOUBLE) - b.y) ** 2) AS shift
FROM seeds b JOIN step a USING (cluster)""",
    "kmeans": f"{CLUSTERED} SELECT cluster, x, y, CAST(update_no AS INTEGER) AS updates FROM centers",
    "kmeans_resumed": f"{CLUSTERED} SELECT cluster, x, y, CAST(update_no AS INTEGER) AS updates FROM centers",
    "kmeans_pruned": f"{CLUSTERED} SELECT cluster, x, y, CAST(update_no AS INTEGER) AS updates FROM centers",
    "cluster_histogram": f"{CLUSTERED} SELECT cluster, tag_index, n FROM histogram",
    "cluster_report": _report("n * 100.0 / size"),
    "cluster_report_intpct": _report("n // size * 100"),
    "group_median": f"""
SELECT l_suppkey, len(q) AS n, CAST((q[(len(q) + 1) // 2] + q[len(q) // 2 + 1]) // 2 AS INTEGER) AS median
FROM (SELECT l_suppkey, list_sort(list(CAST(trunc(l_quantity) AS INTEGER) + {K.BELOW_ZERO})) AS q
      FROM lineitem GROUP BY l_suppkey)""",
    "group_median_wide": """
SELECT l_suppkey, len(q) AS n, (q[(len(q) + 1) // 2] + q[len(q) // 2 + 1]) / 2 AS median
FROM (SELECT l_suppkey, list_sort(list(l_extendedprice)) AS q FROM lineitem GROUP BY l_suppkey)""",
    "fixed_sample": f"""WITH {_vectors()}
SELECT id, x, y FROM vectors ORDER BY {_order('id', str(SAMPLE_SEED))}, id LIMIT {K.CLUSTERS}""",
    "stratified_sample": f"WITH {_vectors()},{STRATIFIED} SELECT id, x, y FROM drawn",
    "stratified_sample_large": f"""
SELECT id, l_returnflag, l_quantity FROM (
  SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY {_order('id', str(K.LARGE_QUOTA))}, id) AS rn
  FROM (SELECT l_orderkey * 10 + l_linenumber AS id, l_returnflag, l_quantity FROM lineitem))
WHERE rn <= {K.LARGE_QUOTA}""",
    "fraction_sample": f"""WITH {_vectors()}
SELECT id, x, y FROM vectors
WHERE {_order('id', str(SAMPLE_SEED))} < {math.floor(K.FRACTION * 2147483647)}""",
    "fraction_sample_small": f"""SELECT l_orderkey * 10 + l_linenumber AS id FROM lineitem
WHERE {_order('(l_orderkey * 10 + l_linenumber)', str(SAMPLE_SEED))} < {math.floor(K.SMALL_FRACTION * 2147483647)}""",
    "column_groups": f"""WITH {ACTIVITY}, long_form AS ({LONG_FORM})
SELECT column_name, activity_group, round(sum(minutes), 2) AS minutes
FROM long_form GROUP BY column_name, activity_group""",
    "unpivot_groups": f"WITH {ACTIVITY} {LONG_FORM}",
    "bucketing": f"WITH {ACTIVITY} SELECT tucaseid, {BUCKETS} FROM activity",
    "row_sum": f"WITH {ACTIVITY} SELECT tucaseid, {ROUNDED_HOURS} FROM activity",
    "wide_summary": f"WITH {_summary(ROUNDED_HOURS)} SELECT * FROM summary",
    "typed_projection": f"WITH {_summary(ROUNDED_HOURS)} SELECT * FROM summary",
    "left_join_check": f"""WITH {_summary(ROUNDED_HOURS)}
SELECT working, sex, primaryNeeds, l.n AS n_left, coalesce(r.n, 0) AS n_right,
       CASE WHEN r.n IS NOT NULL THEN 'OK' ELSE 'NOK' END AS flag
FROM (SELECT working, sex, primaryNeeds, count(*) AS n FROM summary GROUP BY ALL) l
LEFT JOIN (SELECT working, sex, primaryNeeds, count(*) AS n FROM summary WHERE {K.PARTNERS} GROUP BY ALL) r
USING (working, sex, primaryNeeds)""",
    "rename_flag": f"""WITH {_summary(ROUNDED_HOURS)}
SELECT l.*, r.working AS working2, r.sex AS sex2, r.age AS age2,
       r.primaryNeeds AS primaryNeeds2, r.work AS work2, r.other AS other2,
       CASE WHEN l.primaryNeeds = r.primaryNeeds THEN 'OK' ELSE 'NOK' END AS flag
FROM (SELECT *, count(*) AS n FROM summary GROUP BY ALL) l
LEFT JOIN (SELECT DISTINCT * FROM summary WHERE {K.PARTNERS}) r
  ON l.working = r.working AND l.sex = r.sex AND l.age = r.age
 AND l.primaryNeeds = r.primaryNeeds AND l.work = r.work AND l.other = r.other""",
    "grouped_avg": _averages(1),
    "grouped_avg_sorted": _averages(1) + " ORDER BY working, sex, age",
    "grouped_avg_sql": _averages(6),
    "grouped_avg_typed": _averages(1),
    "keyed_concat": CONCAT + " ORDER BY k",
    "keyed_concat_segments": f"""WITH {FRAGMENTS}
SELECT k, CAST(pos // {K.SEGMENT_SPAN} AS BIGINT) AS segment, string_agg(v, '' ORDER BY pos, v) AS text
FROM fragments GROUP BY k, pos // {K.SEGMENT_SPAN}""",
    "group_fold": CONCAT,
    "udaf_concat": CONCAT,
    "nested_struct": "SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer",
}
