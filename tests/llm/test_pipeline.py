"""The pipeline against its stages done plainly, and unusual tables through every operator."""

import hashlib

import pyarrow as pa
import pytest

import corpus_pipeline
from llm import brute
from llm.test_texts import encoding
from loomtally.llm import byte_bpe, decontaminate, disclosure, jaccard_join, language_id, license_scan, line_dedup, substring_dedup
from loomtally.llm.queries import vocabulary

SMALL = "/root/testdata/sf0.001"


def test_stages_make_up_the_run(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    items = [decontaminate.normalised(r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    kept = [(r.doc_id, r.text) for r in language_id.keep_identified(docs, language_id.train(docs)).collect()]
    kept = [(i, t) for i, t, _ in brute.without_copies(kept) if t.strip(brute.BLANK)]
    first = {i for i, _, c in brute.components(kept) if i == c}
    kept = [(i, t) for i, t in kept if i in first]
    met = lambda item, text: decontaminate.best_distance(item, text)[0] <= len(item) * 5 // 100
    kept = [(i, t) for i, t in kept if not any(x and met(x, decontaminate.normalised(t)) for x in items)]
    own = encoding()
    expected = {i: hashlib.sha256(" ".join(map(str, own.encode_ordinary(t))).encode()).hexdigest() for i, t in kept}
    assert {r.doc_id: r.ids_sha256 for r in corpus_pipeline.run(spark, SMALL).collect()} == expected
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "jaccard_join", "decontaminate", "byte_bpe"]


def test_stages_read_texts_in_small_batches(spark):
    """Ten thousand whole texts were in a batch, in every worker."""
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    docs = spark.range(6000, numPartitions=1).selectExpr("id AS doc_id", "repeat('word ', 800) AS text", "'en' AS lang")
    sizes = lambda: [r.n for r in docs.mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"n": [b.nbytes]}) for b in batches), "n long").collect()]
    before = spark.conf.get(setting)
    try:
        for name, stage in corpus_pipeline.STAGES:
            spark.conf.unset(setting)
            stage(spark, docs.limit(20), SMALL)
            assert sum(sizes()) > 20e6 and max(sizes()) < 6e6, name
        spark.conf.set(setting, "1m")
        corpus_pipeline.line_deduped(spark, docs, SMALL)
        assert spark.conf.get(setting) == "1m"
    finally:
        spark.conf.set(setting, before)


COLUMNS = (
    "doc_id long, text string, lang string, source string, n_chars long, node string, row int, g int, s string, owner int,"
    " key int, a int, b int, seq int, h int, m int, t int, line int, ids int, piece int, term int, c int, _llm_node int"
)
LONG = "once upon a time " * 20_000
MESSY = [
    (1, None), (None, None), (None, "a text without id"), (2, ""), (3, LONG), (4, LONG), (4, LONG), (5, "x" * 300_000),
    (6, "line\n" * 40), (6, "another text"), (7, "\x00퟿  odd"), (8, " \n\t"),
]


def operators(spark):
    known, model = vocabulary(), {}

    def classifier(docs):
        return model.setdefault("c", license_scan.train(docs))

    items = spark.createDataFrame([(1, "once upon a time " * 5), (2, None)], "item_id long, text string")
    return {
        "passages": (substring_dedup.near_duplicate_passages, None),
        "lines": (line_dedup.dedup_lines, 12),
        "first lines": (line_dedup.keep_first_lines, None),
        "licences": (lambda d: license_scan.licences(d, classifier(d)), None),
        "tokens": (lambda d: byte_bpe.digests(byte_bpe.encode(d, known), known), 12),
        "items": (lambda d: decontaminate.report(d, items), 2),
        "clean": (lambda d: decontaminate.keep_uncontaminated(d, items), 9),
        "languages": (lambda d: language_id.identify(d, language_id.train(d)), 12),
        "personal": (lambda d: disclosure.digests(disclosure.find_spans(d)), 12),
        "join": (jaccard_join.jaccard_components, 12),
        "one of each": (jaccard_join.keep_one_of_each, None),
    }


@pytest.mark.parametrize("name", ["passages", "lines", "first lines", "licences", "tokens", "items", "clean", "languages", "personal", "join", "one of each"])
def test_unusual_tables(spark, name):
    apply, expected = operators(spark)[name]
    width = COLUMNS.count(",") + 1
    data = [(i, t, "en", "s", 0, "n") + (0, 0, "s") + (0,) * (width - 9) for i, t in MESSY]
    got = apply(spark.createDataFrame(data, COLUMNS).repartition(3)).collect()
    assert expected is None or len(got) == expected
    nothing = apply(spark.createDataFrame([], COLUMNS)).collect()
    assert nothing == []


@pytest.mark.parametrize("name", ["first lines", "clean", "one of each", "languages", "personal"])
def test_clashing_columns_keep_their_values(spark, name):
    items = spark.createDataFrame([(1, "a benchmark question about the sea")], "item_id long, text string")
    keep = {
        "first lines": line_dedup.keep_first_lines,
        "clean": lambda d: decontaminate.keep_uncontaminated(d, items),
        "one of each": jaccard_join.keep_one_of_each,
        "languages": lambda d: language_id.keep_identified(d, language_id.train(d)),
        "personal": lambda d: disclosure.sanitised(d, disclosure.find_spans(d)),
    }[name]
    extra = ["_llm_node", "_LLM_ROW", "_llm_language", "_llm_key", "_llm_id", "_llm_runs", "_llm_cleaned", "_llm_spans", "_llm_key_"]
    texts = ["one\ntwo\nthree\nof mine", "one\ntwo\nthree\nof yours", "a benchmark question about the sea", "mail me at a.b@c.de", "two words"]
    data = [(i, t, "en", *[f"{i}-{c}" for c in extra]) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, " + ", ".join(f"{c} string" for c in extra)).repartition(3)
    kept = keep(docs)
    assert kept.columns == docs.columns
    kept = kept.collect()
    assert len(kept) >= 4 and all(r[c] == f"{r.doc_id}-{c}" for r in kept for c in extra)
