"""Deletes later copies of repeated runs of lines; DataFrame functions only.

Lines that are not blank get line IDs (two 64-bit hashes), and each document is a sequence
of IDs. The suffix array over all sequences is sorted by prefix doubling: ranks of the first
line, then of the first 2, 4, ... lines from pairs of ranks `h` apart. Suffixes whose rank is
theirs alone are settled and leave; a suffix can only be tied at 2h if it and the one h lines
on are tied at h, so every round works on the tied rest. Ranks are dense and keep the order;
they are dealt out per range of keys, with the ranges' sizes added up.

An interval of suffixes with a longest common prefix of at least `min_run` lines is a set of
equal ranks at both ends of that prefix. Doubling stops at the power of two below `min_run`:
deeper intervals are parts of these and delete nothing else, as the run of a longer repeat is
the union of its windows of `min_run` lines. In each interval the first suffix, by doc_id and
position, is the original; the prefixes of all others are deleted.

Ranks and firsts are counted map-side before they are joined back, so a line that a third of
all rows share moves as few rows, and the joins on it can be split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from loomtally.llm.tables import durable, fresh, rows_key

MIN_RUN = 3
# Ranges that ranks are dealt out in; their sizes are broadcast.
RANGES = 4_096


def line_sequences(docs: DataFrame, min_run: int) -> DataFrame:
    """`node`, `doc_id`, `seq` (among lines with content), `a`, `b` (line ID)."""
    content = F.filter(F.split("text", "\n"), lambda line: line.rlike(r"\S"))
    return (
        docs.select(rows_key(docs).alias("node"), "doc_id", content.alias("content"))
        .where(F.size("content") >= min_run)
        .select("node", "doc_id", F.posexplode("content").alias("seq", "line"))
        .select("node", "doc_id", "seq",
                F.xxhash64(F.lit(7), "line").alias("a"), F.xxhash64(F.lit(11), "line").alias("b"))
    )


def _dense_ranks(keys: DataFrame, place: Column) -> DataFrame:
    """`a`, `b`, `rank` for distinct keys; `place` maps `a` to a range, in order."""
    placed = durable(keys.select("a", "b", place.alias("range")))
    sizes = placed.groupBy("range").agg(F.count("*").alias("n"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = F.row_number().over(Window.partitionBy("range").orderBy("a", "b"))
    return (
        placed.withColumn("inside", inside)
        .join(F.broadcast(offsets), "range")
        .select("a", "b", (F.col("inside") + F.col("offset")).alias("rank"))
    )


def _tied(rows: DataFrame, place: Column) -> DataFrame:
    """Rows whose key another row has too, with the key's rank."""
    keys = rows.groupBy("a", "b").agg(F.count("*").alias("n")).where("n > 1")
    return durable(rows.join(_dense_ranks(keys, place), ["a", "b"]).drop("a", "b"))


def _ahead(column: str, lines: int) -> Column:
    """The value `lines` further on in the same document, NULL if that suffix is settled."""
    return F.first(column).over(Window.partitionBy("node", "doc_id").orderBy("seq").rangeBetween(lines, lines))


def later_copies(docs: DataFrame, min_run: int = MIN_RUN) -> DataFrame:
    """`node`, `doc_id`, `seq`: where `min_run` lines begin that occurred before."""
    if min_run < 1:
        raise ValueError("min_run must be positive")
    tied = _tied(line_sequences(docs, min_run), F.shiftright("a", 52).cast("int"))
    length = 1
    while 2 * length <= min_run:
        pairs = tied.select(
            "node", "doc_id", "seq", F.col("rank").alias("a"), _ahead("rank", length).alias("b")
        ).where("b IS NOT NULL")
        top = (tied.agg(F.max("rank")).first()[0] or 0) + 1
        tied = _tied(pairs, F.floor(F.col("a") * RANGES / top).cast("int"))
        length *= 2
    ends = tied.select(
        "node", "doc_id", "seq", F.col("rank").alias("a"),
        _ahead("rank", min_run - length).alias("b"),
    ).where("b IS NOT NULL")
    where = F.struct(F.col("doc_id").isNull().alias("x"), "doc_id", "node", "seq")
    firsts = ends.groupBy("a", "b").agg(F.count("*").alias("n"), F.min(where).alias("first")).where("n > 1")
    return (
        ends.join(firsts, ["a", "b"])
        .where("NOT (seq = first.seq AND node = first.node AND doc_id <=> first.doc_id)")
        .select("node", "doc_id", "seq")
    )


def repeated_runs(docs: DataFrame, min_run: int = MIN_RUN) -> DataFrame:
    """Per document with deletions: `runs`, (first, last) of each maximal run in `seq`."""
    windows = later_copies(docs, min_run).distinct()
    in_order = Window.partitionBy("node", "doc_id").orderBy("seq")
    before = F.lag("seq").over(in_order)
    opened = windows.withColumn("new", (before.isNull() | (F.col("seq") >= before + min_run)).cast("int"))
    islands = opened.withColumn("run", F.sum("new").over(in_order))
    runs = islands.groupBy("node", "doc_id", "run").agg(
        F.min("seq").alias("seq"), (F.max("seq") + min_run - 1).alias("seq_end")
    )
    return runs.groupBy("node", "doc_id").agg(
        F.sort_array(F.collect_list(F.struct("seq", "seq_end"))).alias("runs")
    )


def _cleaned(text: Column, runs: Column) -> Column:
    """Struct of the text without the runs of content lines, and the number of lines that go."""
    lines = F.split(text, "\n")
    places = F.filter(
        F.transform(lines, lambda line, at: F.when(line.rlike(r"\S"), at)), lambda at: at.isNotNull()
    )
    spans = F.transform(
        runs, lambda r: F.struct(F.get(places, r["seq"]).alias("first"), F.get(places, r["seq_end"]).alias("last"))
    )
    starts = F.concat(F.array(F.lit(0)), F.transform(spans, lambda s: s["last"] + 1))
    ends = F.concat(F.transform(spans, lambda s: s["first"]), F.array(F.size(lines)))
    gaps = F.arrays_zip(starts.alias("s"), ends.alias("e"))
    kept = F.flatten(F.transform(gaps, lambda g: F.slice(lines, g["s"] + 1, g["e"] - g["s"])))
    return F.struct(F.array_join(kept, "\n").alias("text"), (F.size(lines) - F.size(kept)).alias("n_deleted"))


def _joined(docs: DataFrame, min_run: int) -> tuple[DataFrame, str]:
    """`docs` and the name of the column with their cleaned texts, NULL where nothing goes."""
    key, node, id_, runs, cleaned = (fresh(docs, f"_llm_{name}") for name in ("key", "node", "id", "runs", "cleaned"))
    found = repeated_runs(docs.select("doc_id", "text"), min_run).select(
        F.col("node").alias(node), F.col("doc_id").alias(id_), F.col("runs").alias(runs)
    )
    joined = docs.withColumn(key, rows_key(docs)).join(
        found, (F.col(key) == F.col(node)) & F.col("doc_id").eqNullSafe(F.col(id_)), "left"
    )
    return joined.withColumn(cleaned, F.when(F.col(runs).isNotNull(), _cleaned(F.col("text"), F.col(runs)))), cleaned


def dedup_lines(docs: DataFrame, min_run: int = MIN_RUN) -> DataFrame:
    """`doc_id`, `text` without later copies, `n_deleted` (lines) for every row of `docs`.

    A run is `min_run` or more consecutive lines with content; blank lines are no part of the
    sequence but go with a run that encloses them. Lines end at `\\n`; everything else in a
    line counts. The first copy, by doc_id (NULL last) and position, stays, also within one
    document; overlapping copies count. A NULL text stays NULL, an empty one empty. Rows that
    agree in id and text are one document and get the same result. Other columns of `docs`
    are left out.
    """
    joined, cleaned = _joined(docs.select("doc_id", "text"), min_run)
    return joined.select(
        "doc_id", F.coalesce(f"{cleaned}.text", "text").alias("text"),
        F.coalesce(f"{cleaned}.n_deleted", F.lit(0)).alias("n_deleted"),
    )


def keep_first_lines(docs: DataFrame, min_run: int = MIN_RUN) -> DataFrame:
    """`docs` with cleaned texts and all its columns; `n_chars`, if there, follows the text.

    A document of which no line with content is left goes; one that had none before stays.
    """
    joined, cleaned = _joined(docs, min_run)
    changed = F.col(cleaned).isNotNull()
    kept = joined.where(~changed | F.col(f"{cleaned}.text").rlike(r"\S"))
    text = F.coalesce(f"{cleaned}.text", "text")
    new = {"text": text, "n_chars": F.when(changed, F.length(text).cast("long")).otherwise(F.col("n_chars")) if "n_chars" in docs.columns else None}
    return kept.select(*[new[c].alias(c) if new.get(c) is not None else F.col(c) for c in docs.columns])
