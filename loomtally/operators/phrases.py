"""Phrases of several words: a trie over tokens with failure links, shared by the rows of a task.

Tokens are what stands between single spaces, as for single terms, and a phrase is met where its
tokens follow each other. The phrases of a vocabulary make up one automaton: a node for each
beginning of a phrase, with a link to the longest end of it that is a beginning too. A text is
read once, token by token, whatever the number of phrases; where phrases overlap or hold one
another, all of them are found. A task holds one text at a time besides the batch it came in, and
no copies of it for the phrases that it holds.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from loomtally.functions.text import SPACE, tokens
from loomtally.operators.terms import VOCABULARY_COPIES

# Phrases that make up an automaton in every task; more are joined by shuffle.
MAX_AUTOMATON_PHRASES = 200_000
# A task hands on what it has met as soon as it is so many rows.
OUT_ROWS = 10_000


def build(phrases: Iterable[str]) -> tuple[list[dict[str, int]], list[int], list[list[int]]]:
    """Steps by token, failure link and the phrases (by number) that end at each node."""
    steps, ends = [{}], [[]]
    for number, phrase in enumerate(phrases):
        node = 0
        for token in phrase.split(SPACE):
            if token not in steps[node]:
                steps[node][token] = len(steps)
                steps.append({})
                ends.append([])
            node = steps[node][token]
        ends[node].append(number)
    links, waiting = [0] * len(steps), deque(steps[0].values())
    while waiting:
        node = waiting.popleft()
        for token, child in steps[node].items():
            back = links[node]
            while back and token not in steps[back]:
                back = links[back]
            links[child] = steps[back].get(token, 0)
            # Shorter phrases that end where this one does.
            ends[child] = ends[child] + ends[links[child]]
            waiting.append(child)
    return steps, links, ends


def occurrences(text: str, steps: Sequence[dict], links: Sequence[int], ends: Sequence[list]) -> Iterator[int]:
    """Numbers of the phrases met, as often as they are met."""
    node = 0
    for token in text.split(SPACE):
        while node and token not in steps[node]:
            node = links[node]
        node = steps[node].get(token, 0)
        yield from ends[node]


def _by_automaton(articles: DataFrame, phrases: list[str], keep: Sequence[str], text: str) -> DataFrame:
    def read(batches):
        steps, links, ends = build(phrases)
        for batch in batches:
            texts, kept = batch["_text"], batch.drop_columns(["_text"])
            rows, terms, counts = [], [], []
            for row in range(batch.num_rows):
                value = texts[row].as_py()
                met: dict[int, int] = {}
                for number in occurrences(value, steps, links, ends) if value is not None else ():
                    met[number] = met.get(number, 0) + 1
                rows += [row] * len(met)
                terms += [phrases[number] for number in met]
                counts += met.values()
                if len(rows) >= OUT_ROWS:
                    yield found(kept, rows, terms, counts)
                    rows, terms, counts = [], [], []
            if rows:
                yield found(kept, rows, terms, counts)

    def found(kept, rows, terms, counts):
        own = kept.take(pa.array(rows, pa.int64())).columns if kept.num_columns else []
        arrays = [pa.array(terms, pa.string()), *own, pa.array(counts, pa.int64())]
        return pa.RecordBatch.from_arrays(arrays, names=["term", *kept.schema.names, "n"])

    source = articles.select(F.col(text).alias("_text"), *keep)
    shown = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[1:])
    return source.mapInArrow(read, f"term string, {shown + ', ' if shown else ''}n long")


def _by_grams(articles: DataFrame, phrases: DataFrame, lengths: list[int], keep: Sequence[str], text: str) -> DataFrame:
    """The runs of tokens of each article, counted, against copies of a large vocabulary."""
    split = articles.select(tokens(F.col(text)).alias("_tokens"), F.pmod(F.xxhash64(text), F.lit(VOCABULARY_COPIES)).alias("_copy"), F.monotonically_increasing_id().alias("_row"), *keep)
    runs = None
    for length in lengths:
        gram = f"transform(sequence(1, size(_tokens) - {length - 1}), i -> array_join(slice(_tokens, i, {length}), ' '))"
        found = split.where(F.size("_tokens") >= length).select(F.explode(F.expr(gram)).alias("term"), "_copy", "_row", *keep)
        runs = found if runs is None else runs.unionByName(found)
    copies = F.explode(F.sequence(F.lit(0), F.lit(VOCABULARY_COPIES - 1)).cast("array<bigint>"))
    met = runs.join(phrases.withColumn("_copy", copies), ["term", "_copy"])
    return met.groupBy("term", "_row", *keep).agg(F.count("*").alias("n")).drop("_row")


def phrase_join(articles: DataFrame, vocabulary: DataFrame, *keep: str, text: str = "text") -> DataFrame:
    """`term`, the `keep` columns and `n`: each article with each phrase it holds, and how often.

    `vocabulary` has a `term` column; NULL and repeated terms are left out. A phrase of one token
    is a term like any other, an empty one is met where two spaces follow each other. NULL texts
    hold nothing. A vocabulary of checked size becomes an automaton and nothing is shuffled; with
    a larger one, every article's runs of as many tokens as phrases have are joined with it, under
    one of several copies, so a common phrase is split.
    """
    phrases = vocabulary.select("term").where("term IS NOT NULL").distinct()
    head = sorted(row["term"] for row in phrases.limit(MAX_AUTOMATON_PHRASES + 1).collect())
    if len(head) <= MAX_AUTOMATON_PHRASES:
        return _by_automaton(articles, head, keep, text)
    sizes = phrases.select(F.size(F.split("term", SPACE)).alias("m")).distinct().collect()
    return _by_grams(articles, phrases, sorted(row["m"] for row in sizes), keep, text)
