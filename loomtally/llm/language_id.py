"""Language identification by prediction by partial matching.

Each language has a byte context tree of variable order, kept as sorted tables of the
contexts and continuations seen in its training texts. A byte costs -log2 of its probability
in the longest context that knows it, plus the escapes from the longer ones (method C); a
byte never seen costs 8 more bits. Statistics are frozen after training, so a byte's cost
depends only on the `order` bytes before it and on itself: each batch is reduced to its
distinct (context, byte) strings, those are priced once per language, and the prices are
summed per text. All of every text is read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from loomtally.llm.tables import fresh, shipped
from loomtally.llm.words import slices

ORDER = 3
# Bounds of the training sample, per language: the model that travels to the tasks has at
# most this many bytes' contexts of each order.
TRAIN_DOCS = 1_000
TRAIN_BYTES = 2_000_000
# Bytes priced at once: about 100 bytes of memory for each.
STEP_BYTES = 1_000_000
UNDECIDED = "und"


def _grams(text: np.ndarray, order: int) -> np.ndarray:
    """At each byte, it and the `order` bytes before (zeros before the start), packed."""
    padded = np.concatenate([np.zeros(order, np.uint8), text]).astype(np.uint64)
    n = len(text)
    packed = np.zeros(n, np.uint64)
    for k in range(order + 1):
        packed = (packed << np.uint64(8)) | padded[k : k + n]
    return packed


@dataclass
class ContextTree:
    """Per order: (context, byte) counts, context totals and numbers of distinct bytes."""

    grams: list[np.ndarray]
    counts: list[np.ndarray]
    contexts: list[np.ndarray]
    totals: list[np.ndarray]
    kinds: list[np.ndarray]

    @classmethod
    def from_counts(cls, grams: np.ndarray, counts: np.ndarray, order: int) -> ContextTree:
        tree = cls([], [], [], [], [])
        for o in range(order + 1):
            cut = grams & np.uint64((1 << (8 * (o + 1))) - 1)
            g, at = np.unique(cut, return_inverse=True)
            n = np.bincount(at, counts, len(g))
            c, at = np.unique(g >> np.uint64(8), return_inverse=True)
            tree.grams.append(g)
            tree.counts.append(n)
            tree.contexts.append(c)
            tree.totals.append(np.bincount(at, n, len(c)))
            tree.kinds.append(np.bincount(at, minlength=len(c)).astype(float))
        return tree

    def bits(self, grams: np.ndarray, order: int) -> np.ndarray:
        """Code length of the last byte of each gram after the others."""
        cost = np.zeros(len(grams))
        open_ = np.arange(len(grams))
        for o in range(order, -1, -1):
            cut = grams[open_] & np.uint64((1 << (8 * (o + 1))) - 1)
            context = cut >> np.uint64(8)
            at = np.minimum(np.searchsorted(self.contexts[o], context), len(self.contexts[o]) - 1)
            known = self.contexts[o][at] == context
            here = np.minimum(np.searchsorted(self.grams[o], cut), len(self.grams[o]) - 1)
            found = known & (self.grams[o][here] == cut)
            whole = np.log2(self.totals[o][at] + self.kinds[o][at])
            cost[open_[found]] += whole[found] - np.log2(self.counts[o][here[found]])
            escape = known & ~found
            cost[open_[escape]] += whole[escape] - np.log2(self.kinds[o][at[escape]])
            open_ = open_[~found]
        cost[open_] += 8.0
        return cost


@dataclass
class Model:
    order: int
    languages: list[str]
    trees: list[ContextTree]

    def _add_bits(self, raw: list[bytes], total: np.ndarray) -> None:
        """Adds each text's code lengths to its column; a very long text is read in steps."""
        starts, owners, grams = [], [], []
        size = 0
        for i, text in enumerate(raw):
            for at in range(0, len(text), STEP_BYTES):
                before = min(at, self.order)
                part = np.frombuffer(text[at - before : at + STEP_BYTES], np.uint8)
                grams.append(_grams(part, self.order)[before:])
                owners.append(i)
                starts.append(size)
                size += len(grams[-1])
                if size >= 2 * STEP_BYTES:
                    self._price(grams, starts, owners, total)
                    starts, owners, grams, size = [], [], [], 0
        self._price(grams, starts, owners, total)

    def _price(self, grams: list[np.ndarray], starts: list[int], owners: list[int], total: np.ndarray) -> None:
        if grams:
            kinds, at = np.unique(np.concatenate(grams), return_inverse=True)
            for k, tree in enumerate(self.trees):
                np.add.at(total[k], owners, np.add.reduceat(tree.bits(kinds, self.order)[at], starts))

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float], list[float]]:
        """Language, posterior under equal priors, and bits per byte in that language."""
        raw = [b"" if t is None else t.encode("utf-8", "surrogatepass") for t in texts]
        lengths = np.array([len(r) for r in raw])
        total = np.zeros((len(self.trees), len(texts)))
        if self.trees:
            for own in slices(raw, STEP_BYTES):
                self._add_bits(raw[own], total[:, own])
        names, scores, rates = [], [], []
        for i, text in enumerate(texts):
            if not self.trees or text is None or not any(map(str.isalpha, text)):
                names.append(UNDECIDED)
                scores.append(0.0)
                rates.append(0.0)
                continue
            best = int(np.argmin(total[:, i]))
            names.append(self.languages[best])
            scores.append(float(1 / np.exp2(np.maximum(total[best, i] - total[:, i], -1000)).sum()))
            rates.append(float(total[best, i] / lengths[i]))
        return names, scores, rates


def is_held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % 4 == 2


def train(
    docs: DataFrame, order: int = ORDER, max_docs: int = TRAIN_DOCS, max_bytes: int = TRAIN_BYTES
) -> Model:
    """A tree per language value from a bounded sample of whole labelled texts.

    Per language, of which there must be a moderate number, texts are drawn in the order of
    a hash of the text, without copies, until
    `max_docs` or `max_bytes` is reached; the first one is always taken. Rows without text,
    language or id do not train. Byte strings are counted by Spark.
    """
    if not 0 < order < 8:
        raise ValueError("order must be from 1 to 7")
    labelled = docs.select("doc_id", "text", "lang").where(
        "doc_id IS NOT NULL AND text IS NOT NULL AND lang IS NOT NULL AND text != ''"
    ).where(~is_held_out())
    hashed = labelled.select("lang", "text", F.xxhash64("text").alias("h"), F.octet_length("text").alias("b"))
    # Hashes alone are ranked, first within slices of them: a text can only be drawn if it
    # is among the first `max_docs` of its slice. No text moves for this.
    slices = hashed.groupBy("lang", "h").agg(F.max("b").alias("b")).withColumn("slice", F.pmod("h", F.lit(64)))
    local = Window.partitionBy("lang", "slice").orderBy("h")
    overall = Window.partitionBy("lang").orderBy("h")
    cuts = (
        slices.withColumn("r", F.row_number().over(local)).where(F.col("r") <= max_docs)
        .withColumn("r", F.row_number().over(overall))
        .withColumn("before", F.sum("b").over(overall) - F.col("b"))
        .where((F.col("r") <= max_docs) & (F.col("before") < max_bytes))
        .groupBy("lang").agg(F.max("h").alias("cut"))
    )
    drawn = (
        hashed.join(F.broadcast(cuts), "lang").where(F.col("h") <= F.col("cut"))
        .groupBy("lang", "h").agg(F.min("text").alias("text"))
    )

    def count(batches):
        for batch in batches:
            for lang, group in batch.groupby("lang"):
                packed = np.concatenate(
                    [_grams(np.frombuffer(t.encode("utf-8", "surrogatepass"), np.uint8), order) for t in group["text"]]
                )
                grams, n = np.unique(packed, return_counts=True)
                yield pd.DataFrame({"lang": lang, "gram": grams.astype(np.int64), "n": n})

    counted = (
        drawn.select("lang", "text").mapInPandas(count, "lang string, gram long, n long")
        .groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
    )
    languages = sorted(counted["lang"].unique())
    parts = [counted[counted["lang"] == name] for name in languages]
    return Model(order, languages, [
        ContextTree.from_counts(p["gram"].to_numpy().astype(np.uint64), p["n"].to_numpy(float), order) for p in parts
    ])


def prediction(docs: DataFrame, model: Model) -> Column:
    """Struct column `lang_pred`, `score`, `bits_per_byte` of the column `text`."""
    shared = shipped(docs.sparkSession, model)

    @F.pandas_udf("struct<lang_pred string, score double, bits_per_byte double>")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            names, scores, rates = shared.value.predict(texts.tolist())
            yield pd.DataFrame({"lang_pred": names, "score": scores, "bits_per_byte": rates})

    return predict(F.col("text"))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """`doc_id`, `held_out`, `lang_pred`, `score`, `bits_per_byte` for every row of `docs`.

    A NULL or empty text, one without a letter, and every text under a model without
    languages is `und` with score 0. Equal costs fall to the language first in sort order.
    A NULL doc_id is not held out.
    """
    return docs.select(
        "doc_id", F.coalesce(is_held_out(), F.lit(False)).alias("held_out"), prediction(docs, model).alias("p")
    ).select("doc_id", "held_out", "p.*")


def keep_identified(docs: DataFrame, model: Model, min_score: float = 0.0) -> DataFrame:
    """Rows of `docs`, with all their columns, whose language is decided with `min_score`."""
    name = fresh(docs, "_llm_language")
    judged = docs.withColumn(name, prediction(docs, model))
    kept = judged.where((F.col(f"{name}.lang_pred") != UNDECIDED) & (F.col(f"{name}.score") >= min_score))
    return kept.select(*docs.columns)
