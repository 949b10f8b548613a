"""Byte-level BPE: overlapping chunks, stitched where pre-token boundaries resynchronise.

A text is cut into chunks of `CHUNK` code points, each read on by `OVERLAP`. Every chunk is
pre-tokenised from its own start, wherever that falls. The pattern looks back at nothing, so
once two neighbours agree on a boundary behind which they both go on, they agree for good:
the first such boundary in their overlap is where the earlier chunk's piece ends and the
later one's begins. Neighbours that never agree (a word or a run of spaces longer than the
overlap) become one piece. Pieces are encoded wherever they lie; their ids are joined in
order. Texts of one chunk are one piece and stay in their task; only chunks of longer texts
are shuffled. Decoding joins the raw bytes of the ids.
"""

from __future__ import annotations

import base64
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from loomtally.llm.tables import shipped
from loomtally.llm.words import slices

CHUNK = 65_536
OVERLAP = 4_096


class Vocabulary:
    """Ranks and pattern; loaded once per Python worker from the bytes that travel with it."""

    def __init__(self, path: str, pattern: str) -> None:
        with open(path, "rb") as file:
            self.raw = file.read()
        self.pattern = pattern
        self._encoding = self._regex = self._bytes = None

    def __getstate__(self):
        return self.raw, self.pattern

    def __setstate__(self, state):
        self.raw, self.pattern = state
        self._encoding = self._regex = self._bytes = None

    def ranks(self) -> dict[bytes, int]:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, self.raw.splitlines())}

    @property
    def encoding(self):
        if self._encoding is None:
            import tiktoken

            self._encoding = tiktoken.Encoding(
                "given", pat_str=self.pattern, mergeable_ranks=self.ranks(), special_tokens={}
            )
        return self._encoding

    @property
    def id_bytes(self) -> dict[int, bytes]:
        if self._bytes is None:
            self._bytes = {i: b for b, i in self.ranks().items()}
        return self._bytes

    def boundaries(self, text: str) -> np.ndarray:
        """Starts of pre-tokens whose predecessor ends in something other than white space.

        A piece that ends there reads the same alone as within the text: only a run of
        white space is matched by looking at what follows it.
        """
        if self._regex is None:
            import regex

            self._regex = regex.compile(self.pattern)
        starts = (m.end() for m in self._regex.finditer(text))
        return np.array([p for p in starts if not text[p - 1].isspace()], np.int64)


def encode(docs: DataFrame, vocabulary: Vocabulary, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """`doc_id`, `ids` (array<int>) for every row of `docs`; a NULL text counts as empty.

    An empty text has no ids. Repeated rows give repeated results. Other columns of `docs`
    are left out. `overlap` must be smaller than `chunk`.
    """
    if not 0 < overlap < chunk:
        raise ValueError("overlap must be positive and smaller than chunk")
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    shared = shipped(docs.sparkSession, vocabulary)

    def ids_of(batches):
        encoding = shared.value.encoding
        for batch in batches:
            for own in slices(batch["text"]):
                part = batch.iloc[own]
                ids = [np.array(encoding.encode_ordinary(p), np.int32) for p in part["text"]]
                yield part.drop(columns="text").reset_index(drop=True).assign(ids=pd.Series(ids, dtype=object))

    @F.pandas_udf("struct<head array<int>, tail array<int>>")
    def edges(chunks: pd.Series) -> pd.DataFrame:
        heads, tails = [], []
        for text in chunks:
            cuts = shared.value.boundaries(text)
            # The end of the chunk is no boundary of the text.
            inner = cuts[cuts < len(text)]
            heads.append(inner[inner < overlap].astype(np.int32))
            tails.append((inner[inner >= chunk] - chunk).astype(np.int32))
        return pd.DataFrame({"head": heads, "tail": tails})

    whole = texts.where(F.length("text") <= chunk + overlap).mapInPandas(
        ids_of, "doc_id long, ids array<int>"
    )
    long = texts.where(F.length("text") > chunk + overlap).groupBy("doc_id", "text").agg(F.count("*").alias("n"))
    key = F.xxhash64("doc_id", "text")
    last = F.expr(f"cast((length(text) - 1) div {chunk} as int)")
    chunks = (
        long.select("doc_id", key.alias("k"), "n", "text", F.explode(F.sequence(F.lit(0), last)).alias("c"))
        .select("doc_id", "k", "n", "c", F.expr(f"substring(text, c * {chunk} + 1, {chunk + overlap})").alias("part"))
        .repartition("k", "c")
        .withColumn("e", edges("part"))
    )
    in_order = Window.partitionBy("doc_id", "k").orderBy("c")
    agreed = F.array_min(F.array_intersect(F.col("e.head"), F.lag("e.tail").over(in_order)))
    stitched = chunks.withColumn("from", F.when(F.col("c") == 0, 0).otherwise(agreed))
    stitched = stitched.withColumn("piece", F.sum(F.col("from").isNotNull().cast("int")).over(in_order))
    stitched = stitched.withColumn("to", F.lead("from").over(in_order)).withColumn(
        "final", F.row_number().over(in_order) == F.count("*").over(Window.partitionBy("doc_id", "k"))
    )
    # A chunk gives what lies between its own first agreed boundary and the next chunk's.
    start = F.coalesce("from", F.lit(0))
    end = F.when(F.col("to").isNotNull(), F.lit(chunk) + F.col("to")).when(
        F.col("final"), F.length("part")
    ).otherwise(F.lit(chunk))
    share = stitched.select(
        "doc_id", "k", "n", "piece", "c",
        F.substring("part", start + 1, F.greatest(end - start, F.lit(0))).alias("share"),
    )
    ordered = lambda item: F.sort_array(F.collect_list(item))
    pieces = share.groupBy("doc_id", "k", "n", "piece").agg(
        F.array_join(F.transform(ordered(F.struct("c", "share")), lambda s: s["share"]), "").alias("text")
    )
    joined = (
        pieces.repartition("k", "piece")
        .mapInPandas(ids_of, "doc_id long, k long, n long, piece long, ids array<int>")
        .groupBy("doc_id", "k", "n")
        .agg(F.flatten(F.transform(ordered(F.struct("piece", "ids")), lambda s: s["ids"])).alias("ids"))
        .select("doc_id", "ids", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    )
    return whole.unionByName(joined.select("doc_id", "ids"))


def decode(encoded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """`doc_id`, `ids`, `bytes`: an unknown id is an error, NULL ids are not allowed."""
    shared = shipped(encoded.sparkSession, vocabulary)

    def join(batches):
        of = shared.value.id_bytes
        for batch in batches:
            for own in slices(batch["ids"]):
                part = batch.iloc[own]
                raw = [b"".join(map(of.__getitem__, x.tolist())) for x in part["ids"]]
                yield part.reset_index(drop=True).assign(bytes=pd.Series(raw, dtype=object))

    return encoded.select("doc_id", "ids").mapInPandas(join, "doc_id long, ids array<int>, bytes binary")


def digests(encoded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """`doc_id`, `n_tokens`, and digests of the ids and of what they decode to."""
    return decode(encoded, vocabulary).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )
