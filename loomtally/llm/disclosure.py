"""Personal data: patterns, and terms that give protected entities away.

Entities are what the patterns find: e-mail and IP addresses, card and phone numbers. Terms
near an entity may reveal it without naming it. Over all documents, with n documents that
hold the term, the entity, or the term near the entity, a term's disclosure of an entity is

    log(N * n_both / (n_term * n_entity)) / log(N / n_entity)

its pointwise mutual information in units of the entity's own information: 1 for a term that
occurs with the entity only, about 0 for one that is independent of it. Terms that reach the
threshold for some entity are generalised wherever they occur, or removed if they reach the
higher one. A term must have been seen near the entity in `MIN_TOGETHER` documents.

Counts cover all documents. Which terms to look for travels as a bitmap of fixed size; what
passes it is counted and joined by the term itself, so the bitmap only saves work.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from loomtally.llm.tables import SLOTS, bitmap, durable, fresh, rows_key

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
GENERALISE_AT, REMOVE_AT, MIN_TOGETHER = 0.8, 0.999, 2
# A term is near an entity within this many words and characters on either side.
NEAR_WORDS, NEAR_CHARS, MIN_TERM = 5, 200, 3

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# The look-behind changes no match: a match takes its digits up to the last one.
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """From each `@` outwards, so that long words without one cost nothing."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            free = domain.end()
        at = text.find("@", max(at + 1, free))


def _luhn(digits: str) -> bool:
    values = [int(d) for d in reversed(digits)]
    return (sum(values[::2]) + sum(sum(divmod(2 * v, 10)) for v in values[1::2])) % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) in code points, by kind and start."""
    found = [(0, a, b) for a, b in _emails(text)] if "@" in text else []
    for m in IP.finditer(text):
        parts = [p.lstrip("0") or "0" for p in m[0].split(".")]
        if all(len(p) <= 3 and int(p) <= 255 for p in parts):
            found.append((1, m.start(), m.end()))
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and _luhn(digits):
            found.append((2, m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum(map(str.isdigit, m[0])) <= 15:
                found.append((3, m.start(), m.end()))
    return found


EDGES = re.compile(r"^\W+|\W+$")


def term_of(word: str) -> str | None:
    """A white-space separated word without punctuation around it, in lower case."""
    term = EDGES.sub("", word).lower()
    return term if len(term) >= MIN_TERM and any(map(str.isalpha, term)) else None


def _near(text: str, spans: list[tuple[int, int, int]]) -> set[tuple[str, str]]:
    """(entity, term) pairs of a document."""
    pairs = set()
    for kind, start, end in spans:
        entity = f"{KINDS[kind]}:{text[start:end].lower()}"
        left, right = text[max(0, start - NEAR_CHARS) : start], text[end : end + NEAR_CHARS]
        # The words cut by the limits, or grown together with the entity, don't count.
        before = left.split()[(start > NEAR_CHARS) : (None if left[-1:].isspace() else -1)][-NEAR_WORDS:]
        after = right.split()[(0 if right[:1].isspace() else 1) : (-1 if end + NEAR_CHARS < len(text) else None)][:NEAR_WORDS]
        for word in before + after:
            term = term_of(word)
            if term:
                pairs.add((entity, term))
    return pairs


_SCANNED = (
    "struct<base array<struct<kind int, start int, end int>>,"
    " near array<struct<entity string, term string>>, entities array<string>>"
)


def _scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for texts in batches:
        base, near, entities = [], [], []
        for text in texts:
            spans = base_spans(text)
            base.append([{"kind": k, "start": a, "end": b} for k, a, b in spans])
            near.append([{"entity": e, "term": t} for e, t in sorted(_near(text, spans))])
            entities.append(sorted({f"{KINDS[k]}:{text[a:b].lower()}" for k, a, b in spans}))
        yield pd.DataFrame({"base": base, "near": near, "entities": entities})


def _slot(term: Column) -> Column:
    return F.crc32(term.cast("binary")) % SLOTS


class _Filter(dict):
    """Words to terms whose slot is set, or None; forgets when it grows large."""

    def __init__(self, slots: bytes) -> None:
        self.bits = np.unpackbits(np.frombuffer(slots, np.uint8))

    def __missing__(self, word: str) -> str | None:
        if len(self) > 200_000:
            self.clear()
        term = term_of(word)
        if term and not self.bits[zlib.crc32(term.encode("utf-8", "surrogatepass")) % SLOTS]:
            term = None
        self[word] = term
        return term


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(rows_key(docs).alias("node"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))


def scanned(docs: DataFrame) -> DataFrame:
    """`node`, `doc_id`, `base` spans, `near` pairs and `entities` per row, stored."""
    return durable(_texts(docs).withColumn("s", F.pandas_udf(_scan, _SCANNED)("text")).select("node", "doc_id", "s.*"))


def disclosing_terms(
    docs: DataFrame, found: DataFrame, threshold: float = GENERALISE_AT, min_together: int = MIN_TOGETHER
) -> DataFrame:
    """`term`, `disclosure` (largest over all entities) of terms that reach the threshold."""
    total = found.count()
    together = (
        found.select(F.explode("near").alias("p")).groupBy("p.entity", "p.term")
        .agg(F.count("*").alias("n_both")).where(F.col("n_both") >= min_together)
    )
    together = durable(together)
    holders = found.select(F.explode("entities").alias("entity")).groupBy("entity").agg(F.count("*").alias("n_entity"))
    wanted = together.select("term").distinct()
    known_slots = bitmap(wanted, _slot(F.col("term")))

    @F.pandas_udf("array<string>")
    def held(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = _Filter(known_slots.value)
        for texts in batches:
            yield pd.Series([sorted({t for t in map(known.__getitem__, text.split()) if t}) for text in texts], dtype=object)

    frequent = (
        _texts(docs).select(F.explode(held("text")).alias("term")).groupBy("term").agg(F.count("*").alias("n_term"))
    )
    information = F.log(F.lit(float(total)) / F.col("n_entity"))
    mutual = F.log(F.lit(float(total)) * F.col("n_both") / (F.col("n_term") * F.col("n_entity")))
    return (
        together.join(holders, "entity").join(frequent, "term").where(information > 0)
        .groupBy("term").agg(F.max(mutual / information).alias("disclosure"))
        .where(F.col("disclosure") >= threshold)
    )


def find_spans(
    docs: DataFrame, threshold: float = GENERALISE_AT, min_together: int = MIN_TOGETHER
) -> DataFrame:
    """`node`, `doc_id`, `base` and `terms` (start, end, disclosure) for every row of `docs`.

    A NULL text counts as empty and has no spans. Terms never overlap a base span. Rows that
    agree in id and text have the same spans; each counts as a document. Other columns are
    not looked at. Texts of any length are read whole, in time that grows with the length.
    """
    found = scanned(docs)
    flagged = durable(disclosing_terms(docs, found, threshold, min_together))
    known_slots = bitmap(flagged, _slot(F.col("term")))

    @F.pandas_udf("array<struct<term string, start int, end int>>")
    def places(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = _Filter(known_slots.value)
        for texts in batches:
            out = []
            for text in texts:
                own = []
                if any(map(known.__getitem__, text.split())):
                    spans = sorted((a, b) for _, a, b in base_spans(text))
                    starts = np.array([a for a, _ in spans], int)
                    reach = np.maximum.accumulate(np.array([b for _, b in spans], int)) if spans else starts
                    for m in re.finditer(r"\S+", text):
                        term = known[m[0]]
                        if term:
                            lead = re.match(r"\W*", m[0]).end()
                            a, b = m.start() + lead, m.start() + lead + len(EDGES.sub("", m[0]))
                            k = np.searchsorted(starts, b) - 1
                            if k < 0 or reach[k] <= a:
                                own.append({"term": term, "start": a, "end": b})
                out.append(own)
            yield pd.Series(out, dtype=object)

    candidates = _texts(docs).select("node", "doc_id", F.explode(places("text")).alias("p")).select("node", "doc_id", "p.*")
    terms = (
        candidates.join(flagged, "term").groupBy("node", "doc_id")
        .agg(F.sort_array(F.collect_set(F.struct("start", "end", "disclosure"))).alias("terms"))
        .select(F.col("node").alias("n"), F.col("doc_id").alias("d"), "terms")
    )
    return found.join(terms, (F.col("node") == F.col("n")) & F.col("doc_id").eqNullSafe(F.col("d")), "left").select(
        "node", "doc_id", "base", "terms"
    )


def digests(spans: DataFrame) -> DataFrame:
    """Counts per kind, digest of the base spans, and all spans as a string."""
    names = F.array(*[F.lit(k) for k in KINDS])
    shown = F.transform("base", lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"]))
    extra = F.transform(
        F.coalesce("terms", F.array().cast("array<struct<start int, end int, disclosure double>>")),
        lambda s: F.concat_ws(":", F.lit(TERM), s["start"], s["end"]),
    )
    of = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return spans.select(
        "doc_id", *[of(k).alias(f"n_{name}") for k, name in enumerate(KINDS)],
        F.sha2(F.array_join(shown, ",").cast("binary"), 256).alias("base_sha256"),
        F.array_join(F.concat(shown, extra), ",").alias("spans"),
    )


def sanitised(docs: DataFrame, spans: DataFrame, remove_at: float = REMOVE_AT) -> DataFrame:
    """`docs` with all columns; entities become `[email]` ..., terms `[term]` or nothing.

    Of overlapping base spans the earlier (then longer) one is replaced; the rest of the
    others goes with it.
    """
    key, node, id_, found_at = (fresh(docs, name) for name in ("_llm_key", "_llm_node", "_llm_id", "_llm_spans"))
    at = spans.select(F.col("node").alias(node), F.col("doc_id").alias(id_), "base", "terms").dropDuplicates([node, id_])
    at = at.select(node, id_, F.struct("base", "terms").alias(found_at))

    @F.pandas_udf("string")
    def cleaned(texts: pd.Series, found: pd.DataFrame) -> pd.Series:
        out = []
        for text, base, terms in zip(texts, found["base"], found["terms"]):
            if text is None:
                out.append(None)
                continue
            parts = [(s["start"], -s["end"], f"[{KINDS[s['kind']]}]") for s in base]
            parts += [(s["start"], -s["end"], "" if s["disclosure"] >= remove_at else f"[{TERM}]") for s in (() if terms is None else terms)]
            pieces, done = [], 0
            for start, end, label in sorted(parts):
                if start >= done:
                    pieces += [text[done:start], label]
                done = max(done, -end)
            out.append("".join(pieces) + text[done:])
        return pd.Series(out, dtype=object)

    keyed = docs.withColumn(key, rows_key(docs)).join(
        at, (F.col(key) == F.col(node)) & F.col("doc_id").eqNullSafe(F.col(id_)), "left"
    )
    return keyed.select(*[cleaned("text", found_at).alias("text") if c == "text" else F.col(c) for c in docs.columns])
