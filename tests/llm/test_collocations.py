"""Collocations against a plain count of all phrases."""

import random
import re
from collections import Counter

import pytest

from compare import difference, open_tables
from loomtally.llm import collocations
from loomtally.llm.queries import QUERIES, SQL

COLUMNS = "doc_id long, lang string, text string, prefix string, phrase string, n int, f int, k int, words int, total int"


def plain(docs, least, longest, percent, top):
    counts, totals = Counter(), Counter()
    for lang, text in docs:
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang or "und"] += len(words)
            for m in range(1, longest + 1):
                for i in range(len(words) - m + 1):
                    counts[lang or "und", tuple(words[i : i + m])] += 1
    often = {k: a for k, a in counts.items() if a >= least}
    out = []
    for (lang, phrase), a in often.items():
        m = len(phrase)
        if m < 2:
            continue
        inside = lambda g: any(g[i : i + m] == phrase for i in range(len(g) - m + 1))
        if any(k == lang and len(g) > m and 100 * b >= percent * a and inside(g) for (k, g), b in often.items()):
            continue
        scores = []
        for k in range(1, m):
            left, right = counts[lang, phrase[:k]], counts[lang, phrase[k:]]
            scores.append((1000 * a * totals[lang] // (left * right), k, left, right))
        score, _, left, right = min(scores)
        out.append((lang, " ".join(phrase), a, left, right, totals[lang], score))
    out.sort(key=lambda r: (r[0], -r[6], -r[2], r[1].encode()))
    ranks, ranked = Counter(), []
    for row in out:
        ranks[row[0]] += 1
        if ranks[row[0]] <= top:
            ranked.append((row[0], ranks[row[0]], *row[1:]))
    return ranked


def made(seed: int) -> list[tuple]:
    rng = random.Random(seed)
    words = ["New", "york", "city", "the", "É", "of", "a b", "x\x1cy"]
    docs = []
    for i in range(60):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", " - "]) for _ in range(rng.randrange(60)))
        docs.append((rng.choice(["en", "en", "de", None, "und"]), text + rng.choice(["", " the new york city hall"])))
    return docs + [(None, None), ("xx", ""), ("xx", " .,; "), ("en", "a a a a a a a a a a a a")]


@pytest.mark.parametrize("least, longest, percent, top", [(4, 5, 100, 2000), (2, 3, 60, 7), (1, 2, 100, 2000), (3, 6, 100, 5)])
def test_phrases(rows, least, longest, percent, top, monkeypatch):
    monkeypatch.setattr(collocations, "CHARS", 500)
    monkeypatch.setattr(collocations, "SPLIT_FROM", 20)
    docs = made(least)
    got = collocations.collocations(rows(docs, "lang string, text string"), least, longest, percent, top)
    order = lambda r: (r[0], r[1])
    assert sorted(map(tuple, got.collect()), key=order) == plain(docs, least, longest, percent, top)


def test_full_bitmap_holds_nothing_back(rows, monkeypatch):
    monkeypatch.setattr(collocations, "MIN_BITS", 64)
    monkeypatch.setattr(collocations, "MAX_BITS", 64)
    docs = made(9)
    got = collocations.collocations(rows(docs, "lang string, text string"), 3, 5)
    assert sorted(map(tuple, got.collect())) == sorted(plain(docs, 3, 5, 100, 2000))


def test_products_pass_64_bits(spark):
    row = spark.range(1).selectExpr("cast(4000000000000000 as bigint) a", "cast(9000000000000000000 as bigint) n").first()
    assert 1000 * row.a * row.n > 2**64
    whole = spark.range(1).selectExpr(
        "(cast(1000 as decimal(4,0)) * cast(4000000000000000 as decimal(19,0)) * cast(9000000000000000000 as decimal(19,0)))"
        " div (cast(5000000000000000 as decimal(19,0)) * cast(4000000000000003 as decimal(19,0))) as s"
    )
    assert whole.first().s == 1000 * row.a * row.n // (5000000000000000 * 4000000000000003)


def test_unusual_rows(rows):
    data = [(1, None, None), (None, None, "b c. b c"), (2, "en", ""), (3, "en", "x y " * 20_000), (3, "en", "x y " * 20_000), (4, "en", "z" * 300_000)]
    docs = rows([(*d, "p", "q", 1, 1, 1, 1, 1) for d in data], COLUMNS)
    got = collocations.collocations(docs, 2)
    assert sorted(map(tuple, got.collect())) == sorted(plain([d[1:] for d in data], 2, 5, 100, 2000))
    assert collocations.collocations(rows([], COLUMNS)).collect() == []


def test_agrees_with_sql(spark):
    folder = "/root/testdata/sf0.01"
    tables = open_tables(folder)
    frame = QUERIES["op12_collocations"](spark, folder)
    assert difference(frame, tables, SQL["op12_collocations"]) is None
    assert frame.count() > 50
    tables.close()
