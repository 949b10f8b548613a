"""Periodic runs against their definition."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from llm import brute
from loomtally.llm import periodic_runs
from loomtally.llm.queries import QUERIES
from loomtally.llm.tables import table

SMALL = "/root/testdata/sf0.001"


def texts_with_runs(rng: random.Random) -> list[list[bytes]]:
    texts = []
    for _ in range(rng.randrange(1, 8)):
        kinds = rng.choice([1, 2, 3, 50])
        made = [b"w%d" % rng.randrange(kinds) for _ in range(rng.choice([0, 5, 24, 30, 100, 300]))]
        for _ in range(rng.randrange(3)):
            base = [b"w%d" % rng.randrange(kinds) for _ in range(rng.randrange(1, 20))]
            at = rng.randrange(len(made) + 1)
            made[at:at] = (base * rng.randrange(1, 12))[: rng.randrange(1, 80)]
        texts.append(made)
    return texts


@pytest.mark.parametrize("least, exponent", [(24, 3), (4, 2), (6, 3), (1, 5)])
def test_runs_as_defined(least, exponent):
    rng = random.Random(least)
    for _ in range(60):
        texts = texts_with_runs(rng)
        for words, runs in zip(texts, periodic_runs.runs_of(texts, least, exponent)):
            assert list(map(tuple, runs.tolist())) == brute.runs(words, least, exponent)


def test_extensions_over_the_grammar():
    rng = random.Random(3)
    texts = [[rng.randrange(3) for _ in range(n)] for n in (1, 40, 200)] + [[0] * 90]
    string = np.array([3, *texts[0], 4, *texts[1], 5, *texts[2], 6, *texts[3], 7])
    levels = periodic_runs.grammar(string, 3, len(texts))
    assert len(levels) < 60
    first = 1
    for text in texts:
        pairs = [(i, j) for i in range(len(text)) for j in range(len(text)) if i != j]
        i, j = np.array(pairs, np.int64).reshape(-1, 2).T + first
        for (a, b), found in zip(pairs, periodic_runs.extensions(levels, i, j)):
            same = 0
            while max(a, b) + same < len(text) and text[a + same] == text[b + same]:
                same += 1
            assert found == same
        first += len(text) + 1


def test_grid_in_small_pieces(monkeypatch):
    texts = texts_with_runs(random.Random(8)) + [[b"a"] * 500]
    whole = periodic_runs.runs_of(texts)
    monkeypatch.setattr(periodic_runs, "POINTS", 7)
    assert all((a == b).all() for a, b in zip(whole, periodic_runs.runs_of(texts)))


def test_query(spark):
    got = {r.doc_id: r for r in QUERIES["op11_periodic_runs"](spark, SMALL).collect()}
    docs = table(spark, SMALL, "documents").collect()
    assert len(got) == len(docs)
    for row in docs:
        words = (row.text or "").encode().split()
        h, n = zlib.crc32(str(row.doc_id).encode()), len(words)
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = brute.runs(words)
        gone = {i for s, length, p in runs for i in range(s + p, s + length)}
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
        r = got[row.doc_id]
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert r.runs_sha256 == hashlib.sha256("".join("%d,%d,%d\n" % x for x in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(kept).hexdigest()


def test_unusual_rows(rows):
    columns = "doc_id long, text string, runs int, start string, best int, h int, words int, collapsed int"
    data = [(1, None), (None, None), (None, "a b " * 30), (2, ""), (3, " \n\t"), (4, "x " * 20_000), (4, "x " * 20_000), (5, "y" * 300_000)]
    found = periodic_runs.digests(periodic_runs.periodic_runs(rows([(*d, 1, "s", 1, 1, 1, 1) for d in data], columns)))
    got = sorted(((r.doc_id, r.n_runs, r.start, r.length, r.period) for r in found.collect()), key=str)
    none = (0, None, None, None)
    assert got == sorted(
        [(1, *none), (None, *none), (None, 1, 0, 60, 2), (2, *none), (3, *none), (4, 1, 0, 20_000, 1), (4, 1, 0, 20_000, 1), (5, *none)],
        key=str,
    )
    made = periodic_runs.with_repeats(rows([(*d, 1, "s", 1, 1, 1, 1) for d in data], columns))
    assert made.count() == len(data) and made.columns == ["doc_id", "text"]
    empty = periodic_runs.periodic_runs(periodic_runs.with_repeats(rows([], columns)))
    assert periodic_runs.digests(empty).collect() == []
