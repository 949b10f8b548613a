"""Phrases of several words against plain search."""

import random

import pyarrow as pa
import pytest

from loomtally.operators import phrases as P


def plain(text, phrases):
    tokens = text.split(" ")
    out = {}
    for phrase in phrases:
        own = phrase.split(" ")
        n = sum(tokens[i : i + len(own)] == own for i in range(len(tokens) - len(own) + 1))
        if n:
            out[phrase] = n
    return out


def made(seed):
    rng = random.Random(seed)
    texts = [" ".join(rng.choices(["a", "b", "ab", "", "C"], k=rng.randrange(40))) for _ in range(60)]
    phrases = {" ".join(rng.choices(["a", "b", "ab", "", "C", "never"], k=rng.randrange(1, 5))) for _ in range(40)}
    return texts, sorted(phrases | {"a b", "a b a", "b a", "a", "a b a b a"})


@pytest.mark.parametrize("seed", range(6))
def test_automaton(seed):
    texts, phrases = made(seed)
    automaton = P.build(phrases)
    for text in texts:
        met = {}
        for number in P.occurrences(text, *automaton):
            met[phrases[number]] = met.get(phrases[number], 0) + 1
        assert met == plain(text, phrases)


@pytest.mark.parametrize("limit", [200_000, 3])
def test_join(rows, monkeypatch, limit):
    monkeypatch.setattr(P, "MAX_AUTOMATON_PHRASES", limit)
    texts, phrases = made(9)
    articles = rows([(i, t, "x") for i, t in enumerate(texts)] + [(99, None, "x"), (98, "", "x"), (7, texts[7], "x")], "doc int, text string, more string")
    vocabulary = rows([(p,) for p in phrases] + [(None,), ("a b",), ("a b",)], "term string")
    got = P.phrase_join(articles, vocabulary, "doc", "more")
    expected = [(p, i, "x", n) for i, t in [*enumerate(texts), (98, ""), (7, texts[7])] for p, n in plain(t, phrases).items()]
    assert sorted(map(tuple, got.collect())) == sorted(expected)
    assert got.columns == ["term", "doc", "more", "n"]
    assert P.phrase_join(articles, vocabulary.where("false"), "doc").collect() == []


def test_columns_may_be_left_out(rows):
    got = P.phrase_join(rows([("one two three",), ("two three",)], "body string"), rows([("two three",)], "term string"), text="body")
    assert [tuple(r) for r in got.collect()] == [("two three", 1)] * 2


def test_texts_are_not_repeated_per_phrase(rows, monkeypatch):
    """A text was copied once for each phrase met in it, for a whole batch at a time."""
    sent = {}
    articles = rows([(i, "a b c " * 2000) for i in range(50)], "doc int, text string", 1)
    monkeypatch.setattr(type(articles), "mapInArrow", lambda frame, read, schema: sent.setdefault("read", read))
    monkeypatch.setattr(P, "OUT_ROWS", 60, raising=False)
    P._by_automaton(articles, ["a", "b", "c", "a b", "b c", "c a"], ["doc"], "text")
    batch = pa.RecordBatch.from_pylist([{"_text": r.text, "doc": r.doc} for r in articles.collect()])
    usual, counted = pa.default_memory_pool(), pa.proxy_memory_pool(pa.default_memory_pool())
    pa.set_memory_pool(counted)
    try:
        out = [row for part in sent["read"]([batch]) for row in part.to_pylist()]
    finally:
        pa.set_memory_pool(usual)
    assert counted.max_memory() < batch.nbytes / 4
    assert sorted((r["doc"], r["term"], r["n"]) for r in out) == sorted(
        (i, p, 1999 if p == "c a" else 2000) for i in range(50) for p in ("a", "b", "c", "a b", "b c", "c a")
    )
