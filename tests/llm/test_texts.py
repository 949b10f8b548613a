"""Tokens, benchmark items, languages, licences and personal data."""

import hashlib
import random

import tiktoken

from llm import brute
from loomtally.llm import byte_bpe, decontaminate, disclosure, language_id, license_scan
from loomtally.llm.queries import QUERIES, vocabulary

SCHEMA = "doc_id long, text string"
SMALL = "/root/testdata/sf0.001"


def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def encoding():
    import base64

    import public_tokenizers as P

    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_ids_are_those_of_the_whole_text(rows):
    rng = random.Random(1)
    parts = ["the ", "  ", "\n\n", "it's", " don't", "é", "漢字", "🙂", "12345", "!!", "<|endoftext|>", "\t", "x" * 70, " " * 90]
    docs = [(i, "".join(rng.choices(parts, k=k))) for i, k in enumerate([1, 5, 60, 400, 900])]
    docs += [(10, None), (11, ""), (12, docs[2][1]), (12, docs[2][1])]
    known, own = vocabulary(), encoding()
    for chunk, overlap in ((65_536, 4096), (64, 16), (40, 39)):
        encoded = byte_bpe.encode(rows(docs, SCHEMA), known, chunk, overlap)
        got = byte_bpe.decode(encoded, known).collect()
        key = lambda r: (r[0], r[1])
        assert sorted(((r.doc_id, list(r.ids)) for r in got), key=key) == sorted(((i, own.encode_ordinary(t or "")) for i, t in docs), key=key)
        texts = dict(docs)
        assert all(bytes(r.bytes).decode() == (texts[r.doc_id] or "") for r in got)


def test_ids_by_plain_merges(rows):
    import public_tokenizers as P

    known = vocabulary()
    rng = random.Random(6)
    parts = ["the", " quick", "  ", "é", "漢", "🙂", "x1", "\n", "'ll", "ing", "Qz", "ÿ"]
    docs = [(i, "".join(rng.choices(parts, k=60))) for i in range(12)] + [(20, "z" * 300)]
    got = {r.doc_id: list(r.ids) for r in byte_bpe.encode(rows(docs, SCHEMA), known, 50, 20).collect()}
    assert got == {i: brute.encoded(t, known.ranks(), P.PATTERN) for i, t in docs}


def test_one_long_text(rows):
    own = encoding()
    text = "A long text, of 3 million letters. " * 90_000
    [got] = byte_bpe.encode(rows([(1, text)], SCHEMA), vocabulary()).collect()
    assert list(got.ids) == own.encode_ordinary(text)


def test_token_digests(spark):
    own = encoding()
    got = {r.doc_id: r for r in QUERIES["op4_byte_bpe"](spark, SMALL).collect()}
    for r in documents(spark).collect():
        ids = own.encode_ordinary(r.text or "")
        assert got[r.doc_id].n_tokens == len(ids)
        assert got[r.doc_id].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[r.doc_id].decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()


def test_items_within_their_error_budget(rows):
    rng = random.Random(2)
    letters = "abcde "
    items = [(i, "".join(rng.choices(letters, k=n))) for i, n in enumerate([20, 45, 60, 100])] + [(8, None), (9, ""), (None, "abc")]
    docs = [(90, None), (91, ""), (92, "abc")]
    for i in range(16):
        item = list(items[i % 4][1])
        for _ in range(rng.randrange(8)):
            at = rng.randrange(len(item))
            item[at : at + 1] = rng.choice(["", "z", "zz"])
        docs.append((i, "".join(rng.choices(letters, k=60)) + "".join(item).upper() + "".join(rng.choices(letters, k=60))))
    expected = set()
    for doc_id, text in docs:
        for item_id, item in items:
            if text and item and item_id is not None:
                own = decontaminate.normalised(item)
                distance = brute.edit_distance(own, decontaminate.normalised(text))
                if distance <= len(own) * 5 // 100:
                    expected.add((doc_id, item_id, distance))
    benchmark = rows(items, "item_id long, text string")
    assert len(expected) > 3
    assert set(map(tuple, decontaminate.report(rows(docs, SCHEMA), benchmark).collect())) == expected
    kept = {r.doc_id for r in decontaminate.keep_uncontaminated(rows(docs, SCHEMA), benchmark).collect()}
    assert kept == {i for i, _ in docs} - {d for d, _, _ in expected}
    blocks = decontaminate.contaminated(rows(docs, SCHEMA), benchmark, block_chars=1)
    assert {(r.doc_id, r.item_id, r.distance) for r in blocks.collect()} == expected


def test_languages_of_held_out_documents(spark):
    labelled = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = language_id.identify(labelled, language_id.train(labelled))
    rows = found.join(labelled.select("doc_id", "lang"), "doc_id").where("held_out AND lang IS NOT NULL AND lang_pred <> 'und'").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.9 * len(rows) > 0
    assert all(0 <= r.score <= 1 for r in rows)


def test_code_lengths(rows):
    rng = random.Random(7)
    letters = {"aa": "abé ", "bb": "bcd漢", "cc": "xyz "}
    docs = [(i, "".join(rng.choices(letters[lang], k=rng.randrange(1, 60))), lang) for i, lang in enumerate(["aa", "bb", "cc"] * 12)]
    model = language_id.train(rows(docs, SCHEMA + ", lang string"))
    held = {r.doc_id for r in rows(docs, SCHEMA + ", lang string").where(language_id.is_held_out()).collect()}
    training = {lang: sorted({t.encode() for i, t, own in docs if own == lang and i not in held}) for lang in letters}
    asked = [(100 + i, "".join(rng.choices("abcdxyzé漢q ", k=rng.randrange(1, 50)))) for i in range(20)]
    got = {r.doc_id: r for r in language_id.identify(rows(asked, SCHEMA), model).collect()}
    for doc_id, text in asked:
        raw, r = text.encode(), got[doc_id]
        if not any(map(str.isalpha, text)):
            assert r.lang_pred == "und"
            continue
        bits = {lang: brute.code_length(raw, training[lang], language_id.ORDER) for lang in letters}
        best = min(bits, key=lambda lang: (bits[lang], lang))
        assert r.lang_pred == best and abs(r.bits_per_byte - bits[best] / len(raw)) < 1e-9
        assert abs(r.score - 1 / sum(2 ** (bits[best] - b) for b in bits.values())) < 1e-9


def test_texts_without_letters(spark, rows):
    model = language_id.train(documents(spark))
    docs = [(1, None), (2, ""), (3, "123 !?\n"), (4, "the thing"), (4, "the thing"), (None, "the thing")]
    got = language_id.identify(rows(docs, SCHEMA), model).collect()
    assert len(got) == 6 and {r.doc_id for r in got if r.lang_pred == "und"} == {1, 2, 3}
    assert not any(r.held_out for r in got if r.doc_id is None)
    assert {r.doc_id for r in language_id.keep_identified(rows(docs, SCHEMA), model).collect()} == {4, None}
    nothing = language_id.train(rows([], SCHEMA + ", lang string", 1))
    assert {r.lang_pred for r in language_id.identify(rows(docs, SCHEMA), nothing).collect()} == {"und"}


def test_licences(spark, rows):
    classifier = license_scan.train(documents(spark))
    assert classifier.held_out_accuracy >= 0.9
    rng = random.Random(3)
    filler = lambda n: " ".join(brute.words(n, rng))
    planted = {i: family for i, family in enumerate(license_scan.TEMPLATES)}
    docs = [(i, f"{filler(60)}\n{' '.join(license_scan.TEMPLATES[f])}\n{filler(50)}") for i, f in planted.items()]
    docs += [(50, filler(300)), (51, None), (52, "")]
    found = {(r.doc_id, r.family) for r in license_scan.licences(rows(docs, SCHEMA), classifier).collect()}
    assert set(planted.items()) <= found and not {d for d, _ in found} & {50, 51, 52}


def test_base_patterns():
    rng = random.Random(4)
    cases = ["", "a@b.c", "4111 1111 1111 1111", "+44 (20) 7946-0958.", "1.2.3.4.5.6.7.8", "300.1.1.1", "a@b@c.de.", "+1 2"]
    cases += ["".join(rng.choices("a1.@+- ()94é\n", k=rng.randrange(60))) for _ in range(3000)]
    cases += ["".join(rng.choices("0123456789 -", k=40)) for _ in range(500)]
    for text in cases:
        assert disclosure.base_spans(text) == brute.personal(text), text


def test_terms_that_disclose(rows):
    rng = random.Random(5)
    common = lambda: " ".join(f"c{rng.randrange(30)}" for _ in range(20))
    docs = [(i, f"{common()} zebrafish ann@example.org {common()}") for i in range(3)]
    docs += [(i, common()) for i in range(3, 60)] + [(70, None), (71, "")]
    frame = rows(docs, SCHEMA)
    spans = disclosure.find_spans(frame)
    got = {r.doc_id: r for r in disclosure.digests(spans).collect()}
    assert len(got) == 62 and all(got[i].n_email == 1 and "term:" in got[i].spans for i in range(3))
    assert all(got[i].spans == "" and got[i].n_email == 0 for i in range(3, 60))
    clean = {r.doc_id: r.text for r in disclosure.sanitised(frame, spans).collect()}
    assert all("zebrafish" not in clean[i] and "[email]" in clean[i] for i in range(3))
    assert all(clean[i] == t for i, t in docs if i >= 3)
