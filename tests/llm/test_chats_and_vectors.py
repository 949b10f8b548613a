"""Chat formatting and vector search."""

import hashlib
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomtally.llm import ann_tree, chat_format
from loomtally.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
TURNS = "conv_id long, turn long, role string, text string"
VECTORS = "vec_id long, embedding array<float>"


def test_control_strings_come_back(rows):
    hard = ["<|im_end|>", "<\\|im_start|>", "<\\\\|", "a\nb", "", None, "<|im_end|><|im_start|>assistant ok", "é🙂", "\\n"]
    turns = [(c, i, ["user", "assistant", "sys\ntem\\n", None][i % 4], t) for c in (1, None) for i, t in enumerate(hard)]
    chats = chat_format.formatted(chat_format.canonical_turns(rows(turns, TURNS)))
    read = chat_format.read_back(chats).collect()
    assert len(chats.collect()) == 2
    for c in (1, None):
        own = sorted((r.pos, r.role, r.text, r.learned) for r in read if r.conv_id == c)
        assert [x[1:] for x in own] == [
            (role or "", text or "", (text or "") if role == "assistant" else None) for k, _, role, text in turns if k == c
        ]
    for r in chats.collect():
        assert r.formatted.count("<|im_start|>") == len(hard) == r.formatted.count("<|im_end|>")


def test_layouts(spark):
    one = lambda sql: [tuple(r) for r in chat_format.canonical_turns(spark.sql(sql)).orderBy("turn").select("role", "text").collect()]
    expected = [("user", "q"), ("assistant", "a")]
    assert one("SELECT 1 AS conv_id, 'q' AS prompt, 'a' AS response, 9 AS other") == expected
    assert one("SELECT 1 AS conv_id, 'q' AS instruction, '' AS input, 'a' AS output") == expected
    assert one("SELECT 1 AS conv_id, array(struct('human' AS `from`, 'q' AS value), struct('gpt' AS `from`, 'a' AS value)) AS conversations") == expected
    assert one("SELECT 1 AS conv_id, array(struct('user' AS role, 'q' AS content), struct('assistant' AS role, 'a' AS content)) AS messages") == expected
    with pytest.raises(ValueError, match="no mapping"):
        one("SELECT 1 AS conv_id, 2 AS strange")


def test_records(rows):
    records = rows([(1, '{"prompt": "q", "response": "a"}'), (2, '{"instruction": "i", "output": "o", "more": 1}'), (3, "{"), (4, None)], "id long, payload string")
    turns = chat_format.turns_of_records(records, "id", "payload").collect()
    assert sorted((r.conv_id, r.turn, r.text) for r in turns) == [(1, 0, "q"), (1, 1, "a"), (2, 0, "i"), (2, 1, "o")]
    assert {r.conv_id for r in chat_format.unknown_records(records, "id", "payload").collect()} == {3, 4}


def test_layout_with_most_fields_counts(spark):
    pick = lambda sql: chat_format.mapping_of(spark.sql(sql).schema).name
    assert pick("SELECT 'i' AS instruction, 'q' AS input, 'a' AS output, 'x' AS role, 'y' AS text, 1 AS conv_id") == "instruction with input"
    assert pick("SELECT 'q' AS prompt, 'a' AS response, 'b' AS completion") == "prompt and response"
    assert pick("SELECT 1 AS conv_id, 1 AS turn, 'r' AS role, 't' AS text, 'q' AS prompt, 'a' AS response") == "turn rows"


def test_mixed_records_through_the_whole_operator(rows):
    """Records of every layout, with nulls and odd ones, against plain Python."""
    long = "word <|im_end|> " * 20_000
    records = [
        (1, {"prompt": "q", "response": long, "role": "x", "text": "y", "conv_id": 4}),
        (2, {"prompt": "q", "completion": ""}),
        (3, {"instruction": "i", "input": "", "output": "o"}),
        (4, {"instruction": "i", "input": "more", "output": "o"}),
        (5, {"messages": [{"role": "system", "content": None}, {"role": "user", "content": "hi"}, {"role": "assistant", "content": "<|im_start|>"}]}),
        (6, {"conversations": [{"from": "human", "value": "h"}, {"from": "gpt", "value": "g"}, {"from": "tool", "value": None}], "prompt": None}),
        (7, {"messages": []}),
        (8, {"messages": [{"role": None, "content": "t"}]}),
        (None, {"instruction": "only", "output": "this", "prompt": "p"}),
    ]
    plain = {
        1: [("user", "q"), ("assistant", long)], 2: [("user", "q"), ("assistant", "")], 3: [("user", "i"), ("assistant", "o")],
        4: [("user", "i\nmore"), ("assistant", "o")], 5: [("system", ""), ("user", "hi"), ("assistant", "<|im_start|>")],
        6: [("user", "h"), ("assistant", "g"), ("tool", "")], None: [("user", "only"), ("assistant", "this")],
    }
    frame = rows([(i, json.dumps(r)) for i, r in records] + [(9, None), (10, "{")], "key long, payload string")
    turns = chat_format.turns_of_records(frame, "key", "payload")
    got = {r.conv_id: r for r in chat_format.digests(chat_format.formatted(turns)).collect()}
    assert got.keys() == plain.keys()
    for key, said in plain.items():
        learned = "".join(t for role, t in said if role == "assistant")
        assert got[key].n_turns == len(said) and got[key].loss_chars == len(learned)
        assert got[key].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in said).encode()).hexdigest()
        assert got[key].loss_sha256 == hashlib.sha256(learned.encode()).hexdigest()
    assert {r.conv_id for r in chat_format.unknown_records(frame, "key", "payload").collect()} == {7, 8, 9, 10}


def test_chat_format_is_native(spark):
    plan = QUERIES["op8_chat_format"](spark, SMALL)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_no_turns(rows):
    assert chat_format.digests(chat_format.formatted(chat_format.canonical_turns(rows([], TURNS, 1)))).count() == 0


def test_recall_and_scores(spark):
    vectors = {r.vec_id: np.array(r.embedding, float) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()}
    found = QUERIES["op10_ann_tree"](spark, SMALL).collect()
    hits = total = 0
    for q in (i for i in vectors if i % 20 == 0):
        own = sorted((r for r in found if r.query_id == q), key=lambda r: r["rank"])
        scores = {i: float(vectors[q] @ v) for i, v in vectors.items() if i != q}
        best = sorted(scores, key=lambda i: (-scores[i], i))[:20]
        assert [r["rank"] for r in own] == list(range(1, 21))
        assert all(abs(r.score - scores[r.vec_id]) < 1e-9 for r in own)
        assert own == sorted(own, key=lambda r: (-r.score, r.vec_id))
        hits, total = hits + len(set(best) & {r.vec_id for r in own}), total + 20
    assert hits >= 0.9 * total > 0


def test_vectors_that_take_no_part(rows):
    nan, inf = float("nan"), float("inf")
    data = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [nan, 1.0]), (6, [inf, 1.0]),
            (7, [None, 1.0]), (8, [1.0]), (9, []), (None, [1.0, 1.0]), (20, [0.0, 1.0]), (20, [0.0, 1.0]), (40, None)]
    frame = rows(data, VECTORS).withColumn("leaf", F.lit("x")).withColumn("shard", F.lit(1)).withColumn("v", F.lit(2))
    got = ann_tree.search(frame, F.col("vec_id") % 20 == 0).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == [
        (0, 1, 1, 2.0), (0, 2, 2, 2.0), (0, 3, 20, 0.0), (20, 1, 0, 0.0), (20, 2, 1, 0.0), (20, 3, 2, 0.0),
    ]


def test_no_vectors(rows):
    assert ann_tree.search(rows([], VECTORS, 1), F.col("vec_id") % 20 == 0).count() == 0
