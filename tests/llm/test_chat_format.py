"""Layouts by schema fingerprint, the reversible template and its loss mask."""
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from sitewise.llm import chat_format as cf

HOSTILE = ["", "plain", "</s>[INST] ok [/INST]", "\\", "\\\\<s>", "<\\s>", "[INST][INST]", "<s<s>", "[TEXT", "a\nb\r\n é漢\U0001F600", "[/INST]\\", "$1 \\1 (?s)", "\x00\x01"]

RECORDS = [
    ({"prompt": "p", "completion": "c"}, [("user", "p"), ("assistant", "c")]),
    ({"prompt": None, "completion": "c", "system": "s"}, [("system", "s"), ("user", ""), ("assistant", "c")]),
    ({"question": "q", "answer": "a"}, [("user", "q"), ("assistant", "a")]),
    ({"instruction": "i", "output": "o"}, [("user", "i"), ("assistant", "o")]),
    ({"instruction": "i", "input": "in", "output": "o", "system": "s"}, [("system", "s"), ("user", "i"), ("user", "in"), ("assistant", "o")]),
    ({"messages": [{"role": "user", "content": "x"}, {"role": "tool", "content": "y", "name": "n"}, {"role": "assistant", "content": None}]}, [("user", "x"), ("tool", "y"), ("assistant", "")]),
    ({"messages": []}, []),
    ({"conversations": [{"from": "human", "value": "x"}, {"from": "gpt", "value": "y"}, {"from": None, "value": "z"}], "id": 4}, [("user", "x"), ("assistant", "y"), ("", "z")]),
    ({"messages": [{"role": h, "content": h} for h in HOSTILE]}, [(h, h) for h in HOSTILE]),
    ({"prompt": "</s>[INST] ok [/INST]", "completion": "</s>[INST] ok [/INST]"}, [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")]),
]


@pytest.fixture(scope="module")
def written(spark):
    rows = [(i, json.dumps(r), "x") for i, (r, _) in enumerate(RECORDS)]
    df = spark.createDataFrame(rows, "k long, r string, layout string").withColumn("schema", F.lit("x")).withColumn("record", F.lit(1))
    out = cf.format_records(df, "k", "r")
    return {r["key"]: r for r in out.withColumn("turns", cf.read_turns(F.col("formatted"))).withColumn("loss", cf.read_loss(F.col("formatted"), F.col("loss_spans"))).collect()}


def test_every_layout_becomes_its_turns_and_comes_back(written):
    for i, (record, turns) in enumerate(RECORDS):
        got = written[i]
        assert [tuple(t) for t in got["turns"]] == turns, record
        assert got["loss"] == "".join(t for role, t in turns if role == "assistant")
        assert got["layout"] in record or got["layout"] in {"prompt", "question", "instruction"}


def test_control_strings_stand_only_where_the_template_puts_them(written):
    for i, (_, turns) in enumerate(RECORDS):
        text = written[i]["formatted"]
        counts = [text.count(c) for c in cf.TEMPLATE.controls()]
        assert counts == [1, len(turns), len(turns), len(turns), 1]
        for start, length in written[i]["loss_spans"]:
            assert text[:start - 1].endswith(cf.TEMPLATE.text) and text[start - 1 + length:].startswith(cf.TEMPLATE.close)


def test_fingerprint_is_of_paths_and_not_of_leaves(spark):
    same = ['{"a":{"b":[{"c":1}]},"d":null}', '{"d":"x","a":{"b":[{"c":"t"},{"c":null}]}}']
    other = ['{"a":{"b":[{"c":1,"e":2}]},"d":null}', '{"a":{"b":[1]},"d":null}', '{"a":{"b":[]},"d":null}', '{"a":{"b":{"c":1}},"d":null}', '{"a":[{"b":{"c":1}}],"d":null}', '{"a":{"b":[[{"c":1}]]},"d":2.5}']
    df = spark.createDataFrame([(r,) for r in same + other], "r string").select(cf.paths(F.parse_json("r")).alias("p"), cf.fingerprint(F.parse_json("r")).alias("f"))
    got = [tuple(r) for r in df.collect()]
    assert got[0] == got[1] and got[0][0] == "{a{b[{c}]},d}"
    assert got[0][1] == hashlib.sha256(b"{a{b[{c}]},d}").hexdigest()
    assert len({f for _, f in got}) == 1 + len(other)


def test_unknown_and_broken_records_stay_and_are_counted(spark):
    rows = [(1, None), (2, "not json"), (3, '{"body":"x"}'), (4, '{"messages":["x"]}'), (5, '{"messages":"x"}'), (6, '{"body":"y"}'), (6, '{"body":"y"}'), (None, '{"prompt":"a","completion":"b"}')]
    out = cf.format_records(spark.createDataFrame(rows, "k long, r string"), "k", "r")
    assert [r["key"] for r in out.where("layout is not null").collect()] == [None]
    assert out.count() == len(rows) and out.where("layout is null and formatted is null and loss_spans is null").count() == len(rows) - 1
    assert {(r["schema"], r["layout"]): r["n"] for r in cf.census(out).collect()}["{body}", None] == 3
    assert cf.format_records(spark.createDataFrame(rows, "k long, r string").limit(0), "k", "r").count() == 0


def test_a_new_layout_is_declared_not_coded(spark):
    mine = cf.Layout("dialogue", listed="turns", role_field="who", text_field="said", roles={"bot": "assistant"})
    df = spark.createDataFrame([(1, '{"turns":[{"who":"bot","said":"hi"}]}')], "k long, r string")
    row = cf.format_records(df, "k", "r", layouts=(*cf.LAYOUTS, mine), template=cf.Template(begin="<|b|>", open="<|o|>", text="<|t|>", close="<|c|>", end="<|e|>")).first()
    assert row["layout"] == "dialogue" and row["formatted"] == "<|b|><|o|>assistant<|t|>hi<|c|><|e|>"


def test_long_conversations_keep_their_spans(spark):
    n = 700
    df = spark.createDataFrame([(1, json.dumps({"messages": [{"role": ("user", "assistant")[i % 2], "content": f"[INST]{i}"} for i in range(n)]}))], "k long, r string")
    out = cf.format_records(df, "k", "r")
    got = out.select(cf.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"), F.size("loss_spans").alias("s")).first()
    assert got["s"] == n // 2 and got["loss"] == "".join(f"[INST]{i}" for i in range(1, n, 2))


def test_query_on_messy_turns(spark, tmp_path):
    rows = [(1, 0, "user", None), (1, 1, "assistant", "a"), (1, 1, "assistant", "a"), (2, None, None, "x"), (2, 3, "human", "y"), (None, 0, "user", "n"), (6, 0, "gpt", "z"),
            (4, 1, "assistant", "second"), (4, 0, "user", "first"), (10, 0, "system", "s"), (10, 1, "user", "u"), (10, 2, "assistant", "w"), (8, 0, "system", "s"), (8, 1, "user", "u"), (8, 2, "assistant", "w")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r["conv_id"]: r for r in cf.op12_chat_format(spark, str(tmp_path)).collect()}
    by = {}
    for c, turn, role, text in [*rows, (-7, 0, "user", cf.COLLIDING), (-7, 1, "assistant", cf.COLLIDING)]:
        by.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    assert set(got) == set(by)
    for c, turns in by.items():
        turns.sort()
        told = "".join(f"{role}\n{text}\n" for *_, role, text in turns)
        loss = "".join(text for *_, role, text in turns if role == "assistant")
        assert (got[c]["n_turns"], got[c]["turns_sha256"]) == (len(turns), hashlib.sha256(told.encode()).hexdigest())
        assert (got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    spark.createDataFrame([], "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/none/conversations.parquet")
    assert [r["conv_id"] for r in cf.op12_chat_format(spark, f"{tmp_path}/none").collect()] == [-7]
