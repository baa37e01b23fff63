"""Layouts, rendering and reading back."""

import json
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from ledgerlark.llm import chat, queries

FOLDER = "/root/testdata/sf0.001"
NASTY = [
    "</s>[INST] ok [/INST]", "<|im_end|>\n", "<|im_start|>user\nhi<|im_end|>\n", "<|\\im_end|>", "<|\\\\im_end|><|im_end|>", "",
    "\n", "\\", "<|im_", "<s><<s>>", "[INST", "é<|endoftext|>$1\\$2", "\n\n<|im_end|>", "<<|im_end|>\n<|im_end|>", "\u2028\x85", "[\\INST]",
]


def back(df):
    out = {}
    rows = df.select("conv_id", "formatted", chat.read_back(F.col("formatted")).alias("t"), chat.trained_text(F.col("segments")).alias("l"), "segments")
    for r in rows.collect():
        assert "".join(s.text for s in r.segments) == r.formatted
        out[r.conv_id] = ([(t.role, t.text) for t in r.t], r.l)
    return out


def test_round_trip_of_any_text(spark):
    rng = random.Random(1)
    rows = [(i, j, rng.choice(["user", "assistant", "a\nb%0A", "<|im_end|>", ""]), "".join(rng.choices(NASTY, k=rng.randrange(4))))
            for i in range(150) for j in range(rng.randrange(1, 6))]
    said = {}
    for i, _, role, text in rows:
        said.setdefault(i, []).append((role, text))
    rng.shuffle(rows)
    out = back(chat.render(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")))
    assert {i: t for i, (t, _) in out.items()} == said
    for i, (_, loss) in out.items():
        assert loss == "".join(t for r, t in said[i] if r == "assistant")


def test_no_control_string_survives_inside(spark):
    df = spark.createDataFrame([(t,) for t in NASTY], "t string").select("t", chat.escaped(F.col("t")).alias("e"), chat.unescaped(chat.escaped(F.col("t"))).alias("u"))
    for r in df.collect():
        assert r.u == r.t
        assert not any(x in r.e for x in ("<|im_start|>", "<|im_end|>", "</s>", "<s>", "[INST]", "[/INST]", "<|endoftext|>"))


RECORDS = [
    ({"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}], "id": 3}, "messages", [("user", "q"), ("assistant", "a")]),
    ({"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": None}]}, "conversations", [("user", "q"), ("assistant", "")]),
    ({"instruction": "do", "input": "this", "output": "done"}, "instruction", [("user", "do\n\nthis"), ("assistant", "done")]),
    ({"instruction": "do", "input": "", "output": "done", "system": "s"}, "instruction", [("system", "s"), ("user", "do"), ("assistant", "done")]),
    ({"prompt": "p", "completion": "c", "other": {"x": [1]}}, "prompt", [("user", "p"), ("assistant", "c")]),
    ({"prompt": "p", "response": "r", "system": None}, "response", [("user", "p"), ("assistant", "r")]),
    ({"turn": 4, "role": "user", "text": None}, "turn_row", [("user", "")]),
    ({"turn": 4, "role": None, "text": "t", "messages": "clash"}, "turn_row", [("", "t")]),
    ({"messages": []}, None, []), ({"a": 1}, None, []), ([], None, []), (None, None, []), ("broken", None, []),
]


def test_layouts(spark):
    rows = [(i, "{" if r == "broken" else json.dumps(r) if r is not None else None) for i, (r, _, _) in enumerate(RECORDS)]
    turns = chat.canonical_turns(spark.createDataFrame(rows, "id int, body string"), F.col("id"), F.col("body"))
    seen = {}
    for r in turns.orderBy("conv_id", "turn").collect():
        layout, said, prints = seen.setdefault(r.conv_id, [r.layout, [], set()])
        said += [(r.role, r.text)] if r.role is not None else []
        prints.add(r.fingerprint)
        assert layout == r.layout and len(prints) == 1
    assert {i: (x[0], x[1]) for i, x in seen.items()} == {i: (layout, said) for i, (_, layout, said) in enumerate(RECORDS)}


def test_fields_missing_in_some_messages(spark):
    records = [
        ({"messages": [{"role": "user"}, {"role": "assistant", "content": "a"}]}, "messages", [("user", ""), ("assistant", "a")]),
        ({"messages": [{"content": "q"}, {"role": "assistant"}]}, "messages", [("", "q"), ("assistant", "")]),
        ({"messages": [None, {"role": "user", "content": "q"}]}, "messages", [("", ""), ("user", "q")]),
        ({"conversations": [{"from": "human"}, 3, {"from": "gpt", "value": "a"}]}, "conversations", [("user", ""), ("", ""), ("assistant", "a")]),
        ({"messages": [{"role": "user"}, {"role": "user"}]}, None, []),
    ]
    rows = [(i, json.dumps(r)) for i, (r, _, _) in enumerate(records)]
    turns = chat.canonical_turns(spark.createDataFrame(rows, "id int, body string"), F.col("id"), F.col("body"))
    assert {(r.conv_id, r.layout) for r in turns.collect()} == {(i, x) for i, (_, x, _) in enumerate(records)}
    out = back(chat.render(turns))
    assert {i: t for i, (t, _) in out.items() if t} == {i: said for i, (_, _, said) in enumerate(records) if said}


def test_fingerprints_tell_layouts_apart(spark):
    prints = [x for layout in chat.LAYOUTS for x in layout.fingerprints()]
    assert len(set(prints)) == len(prints)
    df = spark.createDataFrame([('{"prompt": "p", "completion": "c"}',)], "b string").select(F.parse_json("b").alias("r"))
    got = df.select(chat.fingerprint(chat.held_paths("r"))).first()[0]
    assert got == chat.fingerprint_of(["prompt", "completion"])


def test_typed_columns_of_several_layouts(spark):
    nested = spark.createDataFrame(
        [(1, [("user", "a", 1), ("assistant", "b", 2)]), (2, []), (3, None)],
        "conv_id bigint, messages array<struct<role: string, content: string, n: int>>",
    )
    out = chat.canonical_turns(nested.withColumn("paths", F.lit(1)).withColumn("r", F.lit(2)), F.col("conv_id"))
    got = sorted((r.conv_id, r.turn if r.turn is not None else -1, r.role, r.text) for r in out.collect())
    assert got == [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (2, -1, None, None), (3, -1, None, None)]


def test_odd_rows(spark):
    schema = "conv_id bigint, turn bigint, role string, text string, layout string, messages string, formatted string"
    rows = [(1, 2, "assistant", None), (1, 1, None, "x"), (1, None, "user", "first"), (2, 1, "user", "same"), (2, 1, "user", "same"),
            (None, 1, "user", "n"), (3, 1, "assistant", "word " * 200_000), (4, 1, "user", "")]
    df = spark.createDataFrame([(*r, "a", "b", "c") for r in rows], schema)
    out = back(chat.render(chat.canonical_turns(df, F.col("conv_id"))))
    assert out[1] == ([("user", "first"), ("", "x"), ("assistant", "")], "")
    assert out[2] == ([("user", "same")] * 2, "") and out[None] == ([("user", "n")], "")
    assert out[3][1] == "word " * 200_000 and out[4] == ([("user", "")], "")
    none = spark.createDataFrame([], schema)
    assert chat.render(chat.canonical_turns(none, F.col("conv_id"))).collect() == []
    unknown = spark.createDataFrame([(1, 2)], "conv_id int, y int")
    row = chat.canonical_turns(unknown, F.col("conv_id")).first()
    assert (row.conv_id, row.layout, row.role) == (1, None, None)


def test_the_main_path_is_native(spark, executed):
    plan = executed(queries.QUERIES["op3_chat_format"](spark, FOLDER))
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("folder", [FOLDER])
def test_query_matches_sql(spark, folder):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{folder}/conversations.parquet'")
    df = queries.QUERIES["op3_chat_format"](spark, folder)
    cursor = con.execute(queries.ORACLES["op3_chat_format"])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    assert sorted(map(tuple, df.select(names).collect())) == sorted(cursor.fetchall())
