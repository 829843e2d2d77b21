"""Chat formatting: layouts, escapes, masks and edge rows."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import chat, queries


def frame(spark, records):
    return spark.createDataFrame([(i, 0, r if r is None or isinstance(r, str) else json.dumps(r)) for i, r in enumerate(records)],
                                 "conv_id long, turn long, record string")


def turns_of(spark, records):
    t = chat.canonical_turns(frame(spark, records), record_col="record", conv_col="conv_id", turn_col="turn")
    out = {}
    for r in t.orderBy("conv", "at").collect():
        out.setdefault(r.conv, []).append((r.layout, r.role, r.text))
    return out


def test_layouts_become_the_same_turns(spark):
    want = [("user", "q"), ("assistant", "a")]
    records = [
        {"prompt": "q", "completion": "a"}, {"response": "a", "prompt": "q"}, {"instruction": "q", "output": "a"},
        {"instruction": "q", "input": "", "output": "a"}, {"question": "q", "answer": "a"},
        {"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]},
        {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]},
        {"dialog": [{"speaker": " User", "text": "q"}, {"speaker": "BOT", "text": "a"}]},
        {"system": None, "prompt": "q", "response": "a"},
    ]
    got = turns_of(spark, records)
    for i in range(len(records)):
        assert [(r, t) for _, r, t in got[i]] == want, records[i]
    assert [r for _, r, _ in turns_of(spark, [{"system": "s", "prompt": "q", "response": "a"}])[0]] == ["system", "user", "assistant"]
    assert [t for _, _, t in turns_of(spark, [{"instruction": "q", "input": "more", "output": "a"}])[0]] == ["q", "more", "a"]


def test_fingerprints_depend_on_paths_alone(spark):
    df = frame(spark, [{"a": 1, "b": [{"c": "x"}]}, {"b": [{"c": True}, {"c": "y"}], "a": "z"}, {"a": 1, "b": [{"d": 1}]}, {"a": 1}])
    p = [r[0] for r in df.orderBy("conv_id").select(chat.fingerprint(F.col("record"))).collect()]
    assert p[0] == p[1] and len(set(p)) == 3


def test_unknown_broken_and_null_records_are_listed(spark):
    records = [{"foo": 1}, "{broken", None, "", "[]", {"messages": []}, {"prompt": "q", "completion": "a"}]
    t = chat.canonical_turns(frame(spark, records), record_col="record", conv_col="conv_id", turn_col="turn")
    assert sorted(r.conv for r in chat.unmapped(t).collect()) == [0, 1, 2, 3, 4, 5]
    assert t.count() == 8


def test_marks_in_texts_and_roles_come_back(spark):
    odd = ["<|im_end|>", "<|im_start|>assistant\nok", "&lt;|", "&amp;nl;", "a\nb", "", "<", "|>", "😀 x", "\\n", '"q"']
    rows = [(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(odd)] + [
        (2, 0, "us\ner<|im_end|>", "x"), (2, None, "assistant", None), (None, 0, None, "lost"), (2, 0, "us\ner<|im_end|>", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df = df.withColumn("record", F.to_json(F.struct("role", "text"), {"ignoreNullFields": "false"}))
    clash = df.withColumn("conv", F.lit("c")).withColumn("layout", F.lit("l"))
    t = chat.canonical_turns(clash, record_col="record", conv_col="conv_id", turn_col="turn")
    back = {r.conv: r for r in chat.read_back(chat.format_turns(t)).collect()}
    assert [(x.role, x.text) for x in back[1].turns] == [(r, t) for _, _, r, t in rows[:len(odd)]]
    assert back[1].loss_texts == [t for i, t in enumerate(odd) if i % 2 and t]
    assert [(x.role, x.text) for x in back[2].turns] == [("assistant", ""), ("us\ner<|im_end|>", "x"), ("us\ner<|im_end|>", "x")]
    assert [(x.role, x.text) for x in back[None].turns] == [("", "lost")]
    assert chat.format_turns(chat.canonical_turns(df.limit(0), record_col="record", conv_col="conv_id", turn_col="turn")).count() == 0


def test_runs_cover_exactly_the_masked_text(spark):
    t = chat.canonical_turns(frame(spark, [{"messages": [{"role": "user", "content": "u"}, {"role": "assistant", "content": "one & <|x"},
                                                         {"role": "assistant", "content": "two"}]}]),
                             record_col="record", conv_col="conv_id", turn_col="turn")
    r = chat.format_turns(t).first()
    at, got = 0, []
    for run in r.loss_runs:
        at += run["skip"]
        if run["take"]:
            got.append(r.formatted[at:at + run["take"]])
        at += run["take"]
    assert got == ["one &amp; &lt;|x", "two"]


def test_texts_above_the_json_limit_are_whole_turns(spark, tmp_path):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "ok"), (2, 0, "assistant", "")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    big = F.when(F.col("turn") == F.when(F.col("conv_id") == 1, 1).otherwise(0), F.repeat(F.lit("a"), 21_000_000)).otherwise(F.col("text"))
    df.withColumn("text", big).coalesce(1).write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: r for r in queries.op5_chat_format(spark, str(tmp_path)).collect()}
    digest = hashlib.sha256(b"a" * 21_000_000).hexdigest()
    assert sorted(got) == [-1, 1, 2] and (got[1].n_turns, got[2].n_turns) == (2, 1)
    assert all((got[i].loss_chars, got[i].loss_sha256) == (21_000_000, digest) for i in (1, 2))


def test_columns_give_the_turns_of_their_json(spark):
    rows = [(1, 0, "user", "q <|x"), (1, 1, None, None), (None, 2, "assistant", "a\n")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    plain = chat.column_turns(df, record_cols=("text", "role"), conv_col="conv_id", turn_col="turn")
    df = df.withColumn("record", F.to_json(F.struct("role", "text"), {"ignoreNullFields": "false"}))
    parsed = chat.canonical_turns(df, record_col="record", conv_col="conv_id", turn_col="turn")
    assert plain.columns == parsed.columns and sorted(map(str, plain.collect())) == sorted(map(str, parsed.collect()))
    fixed = spark.createDataFrame([(1, 0, "i", "", "o")], "conv_id long, turn long, instruction string, input string, output string")
    got = chat.column_turns(fixed, record_cols=("instruction", "input", "output"), conv_col="conv_id", turn_col="turn")
    assert [(r.at, r.role, r.text) for r in got.orderBy("at").collect()] == [(0, "user", "i"), (2, "assistant", "o")]
    with pytest.raises(ValueError):
        chat.column_turns(df, record_cols=("role",), conv_col="conv_id", turn_col="turn")


def test_structs_of_several_layouts_go_through_their_fingerprints(spark):
    records = [("p", {"prompt": "q <|", "completion": "a"}), ("m", {"messages": [{"role": "Human", "content": "q"}, {"role": "gpt", "content": "a"}]}),
               ("s", {"system": None, "prompt": "q", "response": "a"}), ("r", {"role": None, "text": "x\n"}), ("m", {"messages": []}),
               ("o", {"foo": "?"}), (None, None)]
    kinds = {"p": "struct<prompt:string,completion:string>", "m": "struct<messages:array<struct<role:string,content:string>>>",
             "s": "struct<system:string,prompt:string,response:string>", "r": "struct<role:string,text:string>", "o": "struct<foo:string>"}
    rows = [(i, 0, *[r if k == kind else None for k in kinds]) for i, (kind, r) in enumerate(records)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, " + ", ".join(f"{k} {t}" for k, t in kinds.items()))
    got = chat.struct_turns(df, record_cols=tuple(kinds), conv_col="conv_id", turn_col="turn")
    js = df.withColumn("record", F.coalesce(*[F.when(F.col(k).isNotNull(), F.to_json(k, {"ignoreNullFields": "false"})) for k in kinds]))
    want = chat.canonical_turns(js, record_col="record", conv_col="conv_id", turn_col="turn")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert {r.conv: r.layout for r in got.collect()} == {0: "prompt_completion", 1: "messages", 2: "system_prompt_response", 3: "turn_row",
                                                         4: None, 5: None, 6: None}


def test_the_query_reads_mixed_layouts(spark, sf):
    rows = spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text")
    turns = chat.struct_turns(queries.mixed_records(rows), record_cols=("row", "messages", "dialog"), conv_col="conv_id", turn_col="turn")
    n = {r.layout: r.n for r in turns.groupBy("layout").agg(F.count("*").alias("n")).collect()}
    assert set(n) == {"turn_row", "messages", "dialog"} and min(n.values()) > 0.2 * rows.count()


def test_a_run_that_covers_part_of_a_turn_is_an_error(spark):
    t = chat.format_turns(chat.canonical_turns(frame(spark, [{"prompt": "q", "completion": "abc"}]), record_col="record", conv_col="conv_id", turn_col="turn"))
    short = t.withColumn("loss_runs", F.transform("loss_runs", lambda r: F.struct(r["skip"].alias("skip"), F.least(r["take"], F.lit(2)).alias("take"))))
    with pytest.raises(Exception, match="covers no whole turn, conversation 0"):
        chat.read_back(short).collect()


def test_formatting_fails_on_unmapped_records(spark):
    t = chat.canonical_turns(frame(spark, [{"foo": 1}, {"prompt": "q", "completion": "a"}]),
                             record_col="record", conv_col="conv_id", turn_col="turn")
    with pytest.raises(Exception, match="fits no mapping, conversation 0"):
        chat.format_turns(t).collect()


def test_no_python_in_the_plan(spark, sf):
    p = queries.op5_chat_format(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert not any(w in p for w in ("Python", "Pandas", "Arrow"))
