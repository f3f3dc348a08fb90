"""Chat formatting against plain Python, DuckDB SQL and hand-written logs."""

import hashlib

import duckdb
import pytest
from pyspark.sql import functions as F

from shoal.llm import chat, oracles, queries

SF = "/root/testdata/sf0.001"
T = chat.Template()


def test_query_against_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{SF}/conversations.parquet')")
    df = queries.QUERIES["op12_chat_format"](spark, SF)
    rel = con.execute(oracles.ORACLES["op12_chat_format"])
    at = [[d[0] for d in rel.description].index(c) for c in df.columns]
    assert sorted(map(tuple, df.collect())) == sorted(tuple(r[i] for i in at) for r in rel.fetchall())


def test_no_python_in_the_plan(spark):
    plan = queries.QUERIES["op12_chat_format"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and plan.count("Exchange hashpartitioning") == 1


def folded(spark, events):
    log = spark.createDataFrame(events, "conv_id long, turn long, message long, seq long, kind string, role string, text string")
    return [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in chat.fold(log).orderBy("conv_id", "turn", "message").collect()]


def test_fold(spark):
    o, d, e, g = chat.OPEN, chat.DELTA, chat.EDIT, chat.REGENERATE
    events = [
        (1, 0, 10, 1, o, "user", None), (1, 0, 10, 3, d, None, "lo"), (1, 0, 10, 2, d, None, "hel"),  # out of order
        (1, 1, 11, 4, o, "assistant", None), (1, 1, 11, 5, d, None, "bad"), (1, 1, 11, 5, d, None, "bad"),  # delivered twice
        (1, 2, 12, 6, o, "user", "swept away"), (1, 2, 12, 7, d, None, "!"),
        (1, 1, 11, 8, g, None, ""), (1, 1, 11, 9, d, None, "good"), (1, 2, 12, 10, d, None, "late"),
        (1, 2, 13, 11, o, "user", "again"), (1, 2, 13, 12, e, None, "edited"), (1, 2, 13, 13, d, None, "+"), (1, 2, 13, 14, d, None, None),
        (2, 0, 1, 1, d, None, "never opened"),
        (None, None, 1, 1, o, None, "a"), (None, 0, 2, 2, o, "tool", "b"),
        (3, 0, 1, 1, o, "user", "one"), (3, 0, 2, 2, o, "user", "one"),
    ]
    assert folded(spark, events) == [
        (None, None, "", "a"), (None, 0, "tool", "b"), (1, 0, "user", "hello"), (1, 1, "assistant", "good"), (1, 2, "user", "edited+"),
        (3, 0, "user", "one"), (3, 0, "user", "one")]
    assert folded(spark, events[:0] + [(2, 0, 1, 1, d, None, "x")]) == []


TEXTS = ["</s>[INST] ok [/INST]", "", None, "plain", "<\\/s> <\\\\/s>", "[[INST]] <<s>> [/TURN][ROLE]x[/ROLE]", "line\nbreak <s", "[INST", "\\", "Ω 🙂 [/SYSTEM_PROMPT]",
         "x" * 300_000 + "</s>" * 1000, "<s>" * 3 + "\\</s>"]


@pytest.mark.parametrize("roles", [("user", "assistant"), ("system", "assistant"), ("tool", "assistant"), ("[/ROLE]", None), ("assistant", "assistant")])
def test_every_text_is_read_back(spark, roles):
    rows = [(c, t, roles[t], x) for c, x in enumerate(TEXTS) for t in (0, 1)]
    df = spark.createDataFrame([(*r, "k", 0) for r in rows], "conv_id long, turn long, role string, text string, message string, seq int")
    got = {r["conv_id"]: r for r in chat.digests(df).collect()}
    for c, x in enumerate(TEXTS):
        said = "".join(f"{r or ''}\n{x or ''}\n" for r in roles)
        loss = "".join(x or "" for r in roles if r == "assistant")
        assert (got[c]["n_turns"], got[c]["turns_sha256"]) == (2, hashlib.sha256(said.encode()).hexdigest()), x
        assert (got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_escape_leaves_no_control_string(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS if t is not None], "t string").select("t", T.escape(F.col("t")).alias("e")) \
        .select("t", "e", T.unescape(F.col("e")).alias("back"))
    for r in df.collect():
        assert r["back"] == r["t"] and not any(c in r["e"] for c in T.controls)


def test_nulls_ties_and_empty_table(spark):
    schema = "conv_id long, turn long, role string, text string"
    rows = [(None, None, "user", "a"), (None, None, "assistant", "b"), (None, 0, "user", "c"), (5, 1, "user", "same"), (5, 1, "user", "same")]
    got = {r["conv_id"]: r for r in chat.digests(spark.createDataFrame(rows, schema)).collect()}
    want = "assistant\nb\nuser\na\nuser\nc\n"
    assert got[None]["n_turns"] == 3 and got[None]["turns_sha256"] == hashlib.sha256(want.encode()).hexdigest()
    assert got[5]["n_turns"] == 2 and got[5]["turns_sha256"] == hashlib.sha256(b"user\nsame\nuser\nsame\n").hexdigest()
    assert chat.digests(spark.createDataFrame([], schema)).count() == 0


def test_log_of_long_messages_folds_back(spark):
    rows = [(c, t, "assistant" if t % 2 else "user", f"{c}/{t} " * (c * 7 % 300)) for c in range(40) for t in range(4)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    log = chat.as_log(df, 16)
    kinds = {r["kind"]: r["count"] for r in log.groupBy("kind").count().collect()}
    assert set(kinds) == {chat.OPEN, chat.DELTA, chat.EDIT, chat.REGENERATE} and kinds[chat.OPEN] > len(rows)
    assert sorted(tuple(r) for r in chat.fold(log).select("conv_id", "turn", "role", "text").collect()) == sorted(rows)
