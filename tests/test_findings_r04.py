"""Findings of round 4."""

import datetime as dt
import json
import random

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

import __spark_entry__ as E
from shoal.functions import jsonfn as J
from shoal.functions import jsonsql as Q
from shoal.operators import filters as FL


def test_events_of_one_device_at_one_time_are_not_seen_before(spark, tmp_path):
    at = [dt.datetime(2024, 1, 5, 1, 2, 3, 4000), dt.datetime(2024, 1, 20)]
    ids = [10 * k + 6 for k in range(40)] + [10 * k + 2 for k in range(40)]
    table = pa.table({"event_id": ids, "ts": pa.array([at[k % 2] for k in range(80)], pa.timestamp("us")), "user_id": [7] * 80,
                      "event_type": ["view"] * 80, "value": [1.5] * 80, "props": ["{}"] * 80})
    pq.write_table(table, f"{tmp_path}/events.parquet")
    assert E.queries()["stream_seen_events"](spark, str(tmp_path)).count() == 80


def test_equal_messages_are_dropped_in_a_batch(spark):
    at = dt.datetime(2024, 1, 5)
    df = spark.createDataFrame([("m1", at, 1, "a"), ("m1", at, 2, "b"), ("m1", at, 1, "a"), ("m2", at, 1, "c")], "device string, at timestamp, message long, value string")
    assert sorted(r["value"] for r in FL.drop_seen(df, "1 day").collect()) == ["a", "b", "c"]


def test_plain_texts_are_changed_as_by_their_tokens(spark, monkeypatch):
    rnd = random.Random(5)
    keys = ["mac", "hw_type", "a.b", "@x@", "k-1", "k-1.é", "a b-c@", "", "e[", "{", "mac:", "-", ".", "hw.type", "hw-type"]

    def value(d):
        if d and rnd.random() < 0.7:
            return {rnd.choice(keys): value(d - 1) for _ in range(rnd.randint(0, 4))}
        if rnd.random() < 0.3:
            out = [value(min(d, 1)) for _ in range(2)]
            for _ in range(rnd.choice([0, 0, 11, 14])):
                out = [out]
            return out
        return rnd.choice([None, True, 1.5, -3, 1e200, "", "a.b", '{"mac":"y"}', "mac", "[", "],", "}:,", "$1é"])

    docs = [json.dumps({rnd.choice(keys): value(5) for _ in range(3)}, ensure_ascii=False) for _ in range(1500)]
    docs += [json.dumps({"n-o": {"hw_type": last}}) for last in (None, {}, {"hw_type": 1}, [[1]], "x", "a\\b")]
    df = FL.with_doc(spark.createDataFrame([(d, "q$1\\\"") for d in docs], "value string, said string").repartition(8))

    def changed():
        cols = {"clean": J.json_sanitize_keys("doc"), "strict": J.json_sanitize_keys("doc", strict=True), "put": J.json_replace("doc", "hw_type", "v$7\\"),
                "both": J.json_rewrite("doc", replace={"hw_type": "v7", "a_b": "1"}), "copy": J.json_copy("doc", "mac", "hw_type")}
        cols = {n: J.doc_to_json(c) for n, c in cols.items()}
        cols |= {"mac": J.json_find("doc", ["mac", "k-1"], 1), "odd": J.json_find("doc", ["a b-c@", "e["], 1)}
        return sorted(tuple(r) for r in df.select("value", *[F.coalesce(c, F.lit("none")).alias(n) for n, c in cols.items()]).collect())

    got = changed()
    assert len(got) == len(docs)
    monkeypatch.setattr(Q, "plain", lambda text: "false")
    monkeypatch.setattr(Q, "_past", lambda but: "(?!)")  # a search that finds nothing at the start
    monkeypatch.setattr(Q, "find_in", lambda text, value, keys: Q.tokens(text, *found_by_tokens(value, keys)))
    assert got == changed()


def found_by_tokens(value, keys):
    """``find_in`` by the entry list, whatever the text."""
    flat = Q.entry_list(Q.as_object(value))
    hit = f"CAST(get(filter({flat}, x -> x.kind = 1Y AND x.key IN ({', '.join(map(Q.lit, keys))}) AND CAST(x.value AS STRING) IS NOT NULL), 0).value AS STRING)"
    return (lambda t: hit), hit


def test_deep_documents_are_not_cut_into_tokens(spark):
    text = '{"n-o":{"a.b":1,"n-o":' * 30 + '{"mac":"m1","hw_type":"raw","odd":null}' + "}" * 60
    df = FL.with_doc(spark.createDataFrame([(text,)] * 8, "value string"))
    kind = lambda deeper: "STRING" if deeper.startswith("CAST(") else "VARIANT"
    whole, Q.tokens = Q.tokens, lambda text, body, deeper: f"CAST(raise_error('cut into tokens') AS {kind(deeper)})"
    try:
        cols = [J.json_find("doc", "mac"), J.doc_to_json(J.json_rewrite("doc", replace={"hw_type": "v7"})), J.doc_to_json(J.json_copy("doc", "mac", "odd"))]
        found = df.select(*cols).distinct().collect()
    finally:
        Q.tokens = whole
    clean = text.replace("a.b", "a_b").replace("raw", "v7").replace('"mac":"m1","hw_type":"v7","odd":null', '"hw_type":"v7","mac":"m1","odd":null')
    assert [tuple(r)[:2] for r in found] == [("m1", clean)] and found[0][2].endswith('"odd":"m1"}') and '"odd":null' not in found[0][2]
