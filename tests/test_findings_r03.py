"""Findings of round 3: larger tables, deeper documents, longer streams than the small tables give."""

import datetime as dt
import json
import os
import random
import time

import pyarrow as pa
import pyarrow.parquet as pq

import __spark_entry__ as E
from shoal.functions import jsonfn as J
from shoal.functions import jsonsql as Q
from shoal.operators import filters as FL
from shoal.operators import refine as R
from shoal.operators import typed as TY
from shoal.plans.profiles import PROFILES
from shoal.sources import envelope

KINDS = ("view", "click", "error")


def events(folder, rows):
    """A folder with the table ``events``; rows are (event_id, ts, event_type, props)."""
    ids, ts, kinds, props = zip(*rows, strict=True)
    table = pa.table({"event_id": pa.array(ids, pa.int64()), "ts": pa.array(ts, pa.timestamp("us")),
                      "user_id": pa.array([i % 97 for i in ids], pa.int64()), "event_type": pa.array(kinds),
                      "value": pa.array([i / 8 for i in ids]), "props": pa.array(props)})
    os.makedirs(folder, exist_ok=True)
    pq.write_table(table, f"{folder}/events.parquet")
    return str(folder)


def test_quarantine_of_more_files_than_a_batch_takes(spark, tmp_path):
    start = dt.datetime(2024, 1, 1, 0, 30)
    sf = events(tmp_path, [(10 * k + 6, start + dt.timedelta(hours=k), KINDS[k % 3], '{"k": 1}') for k in range(1100)])
    assert E.queries()["stream_quarantine_replay"](spark, sf).count() == 1100


def test_compaction_of_files_above_the_smallest_target(spark, tmp_path):
    rnd, at = random.Random(3), dt.datetime(2024, 1, 5)
    sf = events(tmp_path, [(k, at, KINDS[k // 50 % 3], f'{{"k": "{rnd.randbytes(60_000).hex()}"}}' if k % 10 in (2, 6) else "{}") for k in range(300)])
    assert E.queries()["stream_compacted"](spark, sf).count() == 60


def test_very_deep_documents_take_time_in_proportion(spark):
    levels = 800
    text = '{"n-o":{"a.b":[1,{"mac":"x"}],"n-o":' * (levels // 2) + '{"mac":"m1","hw_type":"raw"}' + "}" * levels
    df = FL.with_doc(spark.createDataFrame([(text,)] * 640, "value string").repartition(8))
    started = time.time()
    found = df.select(J.json_find("doc", "mac").alias("mac"), J.doc_to_json(J.json_rewrite("doc", replace={"hw_type": "v7"})).alias("t")).collect()
    assert {r["mac"] for r in found} == {"m1"} and time.time() - started < 35
    assert {r["t"] for r in found} == {text.replace('"n-o":{"a.b":[1,{"mac":"x"}],"n-o":', '"n-o":{"a_b":[1,{"mac":"x"}],"n-o":').replace("raw", "v7")
                                       .replace('{"mac":"m1","hw_type":"v7"}', '{"hw_type":"v7","mac":"m1"}')}


def test_tokens_and_entry_list_walk_alike(spark):
    rnd = random.Random(11)
    keys = ["mac", "hw_type", "a.b", "@x", "k-1", 'q"', "b\\", "", "e[", "{", "mac:"]

    def value(d):
        if d and rnd.random() < 0.6:
            return {rnd.choice(keys): value(d - 1) for _ in range(rnd.randint(0, 3))}
        if rnd.random() < 0.25:
            out = [value(min(d, 1)) for _ in range(2)]
            for _ in range(rnd.choice([0, 0, 14])):
                out = [out]
            return out
        return rnd.choice([None, True, 1.5, 1e200, "", 'a"b', '{"mac":"y"}', "[", "],", "\\", "\u2028é"])

    docs = [json.dumps({rnd.choice(keys): value(6) for _ in range(3)}) for _ in range(400)]
    df = FL.with_doc(spark.createDataFrame([(d,) for d in docs], "value string").repartition(8))
    flat = Q.entry_list("doc")
    hit = f"CAST(get(filter({flat}, x -> x.kind = 1Y AND x.key IN ('mac', 'q\"') AND CAST(x.value AS STRING) IS NOT NULL), 0).value AS STRING)"
    got = df.selectExpr(f"{Q.find_below('to_variant_object(doc)', ['mac', 'q' + chr(34)])} AS a", f"{hit} AS b").where("NOT (a <=> b)")
    assert got.count() == 0


def test_a_large_row_group_is_dealt_over_more_tasks(spark, tmp_path, monkeypatch):
    sf = events(tmp_path, [(k, dt.datetime(2024, 1, 5), KINDS[k % 3], f'{{"k": {k}}}') for k in range(20_000)])
    cores = spark.sparkContext.defaultParallelism
    assert envelope.read_table(spark, sf, "events").rdd.getNumPartitions() == cores
    monkeypatch.setattr(envelope, "TASK_BYTES", 4 << 10)
    dealt = envelope.read_table(spark, sf, "events")
    assert dealt.rdd.getNumPartitions() > 2 * cores and dealt.distinct().count() == 20_000


def test_evidence_reads_each_type_of_a_key_once(spark):
    rows = [(json.dumps({"metrics": {"a": k, "b": k / 4, "c": {"d": k}}, "thedate": "2024-01-01"}),) for k in range(300)]
    found = TY.evidence(R.prepare(spark.createDataFrame(rows, "value string"), PROFILES["m7"]))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 2
    assert TY.types(r.asDict() for r in found.collect()) == {"a": "bigint", "b": "decimal(38,2)", "c": "string"}
