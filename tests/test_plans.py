"""Plan checks: native expressions only, one JSON parse per row, pruned scans."""

from conftest import SF_SMALL
from shoal.plans import stages as S
from shoal.plans.profiles import PROFILES
from shoal.sources.envelope import device_messages


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_stage1_has_no_python_and_parses_once(spark):
    p = PROFILES["e7"]
    text = plan_text(S.stage1(device_messages(spark, SF_SMALL, p.family), p))
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text
    assert text.count("parseJson(value") == 1
    # stage 1 is narrow: the only exchange allowed is the round-robin spread of a
    # single-file input over the cores (no hash shuffle on any key)
    assert "hashpartitioning" not in text
    assert text.count("Exchange") == text.count("RoundRobinPartitioning")


def test_envelope_scan_is_pruned(spark):
    text = plan_text(device_messages(spark, SF_SMALL).select("value"))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string,value:double,props:string>" in text
    ids = plan_text(spark.read.parquet(f"{SF_SMALL}/events.parquet").select("event_id"))
    assert "ReadSchema: struct<event_id:bigint>" in ids


def test_time_is_found_once(spark):
    """Filter, date, hour and output read one found epoch: as many places name its key as in
    one walk of the document."""
    from shoal.functions import jsonfn as J
    from shoal.operators import filters as FL
    from shoal.plans import driver_queries as DQ

    one = plan_text(FL.with_doc(device_messages(spark, SF_SMALL)).select(J.json_find("doc", "event_time").alias("t")))
    for name in ("time_filter", "epoch_buckets", "epoch_normalised"):
        assert plan_text(DQ.QUERIES[name](spark, SF_SMALL)).count("event_time") <= one.count("event_time") + 1


def test_stage2_only_shuffles_key_names(spark):
    from shoal.operators import refine as R

    p = PROFILES["m7"]
    s1 = S.stage1(device_messages(spark, SF_SMALL, p.family), p)
    prepared = R.prepare(s1, p)
    keys_plan = plan_text(prepared.select(__import__("pyspark.sql.functions", fromlist=["F"]).explode(
        __import__("pyspark.sql.functions", fromlist=["F"]).map_keys(R.payload_map())).alias("k")).distinct())
    assert "HashAggregate" in keys_plan  # partial aggregation before the exchange
    table_plan = plan_text(R.refine(R.flatten(prepared, p, R.discover_keys(prepared)), p))
    assert "hashpartitioning" not in table_plan
    assert table_plan.count("parseJson(value") == 2  # stage 1 once, stage 2 once
