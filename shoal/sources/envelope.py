"""Device JSON built by Spark from the ``events`` table (input of the driver queries).

Each ``events`` row becomes one JSON message of a device family (``events`` or
``metrics``).  The message shape is fixed by ``event_id % 10`` so that every path of the
pipeline is exercised on every scale of the table, and so that the expected result of
each query is a short SQL expression over the raw columns:

=====  ==============================================  ================================
class  change                                          expected
=====  ==============================================  ================================
0      no ``mac_address``                              dropped (no device)
1      epoch text with a trailing ``x``                dropped (not digits)
2      epoch in seconds, as a JSON number              kept, same date and hour
3      epoch moved far into the future                 dropped (implausible)
4      epoch in 2008                                   dropped (implausible)
5      text cut short, not JSON                        dropped (malformed)
6      extra keys ``a-b``, ``c-d`` (object), ``e f``,   kept; keys ``a_b``, ``c-d``,
       ``@g``                                          ``e_f``, ``g``
7      ``sub_type`` with ``%``                         dropped by type hygiene only
8      ``sub_type`` with ``?``                         dropped by type hygiene only
9      no ``sub_type``, ``event_type``, ``hw_type``    kept by the stream filters
=====  ==============================================  ================================
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


# Fixed values of the fixture (mirrored in the oracle SQL).
FUTURE_SHIFT_MS = 30_000_000_000_000  # about 950 years
PAST_SHIFT_MS = 500_000_000_000  # about 16 years back, into 2008
TYPE_NAMES = {"view": "VOD-VIEW", "click": "HOTKEY", "error": "SYSTEM-ERROR"}
TASK_BYTES = 1 << 20  # of a table's files, for one task: some 50,000 events
MAX_TASKS = 20_000
TIME_KEYS = {"events": "event_time", "metrics": "epoch_time"}


def spread(df: DataFrame) -> DataFrame:
    """Make sure CPU-heavy per-row work on a test table gets every core.

    A scan yields one task per file split; an unsplittable input (one row group, one
    compressed file) gives a single task however many cores there are, and a large table of
    few row groups a few long ones.  When the scan has fewer partitions than the cluster's
    parallelism, or than ``TASK_BYTES`` of its files fill, the rows are dealt round-robin
    over that many, so a task's work doesn't grow with the table; otherwise nothing changes
    and no shuffle is added.  Looks at the plan only; runs no job."""
    try:
        size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
        cores = df.sparkSession.sparkContext.defaultParallelism
        want = cores * max(1, -(-min(size // TASK_BYTES, MAX_TASKS) // cores))  # full rounds of all cores
        have = df.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001 — no RDD view (e.g. a Connect session): leave as is
        return df
    return df.repartition(want) if have < want else df


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, spread over the cores when its files give fewer tasks."""
    return spread(spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet"))


def _sub_type(event_type: Column) -> Column:
    mapped = F.coalesce(
        F.create_map(*[x for kv in TYPE_NAMES.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])[event_type],
        F.upper(event_type),
    )
    return mapped


def envelope(events: DataFrame, family: str = "events", keep: tuple[str, ...] = (),
             without: tuple[str, ...] = ()) -> DataFrame:
    """``events`` rows → one ``value`` column of device JSON text (plus ``event_id`` and
    any ``keep`` columns of ``events``).  Payload fields named in ``without`` are left
    out, as older devices would send them."""
    time_key = TIME_KEYS[family]
    cls = F.col("event_id") % 10
    ms = F.timestamp_diff("MILLISECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("ts"))
    ms_text = ms.cast("string")
    epoch = (
        F.when(cls == 1, F.concat(ms_text, F.lit("x")).cast("variant"))
        .when(cls == 2, F.parse_json(F.floor(ms / 1000).cast("string")))
        .when(cls == 3, (ms + F.lit(FUTURE_SHIFT_MS)).cast("string").cast("variant"))
        .when(cls == 4, (ms - F.lit(PAST_SHIFT_MS)).cast("string").cast("variant"))
        .otherwise(ms_text.cast("variant"))
    )
    sub_type = (
        F.when(cls == 7, F.concat(_sub_type(F.col("event_type")), F.lit("%")))
        .when(cls == 8, F.concat(_sub_type(F.col("event_type")), F.lit("?")))
        .when(cls != 9, _sub_type(F.col("event_type")))
    )
    extra = cls == 6
    payload = F.struct(
        F.when(cls != 0, F.concat(F.lit("m"), F.col("user_id").cast("string"))).alias("mac_address"),
        epoch.alias(time_key),
        sub_type.alias("sub_type"),
        F.when(cls != 9, F.col("event_type")).alias("event_type"),
        F.when(cls != 9, F.lit("raw")).alias("hw_type"),
        F.lit("https").alias("http_type"),
        F.col("value").cast("decimal(12,2)").cast("string").alias("viewing_duration"),
        F.parse_json(F.col("props")).alias("props"),
        F.when(extra, F.lit(1)).alias("a-b"),
        F.when(extra, F.parse_json(F.lit('{"x-y": 2, "hw_type": "inner"}'))).alias("c-d"),
        F.when(extra, F.lit("s")).alias("e f"),
        F.when(extra, F.lit(True)).alias("@g"),
    )
    if without:
        payload = payload.dropFields(*without)
    root = F.struct(
        F.col("event_id").alias("@id"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("logstash.processed-at"),
        F.date_format("ts", "yyyy-MM-dd").alias("logstash.processed-at.date"),
        payload.alias(family),
    )
    cut = F.expr("substring(_json, 1, length(_json) - 9)")
    return (
        events.select("event_id", "ts", "user_id", "event_type", "value", "props")
        .withColumn("_json", F.to_json(root))
        .select("event_id", F.when(cls == 5, cut).otherwise(F.col("_json")).alias("value"), *keep)
    )


def device_messages(spark: SparkSession, sf_dir: str, family: str = "events", keep: tuple[str, ...] = (),
                    without: tuple[str, ...] = ()) -> DataFrame:
    """The envelope of the whole ``events`` table of ``sf_dir``."""
    return envelope(read_table(spark, sf_dir, "events"), family, keep, without)
