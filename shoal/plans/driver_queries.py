"""Driver queries: each operator family run over the whole ``events`` table (and the
whole texts of ``conversations`` / ``documents``), next to an SQL statement that
computes the same answer directly from the raw columns.

The JSON input is built by Spark from ``events`` (:mod:`shoal.sources.envelope`); the
SQL side knows the construction rule and derives the expected values without any JSON
processing, so a match checks the operators and not a re-implementation of them.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoal.functions import jsonfn as J
from shoal.functions import timefn as T
from shoal.operators import bucket as B
from shoal.operators import filters as FL
from shoal.operators import refine as R
from shoal.plans import stages as S
from shoal.plans.profiles import PROFILES, Profile
from shoal.session import configure, scratch_root
from shoal.sources.envelope import TYPE_NAMES, device_messages, read_table
from shoal.sources.stream import read_allow_list

Query = Callable[[SparkSession, str], DataFrame]


def _messages(spark: SparkSession, sf_dir: str, family: str = "events") -> DataFrame:
    configure(spark)
    return FL.with_doc(device_messages(spark, sf_dir, family))


def _kept_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = FL.filter_on_device(_messages(spark, sf_dir))
    return FL.filter_on_time(df, "event_time")


# --------------------------------------------------------------------------- Spark side


def q_device_filter(spark, sf_dir):
    df = FL.filter_on_device(_messages(spark, sf_dir))
    return df.select("event_id", J.json_find("doc", list(FL.DEVICE_KEYS)).alias("mac"))


def q_time_filter(spark, sf_dir):
    return _kept_time(spark, sf_dir).select("event_id", F.col(FL.EPOCH).alias("epoch"))


def q_epoch_buckets(spark, sf_dir):
    df = B.add_date_and_hour(_kept_time(spark, sf_dir), "event_time")
    return df.select("event_id", "date", "hour")


def q_epoch_normalised(spark, sf_dir):
    df = _kept_time(spark, sf_dir)
    return df.select("event_id", T.normalize_epoch(FL.EPOCH).alias("epoch_ms"))


def q_json_find(spark, sf_dir):
    doc = "doc"
    return _messages(spark, sf_dir).select(
        "event_id",
        J.json_find(doc, "mac_address").alias("mac_address"),
        J.json_find(doc, "sub_type").alias("sub_type"),
        J.json_find(doc, "k").alias("k"),
        J.json_find(doc, "hw_type").alias("hw_type"),
        J.json_find(doc, "viewing_duration").alias("viewing_duration"),
    )


def q_json_put(spark, sf_dir):
    df = B.add_date_and_hour(_kept_time(spark, sf_dir), "event_time")
    df = B.to_text(B.put_date_and_hour(df, "event_date"))
    return df.select(
        "event_id",
        F.get_json_object("value", "$.event_date").alias("event_date"),
        F.get_json_object("value", "$.hour").alias("hour"),
    )


def q_json_replace(spark, sf_dir):
    df = B.to_text(B.stamp(_messages(spark, sf_dir), "v7"))
    nested = F.from_json("value", "struct<events: struct<hw_type: string, `c-d`: struct<hw_type: string>>>")
    return df.select(
        "event_id",
        nested["events"]["hw_type"].alias("hw_type"),
        nested["events"]["c-d"]["hw_type"].alias("inner_hw_type"),
    )


def q_json_sanitised(spark, sf_dir):
    df = B.sanitize_keys(_messages(spark, sf_dir))
    payload = F.col("doc")["events"].try_cast(J.DOC_TYPE)
    return df.select(
        "event_id",
        J.doc_keys("doc").alias("root_keys"),
        J.doc_keys(payload).alias("payload_keys"),
        J.doc_keys(payload["c-d"].try_cast(J.DOC_TYPE)).alias("nested_keys"),
    )


def q_json_copy(spark, sf_dir):
    df = B.copy_key(_messages(spark, sf_dir), "mac_address", "mac")
    df = B.to_text(B.copy_key(df, "sub_type", "kind"))
    return df.select(
        "event_id",
        F.get_json_object("value", "$.mac").alias("mac"),
        F.get_json_object("value", "$.kind").alias("kind"),
    )


def _typed(spark, sf_dir) -> DataFrame:
    df = FL.filter_on_device(_messages(spark, sf_dir))
    return df.withColumn("event_type", J.json_find("doc", "sub_type"))


def q_allow_list(spark, sf_dir):
    df = FL.allow_list_filter(_typed(spark, sf_dir), PROFILES["e5"].allow_list, scope="event_type")
    return df.select("event_id", "event_type")


def q_type_hygiene(spark, sf_dir):
    return FL.type_hygiene(_typed(spark, sf_dir)).select("event_id", "event_type")


def q_require_key(spark, sf_dir):
    df = FL.require_keys(FL.filter_on_device(_messages(spark, sf_dir)), ["event_type"])
    return df.select("event_id")


def q_decimal_refine(spark, sf_dir):
    df = FL.filter_on_device(_messages(spark, sf_dir))
    found = J.json_find("doc", "viewing_duration")
    return df.select("event_id", found.try_cast("decimal(18,0)").cast("string").alias("viewing_duration"))


def _flatten_only(spark, sf_dir, key):
    p = PROFILES[key]
    configure(spark)
    s1 = S.stage1(device_messages(spark, sf_dir, p.family), p)
    prepared = R.prepare(s1, p)
    return R.flatten(prepared, p, R.discover_keys(prepared))


def q_flatten_metrics(spark, sf_dir):
    return _flatten_only(spark, sf_dir, "m7")


def q_flatten_events(spark, sf_dir):
    return _flatten_only(spark, sf_dir, "e7")


def _profile_query(key: str) -> Query:
    def run(spark, sf_dir):
        configure(spark)
        p = PROFILES[key]
        return S.run_batch(device_messages(spark, sf_dir, p.family), p)

    run.__name__ = f"q_profile_{key}"
    return run


def _text_roundtrip(table: str, id_cols: tuple[str, ...], text_col: str) -> Query:
    """Whole texts through J5 (keys with ``.``/space/``@``) and J1, read back exactly."""

    def run(spark, sf_dir):
        configure(spark)
        src = read_table(spark, sf_dir, table)
        body = F.struct(
            *[F.col(c).alias(f"@{c}") for c in id_cols],
            F.struct(F.col(text_col).alias("body text"), F.lit("x").alias("mac")).alias("pay.load"),
        )
        parsed = FL.with_doc(src.select(*id_cols, F.to_json(body).alias("_json")), "_json", "_doc")
        clean = J.bind_once(parsed, {"doc": J.json_sanitize_keys("_doc")})
        return clean.select(
            *id_cols,
            J.json_find("doc", "body_text").alias(text_col),
            J.json_has("doc", "mac").alias("has_device"),
        )

    return run


def q_epoch_datetime(spark, sf_dir):
    """D1 on every message whose time stage 1 accepts."""
    df = _kept_time(spark, sf_dir).withColumn("ms", T.epoch_millis(FL.EPOCH))
    return df.select("event_id", T.epoch_datetime("ms").alias("at"))


WIDE_KEYS = 400


def _nested(spark, sf_dir) -> DataFrame:
    """Messages whose fields lie 1 to 40 objects deep, every fiftieth beside an object of
    WIDE_KEYS keys."""
    events = read_table(spark, sf_dir, "events")
    level = (F.col("event_id") % 40 + 1).cast("int")
    ms = F.timestamp_diff("MILLISECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("ts")).cast("string")
    inner = F.to_json(F.struct(
        F.concat(F.lit("m"), F.col("user_id").cast("string")).alias("mac"), ms.alias("event_time"), F.lit("raw").alias("hw_type"),
        F.col("event_type").alias("odd key-1"), F.array(F.struct(F.lit("x").alias("mac"))).alias("@list")))
    many = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(WIDE_KEYS - 1)), lambda i: F.concat(
        F.lit('"w-'), i.cast("string"), F.lit('":'), (F.col("event_id") + i).cast("string"))), ",")
    wide = F.when(F.col("event_id") % 50 == 0, F.concat(F.lit('"w.x":{'), many, F.lit("},"))).otherwise("")
    inner = F.concat(F.lit("{"), wide, F.substr(inner, F.lit(2)))
    text = F.concat(F.repeat(F.lit('{"a.b":1,"n-o":'), level), inner, F.repeat(F.lit("}"), level))
    return FL.with_doc(events.select("event_id", text.alias("value")))


def q_deep_documents(spark, sf_dir):
    configure(spark)
    df = FL.filter_on_time(FL.filter_on_device(_nested(spark, sf_dir)), "event_time")
    df = B.copy_key(B.stamp(B.sanitize_keys(df), "v7"), "odd_key_1", "kind")
    df = J.bind_once(df, {"wide": J.json_find("doc", f"w_{WIDE_KEYS - 1}")})

    text = B.to_text(df)
    depth = F.length("value") - F.length(F.replace("value", F.lit('"n-o":{'), F.lit('"n-o":')))
    return text.select("event_id", F.get_json_object("value", "$.kind").alias("kind"), F.col(FL.EPOCH).alias("epoch"),
                       depth.cast("long").alias("levels"), "wide", F.regexp_extract("value", '"mac":"(m[0-9]+)"', 1).alias("mac"),
                       F.regexp_extract("value", '"hw_type":"([a-z0-9]+)"', 1).alias("hw_type"))


def q_case_twins(spark, sf_dir):
    """Payload keys that differ in case only become one column, in key order."""
    configure(spark)
    events = read_table(spark, sf_dir, "events")
    id_text = F.col("event_id").cast("string")
    odd = F.col("event_id") % 3
    payload = F.struct(F.when(odd != 1, F.concat(F.lit("upper"), id_text)).alias("Kind"),
                       F.when(odd != 2, F.concat(F.lit("lower"), id_text)).alias("kind"), id_text.alias("Event_ID"))
    body = F.to_json(F.struct(payload.alias("metrics"), F.date_format("ts", "yyyy-MM-dd").alias("thedate")))
    prepared = R.prepare(events.select(body.alias("value")), PROFILES["m7"])
    return R.all_strings_lower(R.flatten(prepared, PROFILES["m7"]))


def q_drop_duplicate_columns(spark, sf_dir):
    """The joined side's copy of a column goes, its other columns stay."""
    events = read_table(spark, sf_dir, "events")
    left = events.select("event_id", "user_id")
    right = events.select("event_id", "event_type")
    return R.drop_duplicate_columns(left.join(right, left["event_id"] == right["event_id"]), right)


def q_column_paths(spark, sf_dir):
    """Columns read only where their path is in the schema, nested ones too."""
    events = read_table(spark, sf_dir, "events")
    user = F.struct(F.col("user_id").alias("Id"), F.struct(F.col("event_type").alias("Kind")).alias("last"))
    df = events.select("event_id", user.alias("user"))
    paths = ("user.id", "USER.Last.kind", "user.last.kind.more", "user.mail", "event_ID", "nothing")
    there = [F.col(p).cast("string") if R.has_column(df, p) else F.lit(None).cast("string") for p in paths]
    return df.select("event_id", *[c.alias(f"p{k}") for k, c in enumerate(there)])


def q_wide_payload(spark, sf_dir):
    """Thousands of payload keys under a profile that names its columns."""
    configure(spark)
    p = PROFILES["m7"].with_options(columns=("event_type", "K7"), rest_column="others")
    events = read_table(spark, sf_dir, "events")
    key = F.concat(F.lit("k"), (F.col("event_id") % 7000).cast("string"))
    payload = F.concat(F.lit('{"'), key, F.lit('":"'), F.col("event_id").cast("string"), F.lit('","event_type":"'), F.col("event_type"), F.lit('"}'))
    body = F.concat(F.lit('{"metrics":'), payload, F.lit(',"thedate":"'), F.date_format("ts", "yyyy-MM-dd"), F.lit('"}'))
    return R.flatten(R.prepare(events.select(body.alias("value")), p), p)


def q_allow_list_table(spark, sf_dir):
    """F5/F6 with the list as a table (every allowed name and the even users), row-wide, on
    rows that hold a VARIANT column."""
    df = _typed(spark, sf_dir).select("event_id", "event_type", F.concat(F.lit("u"), F.col("event_id").cast("string")).alias("u"),
                                      F.col("doc")["events"].alias("payload"))
    users = read_table(spark, sf_dir, "events").where("event_id % 2 = 0").select(F.concat(F.lit("u"), F.col("event_id").cast("string")).alias("name"))
    names = spark.createDataFrame([("VOD-VIEW",)], "name string").union(users)
    return FL.allow_list_filter(df, names, scope="any_column").select("event_id", "event_type")


def q_allow_list_csv(spark, sf_dir):
    """The V5 events profile with its list read from a CSV file's first line."""
    configure(spark)
    path = f"{scratch_root(spark)}/shoal-list-{uuid.uuid4().hex[:12]}"
    spark.createDataFrame([("VOD-VIEW,SYSTEM-ERROR, HOTKEY",)], "value string").coalesce(1).write.text(path)
    names = tuple(r["name"] for r in read_allow_list(spark, path).collect())
    p = PROFILES["e5"].with_options(allow_list=names)
    return S.run_batch(device_messages(spark, sf_dir, p.family), p)


QUERIES: dict[str, Query] = {
    "epoch_datetime": q_epoch_datetime,
    "deep_documents": q_deep_documents,
    "case_twins": q_case_twins,
    "drop_duplicate_columns": q_drop_duplicate_columns,
    "wide_payload": q_wide_payload,
    "column_paths": q_column_paths,
    "allow_list_table": q_allow_list_table,
    "allow_list_csv": q_allow_list_csv,
    "device_filter": q_device_filter,
    "time_filter": q_time_filter,
    "epoch_buckets": q_epoch_buckets,
    "epoch_normalised": q_epoch_normalised,
    "json_find": q_json_find,
    "json_put": q_json_put,
    "json_replace": q_json_replace,
    "json_sanitised": q_json_sanitised,
    "json_copy": q_json_copy,
    "allow_list": q_allow_list,
    "type_hygiene": q_type_hygiene,
    "require_key": q_require_key,
    "decimal_refine": q_decimal_refine,
    "flatten_metrics": q_flatten_metrics,
    "flatten_events": q_flatten_events,
    **{f"profile_{k}": _profile_query(k) for k in PROFILES},
    "text_roundtrip_conversations": _text_roundtrip("conversations", ("conv_id", "turn", "role"), "text"),
    "text_roundtrip_documents": _text_roundtrip("documents", ("doc_id", "lang", "source"), "text"),
    "text_roundtrip_pages": _text_roundtrip("pages", ("page_id", "url"), "html"),
}


# --------------------------------------------------------------------------- SQL side
# The expected answers, written against the raw ``events`` columns (DuckDB dialect).

_MAPPED = (
    "CASE event_type "
    + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in TYPE_NAMES.items())
    + " ELSE upper(event_type) END"
)
_BASE = f"""WITH b AS (
  SELECT event_id, user_id, event_type, props, value, ts,
         event_id % 10 AS cls,
         epoch_us(ts) // 1000 AS ms,
         {_MAPPED} AS mapped
  FROM events)"""
_SUB_TYPE = "CASE cls WHEN 7 THEN mapped || '%' WHEN 8 THEN mapped || '?' WHEN 9 THEN NULL ELSE mapped END"
_EPOCH_TEXT = "CASE WHEN cls = 2 THEN CAST(ms // 1000 AS VARCHAR) ELSE CAST(ms AS VARCHAR) END"
_EPOCH_MS = "CASE WHEN cls = 2 THEN CAST((ms // 1000) * 1000 AS VARCHAR) ELSE CAST(ms AS VARCHAR) END"
_DATE = "strftime(ts, '%Y-%m-%d')"
_HOUR = "strftime(ts, '%H')"
_DURATION = "CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR)"
_PROPS = "CAST(json(props) AS VARCHAR)"
_KEPT = "cls IN (2, 6, 7, 8, 9)"  # rows stage 1 keeps (device, digits, plausible time)


# What each stream is expected to do, written out here for the SQL alone: the time key, the
# hardware stamp, the payload columns that go, the copies (target, source), the rows kept
# by the event type, and the columns read as whole numbers.
_ALLOWED = "('VOD-VIEW', 'HOTKEY', 'SYSTEM-ERROR')"  # of the names the fixture sends
_CLEAN_TYPE = "cls NOT IN (7, 8, 9)"
_EXPECTED: dict[str, dict] = {
    "m5": {"time": "epoch_time", "stamp": "v5", "gone": ["hw_type"], "copies": [("mac", "mac_address")]},
    "m5c": {"time": "epoch_time", "stamp": "v5c", "gone": ["http_type", "hw_type"], "copies": [("mac", "mac_address")]},
    "m6": {"time": "epoch_time", "stamp": "V6", "gone": [], "copies": [("mac", "mac_address")]},
    "m7": {"time": "epoch_time", "stamp": "v7", "gone": [], "copies": [("mac", "mac_address")]},
    "e5": {"time": "event_time", "stamp": "v5", "gone": [], "where": f"event_type_out IN {_ALLOWED}",
           "copies": [("mac", "mac_address"), ("event_type", "sub_type"), ("event_epoch_time", "event_time")]},
    "e5c": {"time": "event_time", "stamp": "v5c", "gone": [], "where": f"event_type_out IN {_ALLOWED}",
            "copies": [("mac", "mac_address"), ("event_type", "sub_type"), ("event_epoch_time", "event_time")]},
    "e6": {"time": "event_time", "stamp": "v6", "gone": ["http_type"], "where": _CLEAN_TYPE,
           "copies": [("mac", "mac_address"), ("event_type", "sub_type"), ("logstash_date", "event_date"), ("event_epoch_time", "event_time")]},
    "e7": {"time": "event_time", "stamp": "v7", "gone": ["http_type"], "where": "cls <> 9",
           "copies": [("mac", "mac_address")], "whole": ["event_time", "viewing_duration"]},
}


def profile_sql_with(key: str, wrap: dict[str, str]) -> str:
    """The profile's SQL with some payload columns wrapped (``{}`` is the column)."""
    return _profile_sql(_EXPECTED[key], wrap)


def profile_sql_where(key: str, where: str) -> str:
    """The profile's SQL with another condition on the rows (``event_type_out`` is the type)."""
    return _profile_sql({**_EXPECTED[key], "where": where})


def _profile_sql(x: dict, wrap: dict[str, str] | None = None) -> str:
    s, events = x["stamp"], x["time"] == "event_time"
    cols: dict[str, str] = {
        "a_b": "CASE WHEN cls = 6 THEN '1' END",
        "c-d": f"""CASE WHEN cls = 6 THEN '{{"hw_type":"{s}","x_y":2}}' END""",
        "e_f": "CASE WHEN cls = 6 THEN 's' END",
        "g": "CASE WHEN cls = 6 THEN 'true' END",
        x["time"]: _EPOCH_MS,
        "event_type": "CASE WHEN cls <> 9 THEN event_type END",
        "http_type": "'https'",
        "hw_type": f"CASE WHEN cls <> 9 THEN '{s}' END",
        "mac_address": "'m' || user_id",
        "props": _PROPS,
        "sub_type": _SUB_TYPE,
        "viewing_duration": _DURATION,
    }
    for name, template in (wrap or {}).items():
        cols[name] = template.format(cols[name])
    if events:
        cols |= {"event_date": _DATE, "logstash_processed_at": "strftime(ts, '%Y-%m-%d %H:%M:%S')", "logstash_processed_at_date": _DATE}
    else:
        cols["thedate"] = _DATE
    for name in x["gone"]:
        del cols[name]
    for target, source in x["copies"]:
        cols[target] = cols[source]
    where = x.get("where", "true").replace("event_type_out", f"({cols['event_type']})")
    for name in x.get("whole", []):
        cols[name] = f"CAST(TRY_CAST({cols[name]} AS DECIMAL(18,0)) AS VARCHAR)"
    select = ",\n  ".join(f'{expr} AS "{name}"' for name, expr in sorted(cols.items()))
    return f"{_BASE}\nSELECT\n  {select}\nFROM b WHERE {_KEPT} AND {where}"


def _flatten_sql(key: str) -> str:
    """Columns of the flattened payload before refinement (no copies, drops, casts)."""
    x = _EXPECTED[key]
    sql = _profile_sql({"time": x["time"], "stamp": x["stamp"], "gone": [], "copies": [], "where": x.get("where", "true")})
    # before refinement the epoch column still holds the text as found
    return sql.replace(f'{_EPOCH_MS} AS "{x["time"]}"', f'{_EPOCH_TEXT} AS "{x["time"]}"')


_ORACLES: dict[str, str] = {
    "epoch_datetime": f"{_BASE} SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at FROM b WHERE {_KEPT}",
    "deep_documents": """SELECT event_id, event_type AS kind, CAST(epoch_us(ts) // 1000 AS VARCHAR) AS epoch, event_id % 40 + 1 AS levels,
        CASE WHEN event_id % 50 = 0 THEN CAST(event_id + 399 AS VARCHAR) END AS wide,
        'm' || user_id AS mac, 'v7' AS hw_type FROM events""",
    "case_twins": """SELECT CAST(event_id AS VARCHAR) AS event_id, strftime(ts, '%Y-%m-%d') AS thedate,
        CASE WHEN event_id % 3 <> 1 THEN 'upper' || event_id ELSE 'lower' || event_id END AS kind FROM events""",
    "drop_duplicate_columns": "SELECT event_id, user_id, event_type FROM events",
    "column_paths": """SELECT event_id, CAST(user_id AS VARCHAR) AS p0, event_type AS p1, CAST(NULL AS VARCHAR) AS p2,
        CAST(NULL AS VARCHAR) AS p3, CAST(event_id AS VARCHAR) AS p4, CAST(NULL AS VARCHAR) AS p5 FROM events""",
    "wide_payload": """SELECT event_type, CASE WHEN event_id % 7000 = 7 THEN CAST(event_id AS VARCHAR) END AS k7,
        CASE WHEN event_id % 7000 <> 7 THEN '{"k' || (event_id % 7000) || '":"' || event_id || '"}' END AS others,
        strftime(ts, '%Y-%m-%d') AS thedate FROM events""",
    "allow_list_table": f"""{_BASE} SELECT event_id, {_SUB_TYPE} AS event_type FROM b
      WHERE cls NOT IN (0, 5) AND (event_id % 2 = 0 OR ({_SUB_TYPE}) = 'VOD-VIEW')""",
    "allow_list_csv": _profile_sql(_EXPECTED["e5"]),
    "device_filter": f"{_BASE} SELECT event_id, 'm' || user_id AS mac FROM b WHERE cls NOT IN (0, 5)",
    "time_filter": f"{_BASE} SELECT event_id, {_EPOCH_TEXT} AS epoch FROM b WHERE {_KEPT}",
    "epoch_buckets": f"{_BASE} SELECT event_id, {_DATE} AS date, {_HOUR} AS hour FROM b WHERE {_KEPT}",
    "epoch_normalised": f"{_BASE} SELECT event_id, {_EPOCH_MS} AS epoch_ms FROM b WHERE {_KEPT}",
    "json_find": f"""{_BASE} SELECT event_id,
        CASE WHEN cls NOT IN (0, 5) THEN 'm' || user_id END AS mac_address,
        CASE WHEN cls <> 5 THEN {_SUB_TYPE} END AS sub_type,
        CASE WHEN cls <> 5 THEN CAST(json_extract(props, '$.k') AS VARCHAR) END AS k,
        CASE WHEN cls IN (5, 9) THEN NULL WHEN cls = 6 THEN 'inner' ELSE 'raw' END AS hw_type,
        CASE WHEN cls <> 5 THEN {_DURATION} END AS viewing_duration
      FROM b""",
    "json_put": f"{_BASE} SELECT event_id, {_DATE} AS event_date, {_HOUR} AS hour FROM b WHERE {_KEPT}",
    "json_replace": f"""{_BASE} SELECT event_id,
        CASE WHEN cls NOT IN (5, 9) THEN 'v7' END AS hw_type,
        CASE WHEN cls = 6 THEN 'v7' END AS inner_hw_type
      FROM b""",
    "json_sanitised": f"""{_BASE} SELECT event_id,
        CASE WHEN cls <> 5 THEN 'events,id,logstash_processed_at,logstash_processed_at_date' END AS root_keys,
        CASE cls
          WHEN 5 THEN NULL
          WHEN 0 THEN 'event_time,event_type,http_type,hw_type,props,sub_type,viewing_duration'
          WHEN 6 THEN 'a_b,c-d,e_f,event_time,event_type,g,http_type,hw_type,mac_address,props,sub_type,viewing_duration'
          WHEN 9 THEN 'event_time,http_type,mac_address,props,viewing_duration'
          ELSE 'event_time,event_type,http_type,hw_type,mac_address,props,sub_type,viewing_duration'
        END AS payload_keys,
        CASE WHEN cls = 6 THEN 'hw_type,x_y' END AS nested_keys
      FROM b""",
    "json_copy": f"""{_BASE} SELECT event_id,
        CASE WHEN cls NOT IN (0, 5) THEN 'm' || user_id END AS mac,
        CASE WHEN cls NOT IN (5, 9) THEN {_SUB_TYPE} END AS kind
      FROM b""",
    "allow_list": f"""{_BASE} SELECT event_id, {_SUB_TYPE} AS event_type FROM b
      WHERE cls NOT IN (0, 5) AND (cls = 9 OR ({_SUB_TYPE}) IN {_ALLOWED})""",
    "type_hygiene": f"{_BASE} SELECT event_id, {_SUB_TYPE} AS event_type FROM b WHERE cls NOT IN (0, 5, 7, 8, 9)",
    "require_key": f"{_BASE} SELECT event_id FROM b WHERE cls NOT IN (0, 5, 9)",
    "decimal_refine": f"""{_BASE} SELECT event_id,
        CAST(TRY_CAST({_DURATION} AS DECIMAL(18,0)) AS VARCHAR) AS viewing_duration
      FROM b WHERE cls NOT IN (0, 5)""",
    "flatten_metrics": _flatten_sql("m7"),
    "flatten_events": _flatten_sql("e7"),
    **{f"profile_{k}": _profile_sql(x) for k, x in _EXPECTED.items()},
    "text_roundtrip_conversations": "SELECT conv_id, turn, role, text, true AS has_device FROM conversations",
    "text_roundtrip_documents": "SELECT doc_id, lang, source, text, true AS has_device FROM documents",
    "text_roundtrip_pages": "SELECT page_id, url, html, true AS has_device FROM pages",
}


def oracles() -> dict[str, str]:
    return dict(_ORACLES)
