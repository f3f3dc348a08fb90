"""Row filters (F2, F3, F5–F8) as DataFrame operators.

Each operator works on a DataFrame that carries the parsed document (``doc``, see
:func:`with_doc`), so a chain of them parses the JSON once.  All predicates are native
expressions: Catalyst can reorder and push them, no Python runs per row.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoal.functions import jsonfn as J
from shoal.functions import timefn as T

# The keys that name a device, and the token that passes the allow-list
# filter whatever the list holds.
DEVICE_KEYS = ("mac", "mac_address")
ALWAYS_ALLOWED = "APP"
EPOCH = "_epoch"  # the found epoch text, bound once


def with_doc(df: DataFrame, text: str = "value", doc: str = "doc") -> DataFrame:
    """Parse the JSON text once; malformed rows carry a null ``doc``.  The parsed
    column is bound once (see :func:`shoal.functions.jsonfn.bind_once`), so later
    filters and projections on ``doc`` never re-parse."""
    return J.bind_once(df, {doc: J.parse_doc(text)})


def device_predicate(doc: Column | str = "doc", keys: Iterable[str] = DEVICE_KEYS) -> Column:
    """a device key carries a value at any depth."""
    return J.json_has(doc, list(keys))


def filter_on_device(df: DataFrame, doc: str = "doc", keys: Iterable[str] = DEVICE_KEYS) -> DataFrame:
    return df.filter(device_predicate(doc, keys))


def with_epoch(df: DataFrame, time_field: str, doc: str = "doc", epoch: str = EPOCH) -> DataFrame:
    """The document's time value as the column ``epoch``: found once for the filter, date,
    hour and output alike."""
    return J.bind_once(df, {epoch: J.json_find(doc, time_field)})


def filter_on_time(df: DataFrame, time_field: str, doc: str = "doc", tz: str = "UTC", epoch: str = EPOCH) -> DataFrame:
    """the time key holds a digits-only epoch between 2010-01-01 and now.  Leaves the
    found text in ``epoch`` (which may already be there, see :func:`with_epoch`)."""
    if epoch not in df.columns:
        df = with_epoch(df, time_field, doc, epoch)
    return df.filter(T.valid_epoch(epoch, tz))


def drop_seen(df: DataFrame, within: str, device: str = "device", at: str = "at", message: str = "message") -> DataFrame:
    """keep the first of equal messages of a device at a time (a timestamp column); those
    that come again go.  A device may have several events in one second, and even in one
    millisecond, so ``message``, a hash of the message's text, tells them apart.  In a stream the
    state holds the three until the watermark, the latest event time less ``within``, has
    passed the time; a row older than the watermark goes too, as nothing can tell whether it
    was seen (the query's progress counts these)."""
    if df.isStreaming:
        return df.withWatermark(at, within).dropDuplicatesWithinWatermark([device, at, message])
    return df.dropDuplicates([device, at, message])


def require_keys(df: DataFrame, keys: Iterable[str], doc: str = "doc") -> DataFrame:
    """F8: keep rows whose document has every key (with a value, at any depth)."""
    cond = F.lit(True)
    for key in keys:
        cond = cond & J.json_has(doc, key)
    return df.filter(cond)


def type_hygiene_predicate(column: Column | str = "event_type") -> Column:
    """not null, no ``%``, no ``?``."""
    c = F.col(column) if isinstance(column, str) else column
    return c.isNotNull() & ~c.contains("%") & ~c.contains("?")


def type_hygiene(df: DataFrame, column: str = "event_type") -> DataFrame:
    return df.filter(type_hygiene_predicate(column))


def row_tokens_text(df: DataFrame, columns: Iterable[str] | None = None) -> Column:
    """The row's values as text, comma-joined, ``]`` removed: its tokens are the parts
    between commas."""
    cols = [F.col(f"`{c}`").cast("string") for c in (columns or df.columns)]
    return F.replace(F.concat_ws(",", *cols), F.lit("]"), F.lit(""))


def allow_list_filter(
    df: DataFrame,
    allowed: Iterable[str] | DataFrame,
    scope: str = "event_type",
    column: str = "event_type",
) -> DataFrame:
    """keep rows with an allowed name (or ``APP``).

    ``scope="event_type"`` tests one column (a null there passes, as an absent list
    of events does); ``scope="any_column"`` tests every comma-separated token of the
    whole row, the rule of the row-wide filter.

    Names in Python (a profile's fixed list) are tested in the row; names in a DataFrame,
    of any number, are joined.  The verdict depends only on the tested text, and a row may have
    many tokens, so a token is joined with 128 bits of its text's hash in the text's place,
    and the rows are kept by these: columns of every type pass, and both ways keep the same
    rows.
    """
    if scope == "any_column":
        tested, tokens = row_tokens_text(df), lambda t: F.split(t, ",")
    else:
        tested, tokens = F.col(column).cast("string"), F.array
    if not isinstance(allowed, DataFrame):
        names = [n for n in allowed if n is not None]
        if not names:
            raise ValueError("allow-list is empty")
        ok = F.arrays_overlap(tokens(tested), F.array(*[F.lit(n) for n in [*names, ALWAYS_ALLOWED]]))
        return df.filter(tested.isNull() | ok)
    names = allowed.select(F.col(f"`{allowed.columns[0]}`").cast("string").alias("_name")).where("_name IS NOT NULL")
    names = names.union(df.sparkSession.createDataFrame([(ALWAYS_ALLOWED,)], "_name string")).distinct()
    keyed = J.bind_once(df, {"_tested": tested})
    none = F.col("_tested").isNull()
    keyed = keyed.withColumns({"_h1": F.when(~none, F.xxhash64("_tested")), "_h2": F.when(~none, F.xxhash64(F.lit("text"), "_tested"))})
    said = keyed.where(~none).select("_h1", "_h2", F.explode(F.array_distinct(tokens(F.col("_tested")))).alias("_token"))
    passed = said.join(names, F.col("_token") == F.col("_name"), "left_semi").select(F.col("_h1").alias("_p1"), F.col("_h2").alias("_p2")).distinct()
    kept = keyed.drop("_tested").join(passed, (F.col("_h1") == F.col("_p1")) & (F.col("_h2") == F.col("_p2")), "left").where("_p1 IS NOT NULL OR _h1 IS NULL")
    return kept.drop("_h1", "_h2", "_p1", "_p2")
