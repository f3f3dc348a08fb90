"""Epoch-time functions (text epochs of seconds or milliseconds).

All arithmetic is on BIGINT and ``TIMESTAMP_NTZ``, so results do not depend on the
session time zone; the zone is an explicit argument (UTC by default).  The ``*_sql``
builders take and return SQL text (see :mod:`shoal.functions.jsonsql`); the functions
without the suffix take a column's name.
"""

from __future__ import annotations

from datetime import datetime, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

from shoal.functions.jsonsql import ident, lit

# Fixed values of the contract.
# Epoch texts shorter than 13 characters are seconds, longer ones milliseconds.
SECONDS_MAX_LENGTH = 12
# Earliest plausible event time: 2010-01-01 00:00:00 in the stream's zone.
EARLIEST = (2010, 1, 1)
DATE_FORMAT = "yyyy-MM-dd"
HOUR_FORMAT = "HH"

MS_PER_DAY = 86_400_000
MS_PER_HOUR = 3_600_000


def _is_utc(tz: str) -> bool:
    return tz.upper() in ("UTC", "Z", "+00:00", "GMT")


def earliest_epoch_seconds(tz: str = "UTC") -> int:
    return int(datetime(*EARLIEST, tzinfo=timezone.utc if _is_utc(tz) else ZoneInfo(tz)).timestamp())


def epoch_is_digits_sql(text: str) -> str:
    return f"coalesce({text} RLIKE '^[0-9]+$', false)"


def epoch_millis_sql(text: str) -> str:
    n = f"try_cast({text} AS BIGINT)"
    return f"CASE WHEN length({text}) <= {SECONDS_MAX_LENGTH} THEN {n} * 1000 ELSE {n} END"


def plausible_epoch_sql(millis: str, tz: str = "UTC") -> str:
    seconds = f"CAST(floor(({millis}) / 1000) AS BIGINT)"
    return f"coalesce({seconds} BETWEEN {earliest_epoch_seconds(tz)} AND unix_seconds(current_timestamp()), false)"


def valid_epoch_sql(text: str, tz: str = "UTC") -> str:
    return f"({epoch_is_digits_sql(text)} AND {plausible_epoch_sql(epoch_millis_sql(text), tz)})"


def _local_sql(millis: str, tz: str) -> str:
    ntz = f"timestampadd(MILLISECOND, {millis}, TIMESTAMP_NTZ'1970-01-01 00:00:00')"
    return ntz if _is_utc(tz) else f"convert_timezone('UTC', {lit(tz)}, {ntz})"


def epoch_date_sql(millis: str, tz: str = "UTC") -> str:
    if _is_utc(tz):  # integer arithmetic
        return f"CAST(date_from_unix_date(CAST(floor(({millis}) / {MS_PER_DAY}) AS INT)) AS STRING)"
    return f"date_format({_local_sql(millis, tz)}, '{DATE_FORMAT}')"


def epoch_hour_sql(millis: str, tz: str = "UTC") -> str:
    if _is_utc(tz):
        return f"lpad(CAST(floor(pmod({millis}, {MS_PER_DAY}) / {MS_PER_HOUR}) AS STRING), 2, '0')"
    return f"date_format({_local_sql(millis, tz)}, '{HOUR_FORMAT}')"


def epoch_is_digits(text: str) -> Column:
    """The text is made of digits only (the empty text is rejected)."""
    return F.expr(epoch_is_digits_sql(ident(text)))


def epoch_millis(text: str) -> Column:
    """Epoch text → milliseconds (BIGINT); seconds are scaled; non-numbers or values
    wider than a BIGINT → null."""
    return F.expr(epoch_millis_sql(ident(text)))


def normalize_epoch(text: str) -> Column:
    """P10: epoch text in milliseconds, as text."""
    return epoch_millis(text).cast("string")


def plausible_epoch(millis: str, tz: str = "UTC") -> Column:
    """whole seconds between 2010-01-01 00:00:00 (in ``tz``) and now, both ends included."""
    return F.expr(plausible_epoch_sql(ident(millis), tz))


def valid_epoch(text: str, tz: str = "UTC") -> Column:
    """F3 on an already found epoch text: digits, and a plausible time."""
    return F.expr(valid_epoch_sql(ident(text), tz))


def epoch_date(millis: str, tz: str = "UTC") -> Column:
    """``yyyy-MM-dd`` of an epoch in milliseconds."""
    return F.expr(epoch_date_sql(ident(millis), tz))


def epoch_hour(millis: str, tz: str = "UTC") -> Column:
    """D3: two-digit hour of an epoch in milliseconds."""
    return F.expr(epoch_hour_sql(ident(millis), tz))


def epoch_datetime(millis: str, tz: str = "UTC") -> Column:
    """``yyyy-MM-dd HH:mm:ss`` of an epoch in milliseconds."""
    return F.expr(f"date_format({_local_sql(ident(millis), tz)}, '{DATE_FORMAT} HH:mm:ss')")
