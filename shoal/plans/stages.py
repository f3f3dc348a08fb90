"""The one pipeline every profile runs.

Stage 1 (raw text → clean JSON text, partitioned by date/hour):
    parse → F2 device → F3 time → P1 date/hour → P2 write back → P3 clean keys
          → F8 required keys → P4 stamp → text (→ F9 seen events, if asked for)

Stage 2 (clean JSON text → flat, all-string table):
    parse → payload keys → flatten (P5/P6) → P10 epoch → P7 drops → P8 copies
          → F7 hygiene → F5/F6 allow-list → P9 decimals → P11 strings → P12 lower case

Stage 1 is one projection: the parsed document and the found epoch are bound once with
a single-element ``transform`` (a ``let``), and every row leaves through ``inline`` of a
one-element array carrying the clean row or the reason it was dropped; the filter on
that generated ``status`` stays above the generator.  A plain ``filter`` on a derived
column would be pushed below the projection by Catalyst and re-parse the JSON for every
predicate; this form parses each row exactly once.  ``stage1_steps`` is the same logic
as a chain of DataFrame operators and serves as the cross-check in the tests.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoal.functions import jsonfn as J
from shoal.functions import jsonsql as Q
from shoal.functions import timefn as T
from shoal.operators import bucket as B
from shoal.operators import filters as FL
from shoal.operators import refine as R
from shoal.plans.profiles import Profile

STAMP_KEY = "hw_type"
HOUR_KEY = "hour"


# Why a raw row left stage 1 (fixed values, reported by ``observe``).
KEPT, MALFORMED, NO_DEVICE, BAD_TIME, MISSING_KEY = "kept", "malformed", "no_device", "bad_time", "missing_key"
STATUSES = (KEPT, MALFORMED, NO_DEVICE, BAD_TIME, MISSING_KEY)


def stage1_row(text: str, p: Profile, parsed: bool = False) -> Column:
    """``struct<value, date, hour, status>`` for the text column ``text``: the clean row, or
    the reason it is dropped; with ``p.seen_within`` also ``device``, the time ``at`` and a hash
    of the ``message``;
    ``parsed`` leaves ``value`` the clean document, not its text.  Built as one SQL
    expression (see ``jsonsql``)."""
    depth = p.depth
    null = Q.NULL_STR
    no_value = f"CAST(NULL AS {Q.DOC_TYPE})" if parsed else null

    def row(value: str, date: str, hour: str, status: str, device: str = null, at: str = "CAST(NULL AS TIMESTAMP)") -> str:
        event = f", 'device', {device}, 'at', {at}, 'message', xxhash64({Q.ident(text)})" if p.seen_within else ""
        return f"named_struct('value', {value}, 'date', {date}, 'hour', {hour}, 'status', {Q.lit(status)}{event})"

    def dropped(reason: str) -> str:
        return row(no_value, null, null, reason)

    def on_doc(d: str) -> str:
        def on_epoch(t: str) -> str:
            ms = T.epoch_millis_sql(t)
            date, hour = T.epoch_date_sql(ms, p.tz), T.epoch_hour_sql(ms, p.tz)
            written = Q.put(d, {p.date_key: date, HOUR_KEY: hour})
            # P3 + P4 in one rebuild: clean keys, and stamp every (cleaned) hw_type
            clean = Q.rewrite(written, depth, clean_keys=True, replace={STAMP_KEY: Q.lit(p.hw_stamp)})

            def on_clean(s: str) -> str:
                kept = row(s if parsed else f"to_json({s})", date, hour, KEPT, Q.find(d, p.device_keys, depth) if p.seen_within else null, f"timestamp_millis({ms})")
                if not p.require_keys:
                    return kept
                required = " AND ".join(Q.has(s, [k], depth) for k in p.require_keys)
                return f"CASE WHEN {required} THEN {kept} ELSE {dropped(MISSING_KEY)} END"

            return f"CASE WHEN {T.valid_epoch_sql(t, p.tz)} THEN {Q.let(clean, on_clean)} ELSE {dropped(BAD_TIME)} END"

        device = Q.has(d, p.device_keys, depth)
        return (f"CASE WHEN {d} IS NULL THEN {dropped(MALFORMED)} "
                f"WHEN NOT {device} THEN {dropped(NO_DEVICE)} "
                f"ELSE {Q.let(Q.find(d, [p.time_field], depth), on_epoch)} END")

    return F.expr(Q.let(Q.parse_doc(Q.ident(text)), on_doc))


def stage1_counts() -> list[Column]:
    """Row counts per outcome, for ``DataFrame.observe`` (batch or stream)."""
    return [F.count(F.lit(1)).alias("rows_in")] + [
        F.count_if(F.col("status") == s).alias(s) for s in STATUSES
    ]


def stage1(df: DataFrame, p: Profile, text: str = "value", observe=None, parsed: bool = False) -> DataFrame:
    """Raw JSON text → ``value`` (clean JSON), ``date``, ``hour`` of the kept rows.  ``parsed``:
    ``value`` is the clean document itself, for a stage 2 that follows without files between.

    ``observe`` (a name, or a :class:`pyspark.sql.Observation`) reports how many rows
    came in and why each dropped row left (malformed, no device, bad time, missing
    key) — in a stream as the query progress's observed metrics.  The filter on the
    generated ``status`` stays above the generator, so nothing is evaluated twice.

    With ``p.seen_within`` what was seen before goes (F9), and ``observe`` + ``_new`` reports how
    many rows are left then."""
    rows = df.select(F.inline(F.array(stage1_row(text, p, parsed))))
    if observe is not None:
        rows = rows.observe(observe, *stage1_counts())
    kept = rows.filter(F.col("status") == KEPT).drop("status")
    if p.seen_within is None:
        return kept
    new = FL.drop_seen(kept, p.seen_within).drop("device", "at", "message")
    return new if observe is None else new.observe(f"{observe}_new", F.count(F.lit(1)).alias("new"))


def stage1_steps(df: DataFrame, p: Profile, text: str = "value") -> DataFrame:
    """The same as :func:`stage1`, written as a chain of DataFrame operators."""
    out = FL.with_doc(df.select(text), text)
    out = FL.filter_on_device(out, keys=p.device_keys)
    out = FL.filter_on_time(out, p.time_field, tz=p.tz)
    out = B.add_date_and_hour(out, p.time_field, tz=p.tz)
    out = B.put_date_and_hour(out, p.date_key)
    out = B.sanitize_keys(out)
    if p.require_keys:
        out = FL.require_keys(out, p.require_keys)
    out = B.stamp(out, p.hw_stamp, STAMP_KEY)
    return B.to_text(out).select("value", "date", "hour")


def stage2(df: DataFrame, p: Profile, keys: Sequence[str] | None = None, text: str = "value") -> DataFrame:
    """Clean JSON text → the profile's flat table (all strings, lower-case names).

    ``keys`` are the payload keys to flatten; when neither they nor ``p.columns`` are given
    they are discovered from ``df`` (one small distinct-aggregate job)."""
    prepared = R.prepare(df, p, text)
    return R.refine(R.flatten(prepared, p, keys), p)


def payload_keys(df: DataFrame, p: Profile, text: str = "value") -> list[str]:
    """The payload keys of the rows that stage 1 keeps, cleaned, from a narrow pass: filters
    and key clean-up of the payload's own level, without rewriting or serialising."""
    null = Q.NULL_STR

    def on_doc(d: str) -> str:
        payload = Q.as_object(f"{d}[{Q.lit(p.payload)}]")
        e = Q.fresh("e")
        names = (f"transform(map_entries({payload}), {e} -> CASE WHEN {Q.as_object(f'{e}.value')} IS NOT NULL "
                 f"THEN {Q.clean_key(f'{e}.key', False)} ELSE {Q.clean_key(f'{e}.key', True)} END)")
        kept = [Q.has(d, p.device_keys, p.depth), Q.let(Q.find(d, [p.time_field], p.depth), lambda t: T.valid_epoch_sql(t, p.tz))]
        kept += [Q.has(Q.rewrite(d, p.depth), [k], p.depth) for k in p.require_keys]
        return f"CASE WHEN {' AND '.join(kept)} THEN {names} END"

    keys = df.select(F.explode(F.expr(Q.let(Q.parse_doc(Q.ident(text)), on_doc))).alias("k")).distinct()
    return sorted(r["k"] for r in keys.collect())


def run_batch(df: DataFrame, p: Profile, text: str = "value", keys: Sequence[str] | None = None) -> DataFrame:
    """Both stages over a batch DataFrame of raw JSON text, without files or text in between:
    stage 2 reads the documents that stage 1 has cleaned."""
    if keys is None and p.columns is None:
        keys = payload_keys(df, p, text)
    prepared = R.prepare(stage1(df, p, text, parsed=True), p, parsed=True)
    return R.refine(R.flatten(prepared, p, keys), p)
