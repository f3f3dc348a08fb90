"""S4 with inferred types: what types a payload's columns have, over a batch and over all batches.

A column's evidence is three numbers: which kinds of values it has met (a bit each), the most
digits before the point and the most behind it.  Evidence merges by ``or`` and ``max``, in any
order and grouping, so the types are the same whether the rows came in one batch or in many:

    null only -> string;  boolean;  bigint -> decimal(38, s) -> double -> string

Text, objects and arrays are strings (the latter as JSON text), and so is a column that has
met booleans and numbers.  A decimal that needs more than 38 digits is a double.

The table's files stay text, as the profiles write them: a column that widens never has its
files written again, and no value is changed by a type it had for a while.  Types are applied
where the table is read (:func:`with_types`).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoal.operators import refine as R
from shoal.plans.profiles import Profile

WHOLE, DECIMAL, DOUBLE, BOOLEAN, TEXT = 1, 2, 4, 8, 16
MAX_DIGITS, LONG_DIGITS = 38, 19


def column_type(kinds: int, digits: int, scale: int) -> str:
    if kinds == BOOLEAN:
        return "boolean"
    if kinds == 0 or kinds & (TEXT | BOOLEAN):
        return "string"
    if kinds == WHOLE:
        return "bigint"
    if kinds & DOUBLE or digits + scale > MAX_DIGITS:
        return "double"
    return f"decimal({MAX_DIGITS},{scale})"


def evidence(prepared: DataFrame) -> DataFrame:
    """(name, kinds, digits, scale, keys) of every payload column, by lower-case name; ``keys``
    are its spellings.  Two aggregations, pre-aggregated in the tasks: the distinct types of each
    key, then, of these few rows, what they mean."""
    types_of = F.transform(F.map_entries(R.payload_map()), lambda e: F.struct(e["key"].alias("key"), F.schema_of_variant(e["value"]).alias("kind")))
    entries = prepared.select(F.inline(types_of))  # a generated column is computed once, however often it is read
    plain = F.col("kind").isin("VOID", "BIGINT", "DOUBLE", "FLOAT", "BOOLEAN") | F.col("kind").startswith("DECIMAL")
    # counted, as a mere distinct below bit_or and max would be left out of the plan
    known = entries.select("key", F.when(plain, F.col("kind")).otherwise("TEXT").alias("kind")) \
        .groupBy("key", "kind").agg(F.count("*").alias("n")).where("n > 0").withColumn("name", F.lower("key"))
    decimal = r"DECIMAL\((\d+),(\d+)\)"
    part = lambda i: F.regexp_extract("kind", decimal, i).try_cast("int")
    kinds = F.when(F.col("kind") == "VOID", 0).when(F.col("kind") == "BIGINT", WHOLE).when(F.col("kind").startswith("DECIMAL"), DECIMAL) \
        .when(F.col("kind").isin("DOUBLE", "FLOAT"), DOUBLE).when(F.col("kind") == "BOOLEAN", BOOLEAN).otherwise(TEXT)
    digits = F.when(F.col("kind") == "BIGINT", LONG_DIGITS).otherwise(F.coalesce(part(1) - part(2), F.lit(0)))
    return known.groupBy("name").agg(F.bit_or(kinds).cast("int").alias("kinds"), F.max(digits).alias("digits"),
                                     F.max(F.coalesce(part(2), F.lit(0))).alias("scale"), F.sort_array(F.collect_set("key")).alias("keys"))


def merge(parts: Iterable[list[dict]]) -> list[dict]:
    """The evidence of several batches as one (the ``combine`` of a ledger)."""
    out: dict[str, dict] = {}
    for rows in parts:
        for r in rows:
            old = out.setdefault(r["name"], {"name": r["name"], "kinds": 0, "digits": 0, "scale": 0})
            old["kinds"] |= r["kinds"]
            old["digits"], old["scale"] = max(old["digits"], r["digits"]), max(old["scale"], r["scale"])
    return [out[n] for n in sorted(out)]


def types(rows: Iterable[dict]) -> dict[str, str]:
    return {r["name"]: column_type(r["kinds"], r["digits"], r["scale"]) for r in rows}


def flatten(prepared: DataFrame, p: Profile) -> tuple[DataFrame, dict[str, str]]:
    """The payload's columns in their inferred types (case twins coalesced in key order), then
    the side fields as text, which win over a payload key of the same name."""
    found = [r.asDict() for r in evidence(prepared).collect()]
    kinds = types(merge([found]))
    side = {s.lower() for s in p.side_fields}
    cols = []
    for r in sorted(found, key=lambda r: r["name"]):
        if r["name"] not in side:
            twins = [R.payload_field(k, kinds[r["name"]]) for k in r["keys"]]
            cols.append((twins[0] if len(twins) == 1 else F.coalesce(*twins)).alias(r["name"]))
    return prepared.select(*cols, *[F.col(f"`{s.lower()}`") for s in p.side_fields]), {n: t for n, t in kinds.items() if n not in side}


def with_types(table: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """A text table in the types of its columns, by lower-case name; columns without one stay,
    and a text that isn't of its column's type (a copy, say) is null."""
    out = []
    for c in table.columns:
        kind = kinds.get(c.lower(), "string")
        out.append(F.col(f"`{c}`") if kind == "string" else F.col(f"`{c}`").try_cast(kind).alias(c))
    return table.select(*out)
