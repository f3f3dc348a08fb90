"""Stage-2 column operators: payload discovery and flattening, then refinement.

Flattening keeps the payload object as ``VARIANT`` and turns each key into a column with
``try_variant_get`` (binary search in the sorted fields) — no re-parse and no schema
inference pass over the data.  The key list is the only thing collected to the driver.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoal.functions import jsonfn as J
from shoal.functions import jsonsql as Q
from shoal.functions import timefn as T
from shoal.operators import filters as FL
from shoal.plans.profiles import Profile

PAYLOAD = "_payload"
DECIMAL_TYPE = "decimal(18,0)"


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def prepare(df: DataFrame, p: Profile, text: str = "value", size: str | None = None, parsed: bool = False) -> DataFrame:
    """Parse once (unless the column is ``parsed``); keep the payload (``VARIANT``) and the root
    side fields (as text), and the text's length in bytes as the column ``size``, if asked for.
    The parse is bound once per row, so the flattened columns and the refine filters
    built on top read attributes instead of re-parsing."""

    def fields(d: str) -> str:
        side = "".join(f", {Q.lit(s.lower())}, CAST({d}[{Q.lit(s)}] AS STRING)" for s in p.side_fields)
        return f"named_struct({Q.lit(PAYLOAD)}, {d}[{Q.lit(p.payload)}]{side})"

    row = F.expr(fields(Q.ident(text)) if parsed else Q.let(Q.parse_doc(Q.ident(text)), fields))
    own = df.select(text) if size is None else df.select(text, F.octet_length(text).alias(size))
    return J.bind_once(own, row).drop(text)


def payload_map() -> Column:
    return F.col(PAYLOAD).try_cast(J.DOC_TYPE)  # null unless the payload is an object


def payload_field(key: str, kind: str = "string") -> Column:
    """One payload value, as text or in another type.  ``VARIANT`` objects keep their fields sorted, so
    ``try_variant_get`` finds a key by binary search — O(log n) per column, where a map
    lookup would scan every entry for every column of a wide payload."""
    if "'" not in key:
        return F.try_variant_get(F.col(PAYLOAD), f"$['{key}']", kind)
    if '"' not in key:
        return F.try_variant_get(F.col(PAYLOAD), f'$["{key}"]', kind)
    return payload_map()[key].try_cast(kind)


def discover_keys(prepared: DataFrame) -> list[str]:
    """Distinct payload keys of the batch, sorted: the columns of a table that has one for
    every key.  Map-side partial aggregation keeps the shuffle to one row per key and task.
    Where devices choose keys freely (ids as keys), the profile names its columns instead
    (``Profile.columns``), and nothing is discovered or collected."""
    keys = prepared.select(F.explode(F.map_keys(payload_map())).alias("k")).distinct()
    return sorted(r["k"] for r in keys.collect())


def _lower_groups(keys: Iterable[str]) -> dict[str, list[str]]:
    groups: dict[str, list[str]] = {}
    for k in sorted(set(keys)):
        groups.setdefault(k.lower(), []).append(k)
    return groups


def flatten(prepared: DataFrame, p: Profile, keys: Sequence[str] | None = None) -> DataFrame:
    """One string column per payload key (lower-case; case twins coalesced in key
    order), then the side fields, which win over a payload key of the same name.

    ``keys`` are the payload's keys; a profile with ``columns`` has just these, and all
    other keys, as one JSON object, in the column ``rest_column`` names: the same shape
    whatever a batch holds."""
    side = {s.lower() for s in p.side_fields}
    if p.columns is not None:
        wanted = {c.lower() for c in p.columns}
        names = [c for c in sorted(wanted) if c not in side]
        fields = F.transform_keys(payload_map(), lambda k, v: F.lower(k))  # the last of case twins, as in sorted order
        cols = [fields[c].cast("string").alias(c) for c in names]
        if p.rest_column:
            rest = F.map_filter(payload_map(), lambda k, v: ~F.lower(k).isin(sorted(wanted | side)))
            cols.append(F.when(F.size(rest) > 0, F.to_json(rest)).alias(p.rest_column.lower()))
        return prepared.select(*cols, *[_q(s.lower()) for s in p.side_fields])
    groups = _lower_groups(keys if keys is not None else discover_keys(prepared))
    cols = []
    for name in (n for n in sorted(groups) if n not in side):
        variants = [payload_field(k) for k in groups[name]]
        cols.append((variants[0] if len(variants) == 1 else F.coalesce(*variants)).alias(name))
    return prepared.select(*cols, *[_q(s.lower()) for s in p.side_fields])


def drop_present(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop columns whose (case-insensitive) name is listed; absent names are fine."""
    wanted = {n.lower() for n in names}
    return df.select(*[_q(c) for c in df.columns if c.lower() not in wanted])


def copy_columns(df: DataFrame, copies: Iterable[tuple[str, str]]) -> DataFrame:
    """``target`` ← ``source``; a missing source gives a column of nulls."""
    for target, source in copies:
        present = {c.lower(): c for c in df.columns}
        src = _q(present[source.lower()]) if source.lower() in present else F.lit(None).cast("string")
        df = df.withColumn(target.lower(), src)
    return df


def decimal_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """DECIMAL(18,0) (half-up) for the listed columns that exist; junk → null."""
    present = {c.lower(): c for c in df.columns}
    changes = {present[n.lower()]: _q(present[n.lower()]).try_cast(DECIMAL_TYPE)
               for n in dict.fromkeys(names) if n.lower() in present}
    return df.withColumns(changes) if changes else df


def all_strings_lower(df: DataFrame) -> DataFrame:
    """P11 + P12: every column as text, lower-case names, case twins coalesced."""
    groups: dict[str, list[str]] = {}
    for c in sorted(df.columns):
        groups.setdefault(c.lower(), []).append(c)
    out = []
    for name in sorted(groups):
        parts = [_q(c).cast("string") for c in groups[name]]
        out.append((parts[0] if len(parts) == 1 else F.coalesce(*parts)).alias(name))
    return df.select(*out)


def has_column(df: DataFrame, path: str) -> bool:
    """Does ``path`` (possibly dotted) resolve against the schema."""
    from pyspark.sql.types import StructType

    dtype = df.schema
    for part in path.split("."):
        if not isinstance(dtype, StructType):
            return False
        match = [f for f in dtype.fields if f.name.lower() == part.lower()]
        if not match:
            return False
        dtype = match[0].dataType
    return True


def drop_duplicate_columns(df: DataFrame, other: DataFrame) -> DataFrame:
    """After a join, drop ``other``'s copy of every column name that occurs twice."""
    seen: dict[str, int] = {}
    for c in df.columns:
        seen[c] = seen.get(c, 0) + 1
    for c in [c for c, n in seen.items() if n > 1]:
        df = df.drop(other[c])
    return df


def refine(flat: DataFrame, p: Profile) -> DataFrame:
    """Profile refinement of a flattened batch; the result is the table's shape."""
    present = {c.lower() for c in flat.columns}
    df = flat
    if p.time_field.lower() in present:
        df = df.withColumn(p.time_field.lower(), T.normalize_epoch(p.time_field.lower()))
    df = drop_present(df, p.drops)
    df = copy_columns(df, p.copies)
    if p.type_hygiene:
        df = FL.type_hygiene(df, "event_type")
    if p.allow_list is not None:
        df = FL.allow_list_filter(df, p.allow_list, scope=p.allow_scope)
    if p.decimal_columns:
        df = decimal_columns(df, p.decimal_columns)
    df = all_strings_lower(df)
    for part in p.partitions:
        if part.lower() not in df.columns:
            df = df.withColumn(part.lower(), F.lit(None).cast("string"))
    return df
