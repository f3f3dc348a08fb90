"""Catalog upkeep for stage-2 tables (K5, K6): create, widen, repair partitions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import SparkSession


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def ensure_table(
    spark: SparkSession, name: str, path: str, columns: Sequence[str], partitions: Sequence[str]
) -> list[str]:
    """Create the external Parquet table over ``path`` or add the columns it lacks.
    Every column is a string.  Returns the columns that were added."""
    data_cols = [c for c in columns if c not in partitions]
    if not table_exists(spark, name):
        cols = ", ".join(f"{_q(c)} STRING" for c in [*data_cols, *partitions])
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet "
            f"PARTITIONED BY ({', '.join(_q(p) for p in partitions)}) LOCATION '{path}'"
        )
        return list(data_cols)
    have = {f.name.lower() for f in spark.table(name).schema.fields}
    new = [c for c in data_cols if c.lower() not in have]
    if new:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(f'{_q(c)} STRING' for c in new)})")
    return new


def _lit(v: str | None) -> str:
    return "NULL" if v is None else "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def add_partitions(spark: SparkSession, name: str, specs: Sequence[dict]) -> None:
    """Register the partitions one batch wrote (cost: that batch's partitions, not the
    table's).  A null value is registered as the null partition."""
    if specs:
        parts = " ".join(
            "PARTITION (" + ", ".join(f"{_q(k)} = {_lit(v)}" for k, v in spec.items()) + ")" for spec in specs
        )
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {parts}")


def drop_partitions(spark: SparkSession, name: str, specs: Sequence[dict]) -> None:
    """Forget partitions (the table is external: no file is deleted)."""
    if specs:
        parts = ", ".join(
            "PARTITION (" + ", ".join(f"{_q(k)} = {_lit(v)}" for k, v in spec.items()) + ")" for spec in specs
        )
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {parts}")


def repair_table(spark: SparkSession, name: str) -> None:
    """K5: register partitions written since the last repair."""
    spark.catalog.recoverPartitions(name)


def repair_tables(spark: SparkSession, names: str | Iterable[str]) -> list[str]:
    """K6: repair a comma-separated list (or iterable) of tables."""
    items = names.split(",") if isinstance(names, str) else list(names)
    done = []
    for n in (x.strip() for x in items):
        if n:
            spark.sql(f"MSCK REPAIR TABLE {n}")
            done.append(n)
    return done
