"""Sinks: the stage-1 partitioned text stream (K1) and the idempotent stage-2 Parquet
writer run by ``foreachBatch`` (K2, K5, T8, T9).
"""

from __future__ import annotations

import json
import logging
import math
import re
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoal.operators import refine as R
from shoal.operators import typed as TY
from shoal.plans.profiles import Profile
from shoal.sources.stream import newest_file, read_allow_list
from shoal.streaming import catalog as C
from shoal.streaming.keys import KeyRegistry
from shoal.streaming.ledger import Ledger, file_system, read_text, write_text

log = logging.getLogger(__name__)

# A name no payload key can take: key clean-up removes every ``@``.
BATCH_COLUMN = "ingest@batch"
# Fixed values of the contract: repair the catalog every 80th batch (the first
# included); tolerate six failed batches, fail on the seventh.
REPAIR_EVERY = 80
MAX_FAILED_BATCHES = 6
MAX_BAD_FILES = 16
ROW_BYTES, SALT = "row@bytes", "salt@writer"


def layout_for_sink(df: DataFrame, layout: str = "source", files_per_hour: int | None = None) -> DataFrame:
    """Distribution of stage-1 rows before the text sink.

    ``source``: no shuffle; every source task writes its own rows (files per batch are
    bounded by tasks × hours present).  ``salted``: one shuffle keyed on date, hour and
    a salt, so a hot hour is spread over ``files_per_hour`` writers (by default the
    cluster's parallelism: a live stream's batch lies almost wholly in one hour).  The
    salt is drawn with a fixed seed along the source's order, not from the content, so a
    flood of equal messages is spread too and a retried task deals alike.  A single-writer
    layout is deliberately not offered.
    """
    if layout == "source":
        return df
    if layout == "salted":
        n = files_per_hour or df.sparkSession.sparkContext.defaultParallelism
        return df.withColumn("_salt", F.floor(F.rand(7) * n)).repartition("date", "hour", "_salt").drop("_salt")
    raise ValueError(f"unknown layout {layout!r}")


def start_text_sink(df: DataFrame, path: str, checkpoint: str, trigger: dict, name: str | None = None,
                    max_records_per_file: int | None = None):
    """K1: append clean JSON text partitioned by ``date``/``hour`` (exactly once via the
    sink's own log)."""
    writer = (
        df.writeStream.format("text")
        .outputMode("append")
        .partitionBy("date", "hour")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
    )
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", str(max_records_per_file))
    if name:
        writer = writer.queryName(name)
    return writer.start()


@dataclass
class TableWriter:
    """``foreachBatch`` body of stage 2.

    A micro-batch is a list of stage-1 files (a column ``path``) or rows (``value``).  It is
    flattened with its own key set (or the profile's columns) and written with dynamic
    partition overwrite into ``<partitions>/ingest@batch=<generation>-<batch>``: a batch that
    is replayed after a crash replaces exactly the files it wrote before, so the table holds
    every row once.  The rows of each directory are counted first: a directory of more than a
    file's worth of bytes is dealt over as many writers as it fills, any other goes to one.

    The catalog comes after the write and never undoes it: a catalog step that fails is
    logged and made up for by a repair at the next batch.  The batch's own partitions are
    known from the count; a full repair runs every ``repair_every`` batches.

    A batch whose write fails leaves no files.  Its files are halved, and the halves that
    fail halved again, until the failing files stand alone: those are noted in ``quarantine``
    with the error, all others are loaded, each part under a tag of its own.  When
    ``max_bad_files`` have been found the fault is no single file's, and what still fails is
    noted together.  A batch of rows goes to quarantine whole.  After ``max_failures`` such
    batches the query fails (the checkpoint keeps the batch open for a restart).  ``replay``
    loads what is in quarantine into the table.

    ``allow_list_path`` names a file, or a folder of versions of it: each batch takes the newest
    one in place of the profile's list.  ``registry`` chooses the columns where devices choose
    keys freely.  ``types`` (a ledger) gathers what types the payload's columns have (see
    :mod:`shoal.operators.typed`); ``loaded`` is told how many rows each batch had.
    """

    profile: Profile
    table_path: str
    generation: int = 0
    table_name: str | None = None
    quarantine_path: str | None = None
    repair_every: int = REPAIR_EVERY
    max_failures: int = MAX_FAILED_BATCHES
    max_bad_files: int = MAX_BAD_FILES
    types: Ledger | None = None
    allow_list_path: str | None = None
    registry: KeyRegistry | None = None
    loaded: Callable[[int, int], None] | None = None
    calls: int = 0
    failures: int = 0
    repairs: int = 0
    repair_due: bool = False
    begun: bool = False
    errors: list = field(default_factory=list)

    def batch_tag(self, batch_id: int) -> str:
        return f"{self.generation:04d}-{batch_id:012d}"

    @property
    def partitions(self) -> list[str]:
        return [*(c.lower() for c in self.profile.partitions), BATCH_COLUMN]

    def _profile(self, prepared: DataFrame, tag: str) -> Profile:
        """The profile as it is for this batch."""
        p = self.profile
        if self.allow_list_path:
            p = p.with_options(allow_list=read_allow_list(prepared.sparkSession, newest_file(prepared.sparkSession, self.allow_list_path)))
        if self.registry is not None:
            p = p.with_options(columns=tuple(self.registry.choose(prepared, tag)), rest_column=self.registry.rest_column)
        return p

    def _keys(self, prepared: DataFrame, p: Profile, tag: str) -> list[str] | None:
        if self.types is None:
            return None if p.columns is not None else R.discover_keys(prepared)
        found = [r.asDict() for r in TY.evidence(prepared).collect()]
        self.types.put(tag, TY.merge([found]))
        return [k for r in found for k in r["keys"]]

    def _dealt(self, table: DataFrame, prepared: DataFrame) -> tuple[DataFrame, list[dict], int]:
        """(the table dealt to its writers, the directories it fills, rows read)."""
        parts = [F.col(f"`{c}`") for c in self.partitions]
        rows, size = prepared.agg(F.count("*"), F.sum(ROW_BYTES)).first()
        dirs = table.groupBy(*parts).agg(F.count("*").alias("_n"), F.xxhash64(*parts).alias("_dir")).collect()
        target = _bytes(table.sparkSession.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64MB"))
        files = {r["_dir"]: math.ceil(r["_n"] * (size or 0) / rows / target) for r in dirs}
        hot = [x for d, n in files.items() if n > 1 for x in (F.lit(d), F.lit(n))]  # at most the batch's bytes / target
        specs = [{c: r[c] for c in self.partitions} for r in dirs]
        if not hot:
            return table.repartition(*parts), specs, rows
        n = F.coalesce(F.create_map(*hot)[F.xxhash64(*parts)], F.lit(1))
        # drawn with a fixed seed along the rows' order: a flood of equal rows is dealt, too
        return table.withColumn(SALT, F.floor(F.rand(7) * n)).repartition(*parts, SALT).drop(SALT), specs, rows

    def write(self, batch: DataFrame, tag: str) -> tuple[list[str], list[dict], int]:
        """Write a batch's files; returns the table's columns, the partitions written and how many
        rows the batch had."""
        prepared = R.prepare(batch, self.profile, size=ROW_BYTES).persist(StorageLevel.MEMORY_AND_DISK)  # read for keys and counts, then the rows
        try:
            p = self._profile(prepared, tag)
            table = R.refine(R.flatten(prepared, p, self._keys(prepared, p, tag)), p).withColumn(BATCH_COLUMN, F.lit(tag))
            dealt, specs, rows = self._dealt(table, prepared)
            (
                dealt.write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy(*self.partitions)
                .parquet(self.table_path)
            )
            return table.columns, specs, rows
        finally:
            prepared.unpersist()

    def register(self, spark: SparkSession, columns: list[str], specs: list[dict]) -> None:
        """The catalog's part of a batch whose files are written."""
        if not self.table_name:
            return
        try:
            C.ensure_table(spark, self.table_name, self.table_path, columns, self.partitions)
            C.add_partitions(spark, self.table_name, specs)
            if self.repair_due or self.calls % self.repair_every == 0:
                C.repair_table(spark, self.table_name)
                self.repairs += 1
            self.repair_due = False
        except Exception as exc:  # noqa: BLE001 — the rows are in the table; only the catalog lags
            self.repair_due = True
            log.warning("catalog step failed, made up for at the next batch: %r", exc)

    def _halve(self, spark: SparkSession, files: list[str], tag: str, bad: list[tuple[list[str], str]]) -> int:
        """Load ``files``, leaving out those that fail (added to ``bad``); returns rows loaded."""
        try:
            columns, specs, rows = self.write(read_files(spark, files), tag)
        except Exception as exc:  # noqa: BLE001 — T8: the failing files are found and left out
            self.remove(spark, tag)
            log.warning("%s file(s) of batch %s failed: %s", len(files), tag, str(exc).partition("\n")[0])
            if len(files) == 1 or len(bad) >= self.max_bad_files:
                bad.append((files, f"{type(exc).__name__}: {exc}"[:2000]))
                return 0
            half = len(files) // 2
            return self._halve(spark, files[:half], f"{tag}.0", bad) + self._halve(spark, files[half:], f"{tag}.1", bad)
        self.register(spark, columns, specs)
        return rows

    def _load_files(self, spark: SparkSession, files: list[str], tag: str) -> int:
        if not self.begun:  # what a lost driver left of this batch, perhaps by another list or in parts
            self.remove(spark, f"{tag}*")
        bad: list[tuple[list[str], str]] = []
        rows = self._halve(spark, files, tag, bad) if files else 0
        if bad:
            self._failed(tag, RuntimeError(f"{sum(len(f) for f, _ in bad)} bad files: {bad[0][1].splitlines()[0]}"))
            note = "\n".join(json.dumps({"file": f, "error": e}) for fs, e in bad for f in fs)
            write_text(spark, f"{self.quarantine_path}/{tag}.json", note)
        return rows

    def _failed(self, tag: str, exc: Exception) -> None:
        self.failures += 1
        self.errors.append((int(tag[5:17]), repr(exc)))
        log.warning("stage-2 batch %s failed (%s/%s): %r", tag, self.failures, self.max_failures, exc)
        if self.failures > self.max_failures or not self.quarantine_path:
            raise exc

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark, tag = batch.sparkSession, self.batch_tag(batch_id)
        if "path" in batch.columns:
            rows = self._load_files(spark, sorted(r["path"] for r in batch.select("path").collect()), tag)
        else:
            try:
                columns, specs, rows = self.write(batch, tag)
            except Exception as exc:  # noqa: BLE001 — T8: tolerate a few failed batches
                self._failed(tag, exc)
                self.remove(spark, tag)
                (
                    batch.select("value", F.lit(repr(exc)[:2000]).alias("error"))
                    .write.mode("overwrite")
                    .parquet(f"{self.quarantine_path}/{tag}")
                )
                return
            self.register(spark, columns, specs)
        self.calls += 1
        self.begun = True
        if self.loaded is not None:
            self.loaded(batch_id, rows)

    def remove(self, spark: SparkSession, tag: str) -> None:
        """Delete what a failed write of the batch may have left in the table."""
        fs, path = file_system(spark, f"{self.table_path}/{'*/' * len(self.profile.partitions)}{BATCH_COLUMN}={tag}")
        for found in fs.globStatus(path) or []:
            fs.delete(found.getPath(), True)

    def replay(self, spark: SparkSession) -> list[str]:
        """Load what is in quarantine into the table, under tags of its own; returns the tags.
        A quarantined batch or note is deleted only after its rows are written, and one
        replayed twice replaces its own files."""
        fs, path = file_system(spark, f"{self.quarantine_path}/*")
        done = []
        for status in sorted(fs.globStatus(path) or [], key=lambda s: s.getPath().getName()):
            held = f"{self.quarantine_path}/{status.getPath().getName()}"
            tag = status.getPath().getName().removesuffix(".json")
            if status.isDirectory():
                rows = spark.read.parquet(held).select("value")
            elif held.endswith(".json"):
                files = [json.loads(x)["file"] for x in read_text(spark, held).splitlines()]
                rows, tag = read_files(spark, files), f"{tag}.r"
            else:
                continue
            columns, specs, _ = self.write(rows, tag)
            self.register(spark, columns, specs)
            fs.delete(file_system(spark, held)[1], True)
            done.append(tag.removesuffix(".r"))
        return done


_LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def read_files(spark: SparkSession, files: list[str]) -> DataFrame:
    """The lines of stage-1 files.  A file that cannot be read is an error here.  The files are
    looked up here and now, by a task a core: by default it would be a task a file."""
    old = spark.conf.get(_LISTING_TASKS)
    spark.conf.set(_LISTING_TASKS, str(spark.sparkContext.defaultParallelism))
    try:
        return spark.read.schema("value STRING").option("recursiveFileLookup", "true").option("ignoreCorruptFiles", "false") \
            .option("ignoreMissingFiles", "false").text(files).select("value")
    finally:
        spark.conf.set(_LISTING_TASKS, old)


def _bytes(text: str) -> int:
    """A size setting (``64MB``, ``16kb``, ``1024``) in bytes."""
    number, unit = re.fullmatch(r"(\d+)\s*([a-z]*)", text.strip().lower()).groups()
    return int(number) * 1024 ** "bkmgtp".index(unit[:1] or "b")


_INFER_PARTITION_TYPES = "spark.sql.sources.partitionColumnTypeInference.enabled"


def read_table(spark: SparkSession, table_path: str, drop_batch: bool = True) -> DataFrame:
    """The stage-2 table straight from its files (all batches, all columns).

    Partition values stay text (``0123`` must not become 123): type inference is off
    while the relation is resolved, and only then."""
    old = spark.conf.get(_INFER_PARTITION_TYPES, "true")
    spark.conf.set(_INFER_PARTITION_TYPES, "false")
    try:
        df = spark.read.option("mergeSchema", "true").parquet(table_path)
        df.schema  # resolve now, under the setting above
    finally:
        spark.conf.set(_INFER_PARTITION_TYPES, old)
    return df.drop(BATCH_COLUMN) if drop_batch else df


def read_typed_table(spark: SparkSession, table_path: str, p: Profile, types: Ledger) -> DataFrame:
    """The stage-2 table in the types its payload has shown in all batches so far; a copied
    column has its source's type, partition columns stay text."""
    kinds = TY.types(types.read())
    for target, source in p.copies:
        kinds[target.lower()] = kinds.get(source.lower(), "string")
    kinds |= {c.lower(): R.DECIMAL_TYPE for c in p.decimal_columns}
    kinds |= {c.lower(): "string" for c in p.partitions}
    return TY.with_types(read_table(spark, table_path), kinds)
