"""The small files of many batches become few, without a row lost or read twice.

A batch leaves at least one file in every directory it touches, so a directory of a busy table
gathers thousands.  A run lists the table's files with Spark, takes the directories that hold
enough small ones, and deals their files into bins of about ``target`` bytes (a running sum of
sizes).  One job rewrites all bins: rows meet their file's bin by the file's name, and each
bin is one output file in a staging directory beside the table.  Then, per directory:

1. the staged rows are counted against the rows of the files they replace;
2. a journal names the batches that are replaced; from here on readers of the table (by
   :func:`settled`) pass over these once the new directory is there;
3. the staged directory is renamed into its place, one rename;
4. the catalog drops the old partitions and has the new one;
5. only then the old directories are deleted.

A directory whose count or rename fails keeps its files; a run that ends half-way is finished
or undone from its journal by the next one.  The newest batch of a generation is never
touched: a crash may yet write it again.
"""

from __future__ import annotations

import json
import logging
import uuid
from collections import defaultdict
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shoal.plans.profiles import Profile
from shoal.streaming import catalog as C
from shoal.streaming.ledger import file_system, read_text, write_text
from shoal.streaming.sinks import BATCH_COLUMN, read_table

log = logging.getLogger(__name__)
TARGET_BYTES = 128 << 20
MIN_FILES = 4
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
PATH, SLOT, BIN = "compact@path", "compact@slot", "compact@bin"
MARK = "~c"  # a compacted directory's tag: that of its newest batch, and the run


@dataclass
class Compactor:
    """Compaction of one stage-2 table."""

    spark: SparkSession
    profile: Profile
    table_path: str
    table_name: str | None = None
    target: int = TARGET_BYTES
    min_files: int = MIN_FILES

    @property
    def journals(self) -> str:
        return f"{self.table_path.rstrip('/')}.compaction"

    @property
    def parts(self) -> list[str]:
        return [c.lower() for c in self.profile.partitions]

    def files(self) -> DataFrame:
        """(dir, tag, path, length) of the table's files; the listing is Spark's own."""
        found = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet") \
            .load(self.table_path).select("path", "length")
        split = F.regexp_extract("path", f"^(.*)/{BATCH_COLUMN}=([^/]*)/[^/]*$", 1).alias("dir"), \
            F.regexp_extract("path", f"/{BATCH_COLUMN}=([^/]*)/[^/]*$", 1).alias("tag")
        return found.select(*split, "path", "length")

    def plan(self) -> DataFrame:
        """(dir, tag, path, bin) of the files to rewrite: those of directories with ``min_files``
        or more files under half the target."""
        files = self.files()
        newest = F.max(F.substring_index("tag", MARK, 1)).over(Window.partitionBy(F.substring("tag", 1, 4)))
        settled = files.withColumn("newest", newest).where("NOT startswith(tag, newest)").where(F.col("length") < self.target / 2)
        by_dir = Window.partitionBy("dir").orderBy("tag", "path")
        binned = settled.withColumn("n", F.count("*").over(Window.partitionBy("dir"))).where(F.col("n") >= self.min_files) \
            .withColumn("bin", F.floor((F.sum("length").over(by_dir) - F.col("length")) / self.target))
        return binned.select("dir", "tag", "path", "bin")

    def run(self) -> int:
        """Compact what needs it; returns how many directories were switched."""
        self.recover()
        plan = self.plan().persist()
        try:
            # a batch's directory goes as a whole: none that also holds big files
            big = self.files().where(F.col("length") >= self.target / 2).select("dir", "tag").distinct()
            old = defaultdict(list)
            for r in plan.select("dir", "tag").distinct().join(big, ["dir", "tag"], "left_anti").orderBy("dir", "tag").collect():
                old[r["dir"]].append(r["tag"])
            dirs = sorted(d for d, tags in old.items() if len(tags) > 1)
            if not dirs:
                return 0
            run = uuid.uuid4().hex[:8]
            stage = f"{self.journals}/stage-{run}"
            chosen = self.spark.createDataFrame([(d, t, k) for k, d in enumerate(dirs) for t in old[d]], "dir string, tag string, slot int")
            work = plan.join(chosen, ["dir", "tag"]).persist()
            try:
                counts = self._rewrite(work, stage)
            finally:
                work.unpersist()
            return sum(self._switch(run, f"{stage}/{SLOT}={k}", d, old[d], counts.get(k)) for k, d in enumerate(dirs))
        finally:
            plan.unpersist()

    def _rewrite(self, work: DataFrame, stage: str) -> dict[int, int]:
        """Write the bins under ``stage`` in one job; how many rows each slot has by its sources."""
        paths = [r["path"] for r in work.select("path").collect()]  # names only, as many as the run rewrites
        rows = self.spark.read.option("mergeSchema", "true").option("basePath", self.table_path).parquet(*paths)
        rows = rows.drop(*self.parts, BATCH_COLUMN).withColumn(PATH, F.col("_metadata.file_path"))
        bins = work.select(F.col("path").alias(PATH), F.col("slot").alias(SLOT), F.col("bin").alias(BIN))
        rows.join(bins, PATH).drop(PATH).repartition(SLOT, BIN).write.partitionBy(SLOT, BIN).parquet(stage)
        source = self.spark.read.option("basePath", self.table_path).parquet(*paths).select(F.col("_metadata.file_path").alias(PATH))
        return {r[SLOT]: r["count"] for r in source.join(bins, PATH).groupBy(SLOT).count().collect()}

    def _switch(self, run: str, staged: str, folder: str, tags: list[str], rows: int | None) -> int:
        """Put one directory's compacted files in the place of its batches'."""
        spark = self.spark
        fs, _ = file_system(spark, folder)
        have = spark.read.option("recursiveFileLookup", "true").parquet(staged).count()
        if have != rows:
            log.warning("%s: %s rows staged, %s read; left as it is", folder, have, rows)
            return 0
        new = f"{max(t.split(MARK)[0] for t in tags)}{MARK}{run}"
        journal = f"{self.journals}/{run}-{staged.rpartition('=')[2]}.json"
        write_text(spark, journal, json.dumps({"dir": folder, "new": new, "old": tags}))
        try:
            self._flatten(staged)
            self.rename(staged, f"{folder}/{BATCH_COLUMN}={new}")
        except Exception as exc:  # noqa: BLE001 — the old files are all there
            log.warning("%s is left as it is: %r", folder, exc)
            fs.delete(file_system(spark, journal)[1], False)
            return 0
        self._finish(journal)
        return 1

    def _flatten(self, staged: str) -> None:
        """The files of all bins side by side."""
        fs, path = file_system(self.spark, f"{staged}/*/*.parquet")
        for s in fs.globStatus(path):
            place = s.getPath().getParent().getName().rpartition("=")[2]
            self.rename(s.getPath().toString(), f"{staged}/{place}-{s.getPath().getName()}")
        for s in fs.globStatus(file_system(self.spark, f"{staged}/{BIN}=*")[1]):
            fs.delete(s.getPath(), True)

    def rename(self, source: str, target: str) -> None:
        fs, src = file_system(self.spark, source)
        if not fs.rename(src, file_system(self.spark, target)[1]):
            raise OSError(f"cannot rename {source} to {target}")

    def _spec(self, folder: str, tag: str) -> dict:
        values = {}
        for part in folder.split("/")[-len(self.parts):]:
            name, _, value = part.partition("=")
            values[unquote(name)] = None if value == NULL_PARTITION else unquote(value)
        return {**values, BATCH_COLUMN: tag}

    def _finish(self, journal: str) -> None:
        """The new directory stands: switch the catalog, then delete the old ones."""
        entry = json.loads(read_text(self.spark, journal))
        folder, old = entry["dir"], entry["old"]
        if self.table_name:
            C.drop_partitions(self.spark, self.table_name, [self._spec(folder, t) for t in old])
            C.add_partitions(self.spark, self.table_name, [self._spec(folder, entry["new"])])
        fs, path = file_system(self.spark, journal)
        for t in old:
            fs.delete(file_system(self.spark, f"{folder}/{BATCH_COLUMN}={t}")[1], True)
        fs.delete(path, False)

    def open_journals(self) -> list[tuple[str, dict]]:
        fs, path = file_system(self.spark, f"{self.journals}/*.json")
        names = [s.getPath().toString() for s in fs.globStatus(path) or []]
        return [(n, json.loads(read_text(self.spark, n))) for n in names]

    def recover(self) -> None:
        """Finish or undo what a run that ended half-way has left."""
        for journal, entry in self.open_journals():
            fs, new = file_system(self.spark, f"{entry['dir']}/{BATCH_COLUMN}={entry['new']}")
            if fs.exists(new):
                self._finish(journal)
            else:
                fs.delete(file_system(self.spark, journal)[1], False)
        fs, path = file_system(self.spark, f"{self.journals}/stage-*")
        for s in fs.globStatus(path) or []:
            fs.delete(s.getPath(), True)


def settled(spark: SparkSession, profile: Profile, table_path: str) -> DataFrame:
    """The stage-2 table as it is read while a compaction may run: batches that an open journal
    replaces, and whose new directory is there, are passed over."""
    c = Compactor(spark, profile, table_path)
    gone = []
    for _, entry in c.open_journals():
        fs, new = file_system(spark, f"{entry['dir']}/{BATCH_COLUMN}={entry['new']}")
        if fs.exists(new):
            gone += [tuple(c._spec(entry["dir"], t)[p] for p in [*c.parts, BATCH_COLUMN]) for t in entry["old"]]
    table = read_table(spark, table_path, drop_batch=False)
    if gone:
        names = [*c.parts, BATCH_COLUMN]
        old = spark.createDataFrame(gone, ", ".join(f"`old@{n}` string" for n in names))
        same = F.lit(True)
        for n in names:
            same = same & F.col(f"`{n}`").eqNullSafe(F.col(f"`old@{n}`"))
        table = table.join(old, same, "left_anti")
    return table.drop(BATCH_COLUMN)
