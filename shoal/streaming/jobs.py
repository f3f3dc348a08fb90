"""The two streaming queries of a profile, their paths, progress and lag.

query 1  raw source → stage 1 → text sink, ``raw/gen=G`` partitioned by date/hour
query 2  stream of the names of the files in ``raw/gen=G`` (at most
         ``max_files_per_trigger`` per batch) → ``TableWriter``, which reads them →
         Parquet table, catalog repair

Both queries own a checkpoint; a restart resumes where each left off, which also
covers the backlog at start (T5).  ``clean_start`` opens a new generation — fresh
checkpoints and a fresh raw directory — and deletes nothing.
"""

from __future__ import annotations

import logging
import time
from dataclasses import dataclass

from pyspark.sql import SparkSession

from shoal.operators import typed as TY
from shoal.plans.profiles import Profile
from shoal.plans.stages import stage1
from shoal.session import configure, scratch_root
from shoal.sources.stream import SourceOptions, read_file_names, read_stream
from shoal.streaming import progress as P
from shoal.streaming.ledger import Ledger, file_system, write_text
from shoal.streaming.sinks import TableWriter, layout_for_sink, start_text_sink

log = logging.getLogger(__name__)

# Fixed values of the contract: more than 5 batches of lag call for a catch-up, more than
# 10 stop the job; stage 2 takes at most 1,000 files per batch.  (A restart always drains
# stage 2's backlog, see ``run_forever``.)
CATCH_UP_LAG = 5
MAX_LAG = 10
FILES_PER_BATCH = 1000
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
BOUNDED = "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage"
RAW_PARTITIONS = "date STRING, hour STRING"


class LagError(RuntimeError):
    """Stage 2 fell too far behind its source."""


def list_generations(spark: SparkSession, root: str) -> list[int]:
    fs, p = file_system(spark, root)
    if not fs.exists(p):
        return []
    gens = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith("gen="):
            try:
                gens.append(int(name[4:]))
            except ValueError:
                pass
    return sorted(gens)


@dataclass(frozen=True)
class StreamPaths:
    """Where a profile's stream keeps its data, all under one shared root."""

    root: str
    generation: int = 0

    @staticmethod
    def open(spark: SparkSession, root: str | None, clean_start: bool = False) -> "StreamPaths":
        root = (root or f"{scratch_root(spark)}/shoal").rstrip("/")
        gens = list_generations(spark, f"{root}/checkpoints")
        gen = (gens[-1] + 1 if gens else 0) if clean_start else (gens[-1] if gens else 0)
        return StreamPaths(root, gen)

    @property
    def raw(self) -> str:
        return f"{self.root}/raw/gen={self.generation:04d}"

    @property
    def table(self) -> str:
        return f"{self.root}/table"

    @property
    def quarantine(self) -> str:
        return f"{self.root}/quarantine"

    @property
    def stop_marker(self) -> str:
        return f"{self.root}/stop"

    @property
    def types(self) -> str:
        return f"{self.root}/ledger/types"

    @property
    def keys(self) -> str:
        return f"{self.root}/ledger/keys"

    @property
    def progress(self) -> str:
        return f"{self.root}/ledger/gen={self.generation:04d}"

    def checkpoint(self, stage: str) -> str:
        return f"{self.root}/checkpoints/gen={self.generation:04d}/{stage}"


def finished(query, timeout: float | None) -> None:
    """Wait for an ``availableNow`` query; an error or a timeout stops it and is raised, so
    that nothing goes on from half of its output."""
    done = query.awaitTermination(timeout) if timeout is not None else query.awaitTermination()
    if query.exception():
        raise query.exception()
    if timeout is not None and not done:
        query.stop()
        raise TimeoutError(f"{query.name} did not finish in {timeout} s")


def request_stop(spark: SparkSession, paths: StreamPaths) -> None:
    """Ask the job that runs under ``paths`` to stop in good order."""
    write_text(spark, paths.stop_marker, "stop")


@dataclass
class ProfileStream:
    """Both queries of one profile."""

    spark: SparkSession
    profile: Profile
    source: SourceOptions
    paths: StreamPaths
    table_name: str | None = None
    layout: str = "source"
    files_per_hour: int | None = None  # of the salted layout; None: the cluster's parallelism
    max_files_per_trigger: int = FILES_PER_BATCH
    max_lag: int = MAX_LAG
    max_behind: int | None = None  # records of a Kafka source not read yet that stop the job
    typed: bool = False  # gather the payload's types (see ``read_typed_table``)

    def __post_init__(self):
        configure(self.spark)
        self.recorder = P.recorder(self.spark, self.paths.progress, self._name("stage1_rows"), self._name("stage1"))
        types = Ledger(self.spark, self.paths.types, TY.merge) if self.typed else None
        self.writer = TableWriter(
            self.profile, self.paths.table, self.paths.generation, self.table_name, self.paths.quarantine, types=types
        )

    def _name(self, stage: str) -> str:
        return f"{self.profile.name}_{stage}_g{self.paths.generation}"

    def start_stage1(self, trigger: dict):
        if self.profile.seen_within:  # seen events are kept on disk, not in the executors' heap
            self.spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
            if self.spark.conf.get(BOUNDED, None) is None:  # one pool for all partitions' buffers, however many there are
                self.spark.conf.set(BOUNDED, "true")
        raw = read_stream(self.spark, self.source)
        clean = stage1(raw, self.profile, observe=self._name("stage1_rows"))
        clean = layout_for_sink(clean, self.layout, self.files_per_hour)
        return start_text_sink(clean, self.paths.raw, self.paths.checkpoint("stage1"), trigger, self._name("stage1"))

    def start_stage2(self, trigger: dict, stage: str = "stage2"):
        fs, raw_dir = file_system(self.spark, self.paths.raw)
        fs.mkdirs(raw_dir)  # stage 2 may start before stage 1 wrote anything
        self.writer.loaded = self.recorder.loaded
        names = read_file_names(self.spark, SourceOptions(format="text", path=self.paths.raw, schema=RAW_PARTITIONS,
                                                               max_files_per_trigger=self.max_files_per_trigger))
        return (
            names.writeStream.foreachBatch(self.writer)
            .option("checkpointLocation", self.paths.checkpoint("stage2"))
            .queryName(self._name(stage))
            .trigger(**trigger)
            .start()
        )

    def run_available_now(self, timeout: float | None = None) -> None:
        """Process everything available through both stages, then stop (jobs, tests)."""
        self.spark.streams.addListener(self.recorder)
        try:
            q1 = self.start_stage1({"availableNow": True})
            finished(q1, timeout)
            self.recorder.add_all(q1)
        finally:
            self.spark.streams.removeListener(self.recorder)
        self.catch_up(timeout)

    def catch_up(self, timeout: float | None = None) -> None:
        """T5: load what stage 1 already wrote and stage 2 has not (no-op if nothing)."""
        finished(self.start_stage2({"availableNow": True}, "catch_up"), timeout)

    def _guard(self) -> None:
        """Too far behind is an error.  The counts outlive a job, so they hold at its start."""
        lag, behind = self.recorder.lag, self.recorder.behind
        if lag > self.max_lag:
            raise LagError(f"{self._name('stage2')} is {lag} batches behind")
        if self.max_behind is not None and (behind or 0) > self.max_behind:
            raise LagError(f"{self._name('stage1')} is {behind} records behind its source")
        if lag > CATCH_UP_LAG:
            log.warning("%s is %s batches behind", self._name("stage2"), lag)

    def _stop_asked(self) -> bool:
        fs, marker = file_system(self.spark, self.paths.stop_marker)
        return fs.exists(marker)

    def _take_stop(self) -> None:
        fs, marker = file_system(self.spark, self.paths.stop_marker)
        fs.delete(marker, False)

    def _stop_in_order(self, q1, q2, grace: float) -> None:
        """Stage 1 ends between two batches (within one, after ``grace`` seconds: it is run
        again at the next start), stage 2 likewise, then loads what stage 1 has left it."""
        for q in (q1, q2):
            until = time.time() + grace
            while q.isActive and q.status["isTriggerActive"] and time.time() < until:
                time.sleep(0.02)
            q.stop()
        self.recorder.add_all(q1)
        self.catch_up()
        log.info("%s stopped as asked, %s batches behind", self.profile.name, self.recorder.lag)

    def run_forever(self, trigger_seconds: int, poll: float = 10.0, catch_up: bool = True, grace: float = 300.0):
        """Both queries on a processing-time trigger until one ends or a stop is asked for
        (:func:`request_stop`); stops both and raises ``LagError`` when stage 2 lags more than
        ``max_lag`` stage-1 batches.  Stage 1 reads its source from the start, while the
        backlog of stage 2 is loaded first (T5): the catch-up takes what is there when it
        begins.  Without a catch-up, a job that starts too far behind raises at once."""
        if not catch_up:
            self._guard()
        self._take_stop()  # one asked of an earlier run
        self.spark.streams.addListener(self.recorder)
        trigger = {"processingTime": f"{trigger_seconds} seconds"}
        queries = []
        try:
            backlog = self.start_stage2({"availableNow": True}, "catch_up") if catch_up else None
            if backlog is not None:
                queries.append(backlog)
            q1 = self.start_stage1(trigger)
            queries.append(q1)
            if backlog is not None:
                finished(backlog, None)
            q2 = self.start_stage2(trigger)
            queries.append(q2)
            while q1.isActive and q2.isActive:
                if self._stop_asked():
                    self._stop_in_order(q1, q2, grace)
                    self._take_stop()
                    return
                q2.awaitTermination(poll)
                self._guard()
            for q in (q1, q2):
                if q.exception():
                    raise q.exception()
        finally:
            for q in queries:
                if q.isActive:
                    q.stop()
            self.spark.streams.removeListener(self.recorder)
