"""Streaming driver queries: the real two-query stream, run with ``availableNow`` over
device JSON files Spark writes from the whole ``events`` table.  Each returns the
stage-2 table and must equal the batch answer of its profile (same oracle SQL).
"""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoal.operators import refine as R
from shoal.operators import typed as TY
from shoal.plans import driver_queries as DQ
from shoal.plans.profiles import PROFILES
from shoal.plans.stages import stage1
from shoal.session import configure, scratch_root
from shoal.sources.envelope import device_messages
from shoal.sources.envelope import read_table as read_source
from shoal.sources.stream import SourceOptions, read_stream
from shoal.streaming import catalog as C
from shoal.streaming.compaction import Compactor, settled
from shoal.streaming.jobs import LagError, ProfileStream, StreamPaths, finished, request_stop
from shoal.streaming.keys import KeyRegistry
from shoal.streaming.ledger import Ledger, file_system, write_text
from shoal.streaming.sinks import BATCH_COLUMN, TableWriter, read_table, read_typed_table

INPUT_FILES = 8
INPUT_FILES_PER_TRIGGER = 8  # one stage-1 batch per arrival (the catch-up check has two)
# The replayed month is spread over ~720 hours; salting by two keeps a hot hour split
# while bounding the files each hour gets per batch.
LAYOUT, FILES_PER_HOUR = "salted", 2
# Fixed value of the check: the two arrivals of the catch-up query split at this time.
SECOND_ARRIVAL = "2024-01-16 00:00:00"


def _fresh_root(spark: SparkSession, tag: str) -> str:
    return f"{scratch_root(spark)}/shoal-check-{tag}-{uuid.uuid4().hex[:12]}"


def _write_input(spark: SparkSession, sf_dir: str, family: str, path: str, where=None, without=()) -> None:
    msgs = device_messages(spark, sf_dir, family, keep=("ts",), without=without)
    if where is not None:
        msgs = msgs.filter(where)
    msgs.select("value").repartition(INPUT_FILES).write.mode("append").text(path)


def _stream(spark, root, key, table_name=None, writer=None) -> ProfileStream:
    p = PROFILES[key]
    src = SourceOptions(format="text", path=f"{root}/input", max_files_per_trigger=INPUT_FILES_PER_TRIGGER)
    job = ProfileStream(spark, p, src, StreamPaths.open(spark, root), table_name=table_name,
                        layout=LAYOUT, files_per_hour=FILES_PER_HOUR)
    if writer is not None:
        job.writer = writer
    return job


def q_stream_two_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    root = _fresh_root(spark, "e6")
    _write_input(spark, sf_dir, "events", f"{root}/input")
    _stream(spark, root, "e6").run_available_now()
    return read_table(spark, f"{root}/table")


def q_stream_catch_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two arrivals; the second run resumes from both checkpoints (T5)."""
    configure(spark)
    root = _fresh_root(spark, "m7")
    cut = F.lit(SECOND_ARRIVAL).cast("timestamp_ntz")
    _write_input(spark, sf_dir, "metrics", f"{root}/input", F.col("ts") < cut)
    _stream(spark, root, "m7").run_available_now()
    _write_input(spark, sf_dir, "metrics", f"{root}/input", F.col("ts") >= cut)
    _stream(spark, root, "m7").run_available_now()
    return read_table(spark, f"{root}/table")


def q_stream_repair_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows seen through the catalog table after partition repair (K5)."""
    configure(spark)
    root = _fresh_root(spark, "m5")
    name = "shoal_check_" + root.rsplit("-", 1)[-1]
    _write_input(spark, sf_dir, "metrics", f"{root}/input")
    _stream(spark, root, "m5", table_name=name).run_available_now()
    return spark.table(name).drop(BATCH_COLUMN)


def q_stream_schema_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table gains a column between two arrivals (older devices did not send
    ``viewing_duration``); the merged read holds every row under the union of columns."""
    configure(spark)
    root = _fresh_root(spark, "e7s")
    cut = F.lit(SECOND_ARRIVAL).cast("timestamp_ntz")
    _write_input(spark, sf_dir, "events", f"{root}/input", F.col("ts") < cut, without=("viewing_duration",))
    _stream(spark, root, "e7").run_available_now()
    _write_input(spark, sf_dir, "events", f"{root}/input", F.col("ts") >= cut)
    _stream(spark, root, "e7").run_available_now()
    return read_table(spark, f"{root}/table")


class _CrashOnce(TableWriter):
    """Fails right after the data of one batch is written (before the commit): the write's
    own tolerance is off, as a lost driver has none."""

    crash_batch = 0
    crashed = False

    def register(self, spark, columns, specs):
        super().register(spark, columns, specs)
        if self.calls == self.crash_batch and not self.crashed:
            self.crashed = True
            raise RuntimeError("simulated loss after the write")


def q_stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch replayed after a crash between write and commit is written once."""
    configure(spark)
    root = _fresh_root(spark, "e7")
    _write_input(spark, sf_dir, "events", f"{root}/input")
    job = _stream(spark, root, "e7")
    job.writer = _CrashOnce(job.profile, job.paths.table, job.paths.generation)
    try:
        job.run_available_now()
    except Exception as exc:  # noqa: BLE001
        if "simulated loss" not in str(exc):
            raise
    if not job.writer.crashed:
        raise AssertionError("the crash was not simulated")
    _stream(spark, root, "e7").run_available_now()
    return read_table(spark, f"{root}/table")


class _Failing(TableWriter):
    """Every write fails half-way: some files are there, the batch is not.  As many batches fail
    as are tolerated; a large input has more."""

    broken = True

    def write(self, batch, tag):
        out = super().write(batch, tag)
        if self.broken and self.failures < self.max_failures:
            raise RuntimeError("simulated failure of a write")
        return out


def q_stream_quarantine_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each batch (the stage-1 files may fill several) fails whatever files it has, is noted in
    quarantine and leaves no files; replayed, the table is whole (T8)."""
    configure(spark)
    root = _fresh_root(spark, "e6q")
    _write_input(spark, sf_dir, "events", f"{root}/input")
    job = _stream(spark, root, "e6")
    job.writer = _Failing(job.profile, job.paths.table, job.paths.generation, quarantine_path=job.paths.quarantine, max_bad_files=1)
    job.run_available_now()
    job.writer.broken = False
    failed = min(job.writer.calls, job.writer.max_failures)
    tags = [job.writer.batch_tag(k) for k in range(failed)]
    if not failed or job.writer.failures != failed or job.writer.replay(spark) != tags or job.writer.replay(spark):
        raise AssertionError(f"{failed} quarantined batches were expected, {job.writer.failures} failed")
    return read_table(spark, f"{root}/table")


POISON_FILES = 50


def q_stream_poison_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of 50 stage-1 files in one batch one can't be read (a gzip stream cut short).  Its
    rows are missing, all others are loaded; the file is noted, mended and replayed.  The table
    is whole, and the counts say how often each step loaded rows."""
    configure(spark)
    root = _fresh_root(spark, "poison")
    job = _stream(spark, root, "e6")
    clean = stage1(device_messages(spark, sf_dir, "events"), job.profile)
    clean.select("value").repartition(POISON_FILES).write.option("compression", "gzip").text(f"{root}/clean")
    fs, folder = file_system(spark, f"{root}/clean")
    names = sorted(x.getPath().getName() for x in fs.listStatus(folder) if x.getPath().getName().startswith("part-"))
    copy = spark._jvm.org.apache.hadoop.fs.FileUtil.copy
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    hour = f"{job.paths.raw}/date=2024-01-01/hour=00"
    for k, name in enumerate(names):
        source, target = (file_system(spark, f"{folder}/{name}")[1] for folder in (f"{root}/clean", hour))
        if k != 17:
            copy(fs, source, fs, target, False, conf)
            continue
        out = fs.create(target, True)  # the first half of the file
        whole = fs.open(source)
        spark._jvm.org.apache.commons.io.IOUtils.copyLarge(whole, out, 0, fs.getFileStatus(source).getLen() // 2)
        whole.close()
        out.close()
    job.catch_up()
    loaded = job.recorder.second.total("rows")
    bad = [x.getPath().getName() for x in fs.listStatus(file_system(spark, job.paths.quarantine)[1])]
    lost = spark.read.text(f"{root}/clean/{names[17]}").count()
    every = spark.read.text(f"{root}/clean").count()  # as written: stage 1 isn't run again for it
    if len(names) != POISON_FILES or bad != [job.writer.batch_tag(0) + ".json"] or loaded != every - lost or not lost:
        raise AssertionError(f"{len(names)} files, {bad} in quarantine, {loaded} rows loaded, {lost} lost")
    mended = file_system(spark, f"{hour}/{names[17]}")[1]
    fs.delete(mended, False)
    copy(fs, file_system(spark, f"{root}/clean/{names[17]}")[1], fs, mended, False, conf)
    if len(job.writer.replay(spark)) != 1:
        raise AssertionError("one replay was expected")
    return read_table(spark, f"{root}/table")


def q_stream_null_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without an event type are registered in the null partition by their batch; only
    the first batch repairs the whole table."""
    configure(spark)
    root = _fresh_root(spark, "e5")
    name = "shoal_check_" + root.rsplit("-", 1)[-1]
    job = _stream(spark, root, "e5", table_name=name)
    cut = F.lit(SECOND_ARRIVAL).cast("timestamp_ntz")
    for arrived in (F.col("ts") < cut, F.col("ts") >= cut):
        _write_input(spark, sf_dir, "events", f"{root}/input", arrived)
        job.run_available_now()
    if job.writer.calls < 2 or job.writer.repairs != 1 or job.writer.repair_due:
        raise AssertionError(f"{job.writer.repairs} repairs in {job.writer.calls} batches")
    return spark.table(name).drop(BATCH_COLUMN)


DROP_BATCHES = 104


def q_stream_drop_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4: rows in, and why rows drop, summed over more than 100 batches of stage 1 (one file
    each); the job is stopped half-way, and another one, which knows nothing but the ledger,
    goes on."""
    configure(spark)
    root = _fresh_root(spark, "drops")
    device_messages(spark, sf_dir, "events").select("value").repartition(DROP_BATCHES).write.text(f"{root}/input")

    def run(trigger: dict, until: int | None) -> ProfileStream:
        job = _stream(spark, root, "e7")
        job.source = SourceOptions(format="text", path=f"{root}/input", max_files_per_trigger=1)
        spark.streams.addListener(job.recorder)
        try:  # stage 1 as it streams, without files: only the counts are asked for
            rows = stage1(read_stream(spark, job.source), job.profile, observe=job._name("stage1_rows"))
            q = rows.writeStream.format("noop").queryName(job._name("stage1")).trigger(**trigger) \
                .option("checkpointLocation", job.paths.checkpoint("counts")).start()
            if until is None:
                finished(q, None)
            while until is not None and q.isActive and job.recorder.batches() < until:
                time.sleep(0.1)
            q.stop()  # maybe within a batch, which then runs again
            job.recorder.add_all(q)
        finally:
            spark.streams.removeListener(job.recorder)
        return job

    half = run({"processingTime": "0 seconds"}, DROP_BATCHES // 2)
    if half.recorder.batches() >= DROP_BATCHES:
        raise AssertionError("the first run was meant to be stopped half-way")
    counts = run({"availableNow": True}, None).recorder.observed()
    return spark.createDataFrame(sorted(counts.items()), "outcome string, n long")


def q_stream_stop_and_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A live job is asked to stop after its first batches; it ends in good order, all that
    stage 1 had kept is in the table.  Another run goes on to the end."""
    configure(spark)
    root = _fresh_root(spark, "stop")
    _write_input(spark, sf_dir, "events", f"{root}/input")
    job = _stream(spark, root, "e6")
    job.source = SourceOptions(format="text", path=f"{root}/input", max_files_per_trigger=1)

    def ask() -> None:
        while job.recorder.batches() < 2:
            time.sleep(0.1)
        request_stop(spark, job.paths)

    asking = threading.Thread(target=ask, daemon=True)
    asking.start()
    job.run_forever(trigger_seconds=0, poll=0.2)
    asking.join()
    kept, table = job.recorder.observed()["kept"], job.recorder.second.total("rows")
    if job.recorder.lag or kept != table or spark.streams.active:
        raise AssertionError(f"stage 1 kept {kept} rows, stage 2 loaded {table}")
    again = _stream(spark, root, "e6")
    again.run_available_now()
    return read_table(spark, f"{root}/table")


def q_stream_seen_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """two runs of one checkpoint; the second arrival sends the first one's messages again,
    twice, beside its own.  Every event is in the table once."""
    configure(spark)
    root = _fresh_root(spark, "seen")
    cut = F.lit(SECOND_ARRIVAL).cast("timestamp_ntz")
    counts = []
    for arrived in ([F.col("ts") < cut], [F.col("ts") < cut, F.col("ts") < cut, F.col("ts") >= cut]):
        for part in arrived:
            _write_input(spark, sf_dir, "events", f"{root}/input", part)
        job = _stream(spark, root, "e6")
        job.profile = job.writer.profile = job.profile.with_options(seen_within="40 days")
        job.source = SourceOptions(format="text", path=f"{root}/input")
        job.run_available_now()
        counts.append(job.recorder.observed())
    first, both = counts
    if first["seen"] or both["seen"] != 2 * first["kept"] or both["late"] or job.recorder.lag:
        raise AssertionError(f"{first}, then {both}")
    return read_table(spark, f"{root}/table")


def q_stream_lag_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A job that starts eleven stage-1 batches behind ends at once with ``LagError``; after
    a catch-up nothing is behind and the table is whole."""
    configure(spark)
    root = _fresh_root(spark, "behind")
    device_messages(spark, sf_dir, "events").select("value").repartition(11).write.text(f"{root}/input")
    job = _stream(spark, root, "e6")
    job.source = SourceOptions(format="text", path=f"{root}/input", max_files_per_trigger=1)
    q = job.start_stage1({"availableNow": True})
    finished(q, None)
    job.recorder.add_all(q)
    new = _stream(spark, root, "e6")
    if new.recorder.lag != 11:
        raise AssertionError(f"{new.recorder.lag} batches behind")
    try:
        new.run_forever(trigger_seconds=1, catch_up=False)
        raise AssertionError("the job should not have started")
    except LagError:
        new.catch_up()
    if new.recorder.lag or spark.streams.active:
        raise AssertionError(f"{new.recorder.lag} batches behind after the catch-up")
    return read_table(spark, f"{root}/table")


def q_stream_clean_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A clean start reads another source from its beginning under checkpoints of its own;
    what the first generation wrote stays."""
    configure(spark)
    root = _fresh_root(spark, "clean")
    cut = F.lit(SECOND_ARRIVAL).cast("timestamp_ntz")
    for k, arrived in enumerate((F.col("ts") < cut, F.col("ts") >= cut)):
        _write_input(spark, sf_dir, "metrics", f"{root}/input{k}", arrived)
        paths = StreamPaths.open(spark, root, clean_start=k > 0)
        source = SourceOptions(format="text", path=f"{root}/input{k}")
        job = ProfileStream(spark, PROFILES["m7"], source, paths, layout=LAYOUT, files_per_hour=FILES_PER_HOUR)
        job.run_available_now()
        if paths.generation != k:
            raise AssertionError(f"generation {paths.generation}, {k} was expected")
    return read_table(spark, f"{root}/table")


def q_stream_repair_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6: the repair job registers the partitions of a table that no writer told the catalog of."""
    configure(spark)
    root = _fresh_root(spark, "job")
    name = "shoal_check_" + root.rsplit("-", 1)[-1]
    _write_input(spark, sf_dir, "metrics", f"{root}/input")
    job = _stream(spark, root, "m5")
    job.run_available_now()
    columns = read_table(spark, f"{root}/table", drop_batch=False).columns
    C.ensure_table(spark, name, f"{root}/table", columns, job.writer.partitions)
    if spark.table(name).count():
        raise AssertionError("no partition was expected yet")
    C.repair_tables(spark, f"{name}, ")
    return spark.table(name).drop(BATCH_COLUMN)


COMPACTED_BATCHES = 5


def q_stream_list_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The allow-list's file gets a new version between two arrivals, while the job and its
    writer live on; each arrival is filtered by the list that held when it was loaded."""
    configure(spark)
    root = _fresh_root(spark, "list")
    job = _stream(spark, root, "e5")
    job.writer.allow_list_path = f"{root}/lists"
    cut = F.lit(SECOND_ARRIVAL).cast("timestamp_ntz")
    for version, (names, arrived) in enumerate([("HOTKEY", F.col("ts") < cut), ("VOD-VIEW, SYSTEM-ERROR", F.col("ts") >= cut)]):
        write_text(spark, f"{root}/lists/v{version}.csv", names + "\nignored\n")
        _write_input(spark, sf_dir, "events", f"{root}/input", arrived)
        job.run_available_now()
    return read_table(spark, f"{root}/table")


def q_wide_payload_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads of a rare key, ``event_type`` and, in the second batch only, ``Hot``, with
    no column named beforehand: the registry makes columns of the last two."""
    configure(spark)
    root = _fresh_root(spark, "keys")
    events = read_source(spark, sf_dir, "events")
    n = F.col("event_id")
    late = n >= 300
    key = F.concat(F.lit("k"), (n % 7000).cast("string"))
    payload = F.concat(F.lit('{"'), key, F.lit('":"'), n.cast("string"), F.lit('","event_type":"'), F.col("event_type"),
                       F.when(late, F.concat(F.lit('","Hot":"h'), n.cast("string"))).otherwise(""), F.lit('"}'))
    body = F.concat(F.lit('{"metrics":'), payload, F.lit(',"thedate":"'), F.date_format("ts", "yyyy-MM-dd"), F.lit('"}'))
    registry = KeyRegistry(spark, f"{root}/keys", rest_column="others", min_share=0.01)
    writer = TableWriter(PROFILES["m7"].with_options(copies=()), f"{root}/table", registry=registry)
    for k, part in enumerate((~late, late, late & (n < 0))):
        writer(events.where(part).select(body.alias("value")), k)
    if sorted(registry.columns()) != ["event_type", "hot"]:
        raise AssertionError(f"columns {registry.columns()}")
    return read_table(spark, f"{root}/table")


class _RenameFails(Compactor):
    """The first directory can't be put in its place; ``halt``: the run ends right after a later
    one stands, before the catalog and the old files are dealt with."""

    renames = 0

    def rename(self, source, target):
        if BATCH_COLUMN in target:
            self.renames += 1
            if self.renames == 1:
                raise OSError("simulated failure of a rename")
        super().rename(source, target)

    def _finish(self, journal):
        raise InterruptedError("simulated end of the run")


def q_stream_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files of several batches are compacted.  A first run can't rename one directory and ends
    half-way through another; nothing is lost or read twice then, nor after a second run."""
    configure(spark)
    root = _fresh_root(spark, "compact")
    name = "shoal_check_" + root.rsplit("-", 1)[-1]
    job = _stream(spark, root, "e5", table_name=name)
    job.profile = job.writer.profile = job.profile.with_options(partitions=("event_type",))
    for k in range(COMPACTED_BATCHES):
        _write_input(spark, sf_dir, "events", f"{root}/input", F.floor(F.col("event_id") / 10) % COMPACTED_BATCHES == k)
        job.run_available_now()
    p, table = job.profile, f"{root}/table"

    def rows() -> tuple[int, int]:
        df = settled(spark, p, table)
        return df.count(), df.select(F.sum(F.xxhash64(*sorted(df.columns)).cast("decimal(38,0)"))).first()[0]

    before, files = rows(), Compactor(spark, p, table).files().count()
    # a file of every batch fits into the target, however large the table is
    largest = Compactor(spark, p, table).files().agg(F.max("length")).first()[0]
    target = max(1 << 20, COMPACTED_BATCHES * largest)
    broken = _RenameFails(spark, p, table, name, target=target, min_files=2)
    try:
        broken.run()
    except InterruptedError:
        pass
    if rows() != before or broken.renames < 2 or len(broken.open_journals()) != 1:
        raise AssertionError(f"after a broken run {rows()}, before {before}")
    done = Compactor(spark, p, table, name, target=target, min_files=2)
    switched = done.run()
    fewer = done.files().count()
    if rows() != before or not switched or done.open_journals() or fewer * 2 > files:
        raise AssertionError(f"{switched} switched, {files} files, then {fewer}; {rows()}, before {before}")
    spark.catalog.refreshTable(name)
    return spark.table(name).drop(BATCH_COLUMN)


def typed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics whose values have types: a whole number, money, a mix of both, of numbers and
    text, of numbers and doubles, a truth value, an object, and one that is always null."""
    events = read_source(spark, sf_dir, "events")
    n, money = F.col("event_id"), F.col("value").cast("decimal(12,2)")
    pick = lambda k, a, b: F.when(n % k == 0, a.cast("variant")).otherwise(b.cast("variant"))
    payload = F.struct(
        n.alias("Whole"), money.alias("money"), pick(2, n, money).alias("mixed"), pick(3, n, F.col("event_type")).alias("text"),
        pick(4, (n + 1).cast("double") * 1e200, n).alias("wide"), (n % 2 == 0).alias("truth"), F.struct(n.alias("b")).alias("obj"),
        F.lit(None).cast("string").alias("nothing"))
    body = F.to_json(F.struct(payload.alias("metrics"), F.date_format("ts", "yyyy-MM-dd").alias("thedate")), {"ignoreNullFields": "false"})
    return events.select("ts", body.alias("value"))


def q_typed_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A text table read back in inferred types.  The rows come in two batches, the first
    with whole numbers only in ``mixed`` and ``text``; the types must be those of one batch."""
    configure(spark)
    root = _fresh_root(spark, "typed")
    p, rows = PROFILES["m7"], typed_messages(spark, sf_dir)
    ledger = Ledger(spark, f"{root}/types", TY.merge)
    writer = TableWriter(p, f"{root}/table", types=ledger)
    whole = F.get_json_object("value", "$.metrics.Whole").cast("long") % 12 == 0
    for k, part in enumerate((whole, ~whole)):
        writer(rows.where(part).select("value"), k)
    one = TY.flatten(R.prepare(rows.select("value"), p), p)[1]
    if one != TY.types(ledger.read()):
        raise AssertionError(f"one batch: {one}, two: {TY.types(ledger.read())}")
    kinds = ",".join(f"{n}:{t}" for n, t in sorted(one.items()))
    return read_typed_table(spark, f"{root}/table", p, ledger).drop("mac").withColumn("kinds", F.lit(kinds))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "stream_two_stage": q_stream_two_stage,
    "stream_catch_up": q_stream_catch_up,
    "stream_repair_table": q_stream_repair_table,
    "stream_restart": q_stream_restart,
    "stream_schema_evolution": q_stream_schema_evolution,
    "stream_quarantine_replay": q_stream_quarantine_replay,
    "stream_null_partition": q_stream_null_partition,
    "stream_drop_counts": q_stream_drop_counts,
    "stream_poison_file": q_stream_poison_file,
    "stream_stop_and_resume": q_stream_stop_and_resume,
    "stream_lag_guard": q_stream_lag_guard,
    "stream_clean_start": q_stream_clean_start,
    "stream_repair_job": q_stream_repair_job,
    "stream_list_change": q_stream_list_change,
    "wide_payload_registry": q_wide_payload_registry,
    "stream_compacted": q_stream_compacted,
    "stream_seen_events": q_stream_seen_events,
    "typed_payload": q_typed_payload,
}

_SAME_AS = {"stream_two_stage": "profile_e6", "stream_catch_up": "profile_m7",
            "stream_repair_table": "profile_m5", "stream_restart": "profile_e7",
            "stream_quarantine_replay": "profile_e6", "stream_null_partition": "profile_e5",
            "stream_poison_file": "profile_e6", "stream_stop_and_resume": "profile_e6", "stream_seen_events": "profile_e6", "stream_compacted": "profile_e5",
            "stream_lag_guard": "profile_e6", "stream_clean_start": "profile_m7", "stream_repair_job": "profile_m5"}


def oracles() -> dict[str, str]:
    base = DQ.oracles()
    out = {name: base[profile] for name, profile in _SAME_AS.items()}
    # before the second arrival the devices sent no viewing_duration
    out["stream_schema_evolution"] = DQ.profile_sql_with(
        "e7", {"viewing_duration": f"CASE WHEN ts >= TIMESTAMP '{SECOND_ARRIVAL}' THEN {{}} END"})
    early = f"ts < TIMESTAMP '{SECOND_ARRIVAL}'"
    out["stream_list_change"] = DQ.profile_sql_where(
        "e5", f"(CASE WHEN {early} THEN event_type_out = 'HOTKEY' ELSE event_type_out IN ('VOD-VIEW', 'SYSTEM-ERROR') END)")
    out["wide_payload_registry"] = """SELECT event_type, CASE WHEN event_id >= 300 THEN 'h' || event_id END AS hot,
        '{"k' || (event_id % 7000) || '":"' || event_id || '"}' AS others, strftime(ts, '%Y-%m-%d') AS thedate FROM events"""
    out["typed_payload"] = """SELECT event_id AS whole, CAST(m AS DECIMAL(38,2)) AS money,
        CAST(CASE WHEN event_id % 2 = 0 THEN event_id ELSE m END AS DECIMAL(38,2)) AS mixed,
        CASE WHEN event_id % 3 = 0 THEN CAST(event_id AS VARCHAR) ELSE event_type END AS text,
        CASE WHEN event_id % 4 = 0 THEN (event_id + 1)::DOUBLE * 1e200 ELSE event_id::DOUBLE END AS wide, event_id % 2 = 0 AS truth,
        '{"b":' || event_id || '}' AS obj, CAST(NULL AS VARCHAR) AS nothing, strftime(ts, '%Y-%m-%d') AS thedate,
        'mixed:decimal(38,2),money:decimal(38,2),nothing:string,obj:string,text:string,truth:boolean,whole:bigint,wide:double' AS kinds
        FROM (SELECT *, CAST(value AS DECIMAL(12,2)) AS m FROM events)"""
    counted = {"rows_in": "true", "kept": "c IN (2, 6, 7, 8)", "malformed": "c = 5", "no_device": "c = 0",
               "bad_time": "c IN (1, 3, 4)", "missing_key": "c = 9"}
    out["stream_drop_counts"] = " UNION ALL ".join(
        f"SELECT '{k}' AS outcome, count(*) FILTER (WHERE {w}) AS n FROM (SELECT event_id % 10 AS c FROM events)" for k, w in counted.items())
    return out
