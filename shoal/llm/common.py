"""Helpers shared by the operators: scratch tables, Arrow columns, words, components."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from xxhash import xxh3_64_intdigest

from shoal.session import scratch_root

BATCH_ROWS = 1000  # rows of an Arrow batch that carries texts (a batch is one task's unit of memory)


class Scratch:
    """Intermediate tables of one call, in the shared folder of ``spark.checkpoint.dir``.

    ``table`` cuts the lineage: the rows are written once and read back, so a lost
    executor costs only the tasks that read them.  ``drop`` deletes a table that no
    later plan reads."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{scratch_root(spark)}/shoal-{name}-{uuid.uuid4().hex[:12]}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def table(self, df: DataFrame, name: str, mode: str = "overwrite") -> DataFrame:
        df.write.mode(mode).parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        jvm = self.spark._jvm
        conf = self.spark._jsparkSession.sessionState().newHadoopConf()
        for name in names:
            p = jvm.org.apache.hadoop.fs.Path(self.path(name))
            p.getFileSystem(conf).delete(p, True)


def free_shuffles(spark: SparkSession) -> None:
    """Let go of the shuffle files of finished jobs: they are deleted once the driver's JVM has
    collected the plans that wrote them, which on a quiet driver may be long after."""
    gc.collect()
    spark._jvm.System.gc()


_HELD: dict = {}


def hold(version) -> dict:
    """What a worker remembers from task to task for ``version``; what it held for another is let
    go, so the words of one operator don't stay while the next one runs."""
    if _HELD.get("version") != version:
        _HELD.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()
        _HELD["version"] = version
    return _HELD


def map_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str, version=None) -> DataFrame:
    """``mapInArrow`` in batches small enough for very long texts.  ``version``: of what ``fn``
    remembers in :func:`hold`; without one a worker starts with no memories."""
    conf = df.sparkSession.conf
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(conf.get(key)) > BATCH_ROWS:
        conf.set(key, str(BATCH_ROWS))

    def run(batches):
        hold(version)
        yield from fn(batches)

    return df.mapInArrow(run, schema)


def text_bytes(col: str = "text"):
    """A text column as UTF-8 bytes; null is the empty text."""
    return F.coalesce(F.col(col).cast("binary"), F.lit(b""))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that ``df`` (in any case) doesn't have."""
    taken, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in taken:
            n = "_" + n
        taken.add(n.lower())
        out.append(n)
    return out


_LOWER = bytes(c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))
# word bytes of [^\x00-\x2F\x3A-\x60\x7B-\x7F] after lower-casing A-Z; the rest become spaces
_ALNUM = bytes(
    (c + 32 if 0x41 <= c <= 0x5A else c)
    if 0x30 <= c <= 0x39 or 0x41 <= c <= 0x5A or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20
    for c in range(256)
)


def alnum_words(b: bytes) -> list[bytes]:
    """Lower-cased words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a UTF-8 text."""
    return b.translate(_ALNUM).split()


def space_words(b: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a UTF-8 text."""
    return b.split()


def lower_words(b: bytes) -> list[bytes]:
    return b.translate(_LOWER).split()


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(words: list[bytes]) -> np.ndarray:
    """A 64-bit hash of each word."""
    return np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))


_ODD = mix(np.arange(1, 65, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def window_hashes(ids: np.ndarray, n: int) -> np.ndarray:
    """64-bit hash of every ``n`` consecutive word hashes (all of them if there are fewer)."""
    if not len(ids):
        return np.empty(0, np.uint64)
    n = min(n, len(ids))
    m = len(ids) - n + 1
    out = np.full(m, np.uint64(n), np.uint64)
    for j in range(n):  # the ids are mixed well already
        out += ids[j:j + m] * _ODD[j]
    return mix(out)


def components(spark: SparkSession, edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of ``edges`` (a, b).

    Alternating large-star and small-star steps: each joins every node with the
    smallest of its neighbours, so the rounds grow with the logarithm of the longest
    chain.  Minima are pre-aggregated and a node with very many neighbours is split by
    the adaptive skew join; nothing is collected but one row count a round."""

    def star(e: DataFrame, large: bool) -> DataFrame:
        if large:
            both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        else:
            both = e  # a > b already
        low = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), F.least("a", "m").alias("m"))
        out = both.join(low, both["a"] == low["k"]).select("a", "b", "m")
        pairs = out.where("b > a" if large else "b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        if not large:
            pairs = pairs.union(low.select(F.col("k").alias("a"), F.col("m").alias("b")))
        return pairs.where("a <> b").distinct()

    e = edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    e, before, k = scratch.table(e, f"{name}-0"), None, 0
    while True:
        k += 1
        e = scratch.table(star(star(e, True), False), f"{name}-{k}")
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        scratch.drop(f"{name}-{k - 1}")
        if now == before:
            break
        before = now
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        e.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
