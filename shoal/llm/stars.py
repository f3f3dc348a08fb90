"""Comparing pairs of texts, where the pairs form stars around few centers.

A pair (a, b) needs both texts.  Texts that no pair names are dropped before the shuffle
by a bit table of fixed size (the ids' hashes; a false hit only ships a text in vain).
Pairs are grouped by center, split into groups of bounded size, so a center that a third
of all texts point to is compared by many tasks, each holding one text at a time."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoal.llm import common as C

BITS = 26  # the bit table: 8 MB at any size
GROUP = 256  # members compared with a center in one group, on average


def slot(col):
    return F.pmod(F.xxhash64(col), F.lit(1 << BITS)) + 1


def bit_table(ids: DataFrame, x=None) -> np.ndarray:
    """Bits of the hashed ``node`` column, or of slots ``x``, as bytes (bit k of byte k // 8)."""
    x = slot("node") if x is None else x
    rows = ids.select(F.bitmap_bucket_number(x).alias("bucket"), F.bitmap_bit_position(x).alias("bit")) \
        .groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits")).collect()  # at most 2048 rows of 4 KB
    out = np.zeros(1 << (BITS - 3), np.uint8)
    for bucket, bits in rows:
        out[(bucket - 1) * 4096:bucket * 4096] = np.frombuffer(bytes(bits), np.uint8)
    return out


def named_texts(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``texts`` (node, text) whose node may be in ``ids`` (node)."""
    table = texts.sparkSession.sparkContext.broadcast(bit_table(ids))

    def keep(batches):
        bits = table.value
        for b in batches:
            at = b.column(2).to_numpy(zero_copy_only=False).astype(np.int64) - 1
            hit = (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1
            yield b.select([0, 1]).filter(pa.array(hit.astype(bool)))

    return C.map_batches(texts.select("node", "text", slot("node").alias("x")), keep, texts.select("node", "text").schema)


def compare(pairs: DataFrame, texts: DataFrame, fn: Callable, extra: list[str], schema: str) -> DataFrame:
    """``fn(center texts, [(b, text, extra...), ...])`` rows for every center a of ``pairs``
    (a, b, ``extra``); called for a few members at a time.  ``texts``: (node, text as bytes);
    a node with several texts is compared with each.  Output: ``schema``, as tuples after a."""
    few = named_texts(texts, pairs.select(F.col("a").alias("node")).union(pairs.select("b")))
    size = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("n")).select(
        F.col("a").alias("ca"), F.ceil(F.col("n") / GROUP).cast("int").alias("groups"))
    dealt = pairs.join(size, F.col("a") == F.col("ca")).select("a", "b", *extra, F.pmod(F.xxhash64("b"), "groups").cast("int").alias("salt"))
    members = dealt.join(few, F.col("b") == F.col("node")).select("a", "salt", "b", "text", *extra)
    no = [F.lit(None).cast(dealt.schema[c].dataType).alias(c) for c in extra]
    centers = size.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("groups") - 1))) \
        .join(few, F.col("ca") == F.col("node")).select(F.col("ca").alias("a"), "salt", F.lit(None).cast("long").alias("b"), "text", *no)
    n = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = centers.unionByName(members).repartition(n, "a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())
    out_schema = _arrow(schema)

    def run(batches):
        at, center = None, []
        for batch in batches:
            a, salt, b, text, *more = (c.to_pylist() for c in batch.columns)
            out, todo = [], []
            for k in range(len(a)):
                if (a[k], salt[k]) != at:
                    out += [(at[0], *r) for r in fn(center, todo)] if todo else []
                    at, center, todo = (a[k], salt[k]), [], []
                if b[k] is None:
                    center.append(text[k])
                else:
                    todo.append((b[k], text[k], *(m[k] for m in more)))
            out += [(at[0], *r) for r in fn(center, todo)] if todo else []
            cols = list(zip(*out, strict=True)) if out else [()] * len(out_schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, out_schema, strict=True)], schema=out_schema)

    return C.map_batches(rows, run, schema)


def _arrow(schema: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}
    return pa.schema([(n, kinds[k]) for n, k in (f.split() for f in schema.split(", "))])
