"""Benchmark decontamination: a broadcast table of normalised test n-grams, a scan of the
training windows, verified hits, and removal of spans or documents.

The benchmark's distinct windows are broadcast in blocks of a checked size
(``block_windows``); one block is the usual case.  A benchmark beyond it costs one more
pass over the documents per block, never a larger broadcast.

Cases: a null or empty text (or one without words) has no words, no hits and isn't
contaminated; items without words match nothing; repeated documents and repeated items
are each judged like single ones; items are counted by distinct ``item_id`` (a null id
removes words but is not counted or listed); empty tables give empty results or no
hits; further columns of either table are kept out of the way (documents keep theirs).
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoal.llm import common as C

SPAN = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
STATE = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("spans", T.ArrayType(SPAN)),
                      T.StructField("items", T.ArrayType(T.StringType()))])
ARROW_STATE = pa.struct([("n_words", pa.int64()),
                         ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                         ("items", pa.list_(pa.string()))])
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")  # before lower-casing


def benchmark_windows(benchmark: DataFrame, n: int, id_col: str, text_col: str) -> DataFrame:
    """(window, item): every n consecutive words of an item, space-joined; an item of
    fewer words, but not none, is one window."""

    def cut(batches):
        for b in batches:
            w, k = [], []
            for item, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                words = C.alnum_words(text)
                for i in range(max(1, len(words) - n + 1) if words else 0):
                    w.append(b" ".join(words[i:i + n]))
                    k.append(item)
            yield pa.RecordBatch.from_arrays([pa.array(w, pa.binary()), pa.array(k, pa.string())], ["window", "item"])

    rows = benchmark.select(F.col(id_col).cast("string").alias("item"), C.text_bytes(text_col).alias("text"))
    return C.map_batches(rows, cut, "window binary, item string").distinct()


class Index:
    """One block of windows: word ids, a bit table over window hashes and the exact windows."""

    BITS = 22

    def __init__(self, rows: list[tuple[bytes, list[str]]]):
        self.ids: dict[bytes, int] = {}
        self.items: dict[tuple[int, ...], list[str]] = {}
        for window, items in rows:
            key = tuple(self.ids.setdefault(w, len(self.ids) + 1) for w in window.split())
            self.items[key] = items
        self.table: dict[int, np.ndarray] = {}
        for length in sorted({len(k) for k in self.items}):
            keys = np.array([k for k in self.items if len(k) == length], np.uint64)
            bits = np.zeros(1 << self.BITS, bool)
            bits[self.hashes(keys.T, keys.shape[0])] = True
            self.table[length] = bits

    def hashes(self, cols, m: int) -> np.ndarray:
        h = np.zeros(m, np.uint64)
        for j, c in enumerate(cols):
            h += c * C._ODD[j]
        return (C.mix(h) >> np.uint64(64 - self.BITS)).astype(np.int64)

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Merged [start, end) spans of the words inside windows, and the items met."""
        get = self.ids.get
        ids = np.array([get(w, 0) for w in words], np.uint64)
        found: list[tuple[int, int]] = []
        items: set[str] = set()
        known = np.concatenate([[0], np.cumsum(ids > 0)])
        for length, bits in self.table.items():
            m = len(ids) - length + 1
            if m <= 0:
                continue
            full = np.flatnonzero(known[length:] - known[:-length] == length)
            if not len(full):
                continue
            for i in full[bits[self.hashes((ids[full + j] for j in range(length)), len(full))]].tolist():
                hit = self.items.get(tuple(ids[i:i + length].tolist()))
                if hit is not None:
                    found.append((i, i + length))
                    items.update(hit)
        return merge(found), items


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [tuple(x) for x in out]


def find_hits(docs: DataFrame, benchmark: DataFrame, n: int = 13, text_col: str = "text",
              item_col: str = "item_id", item_text_col: str = "text", block_windows: int = 400_000,
              state: str = "decontam") -> DataFrame:
    """``docs`` with the column ``state``: struct(n_words, spans of hit words, items met)."""
    sc = docs.sparkSession.sparkContext
    windows = benchmark_windows(benchmark, n, item_col, item_text_col)
    blocks = max(1, -(-windows.count() // block_windows))
    (raw,) = C.fresh(docs, "raw_text")
    schema = T.StructType([*docs.schema.fields, T.StructField(state, STATE)])
    scratch = C.Scratch(docs.sparkSession, "decontam")
    out = docs
    for block in range(blocks):
        part = windows.where(F.pmod(F.xxhash64("window"), F.lit(blocks)) == block) if blocks > 1 else windows
        cast = sc.broadcast([(bytes(r[0]), r[1]) for r in part.groupBy("window").agg(F.collect_set("item")).collect()])

        def scan(batches, cast=cast, first=block == 0):
            index = Index(cast.value)
            for b in batches:
                keep = b.num_columns - (1 if first else 2)
                texts = b.column(b.num_columns - 1).to_pylist()
                old = [None] * len(texts) if first else b.column(keep).to_pylist()
                made = []
                for text, was in zip(texts, old, strict=True):
                    words = C.alnum_words(text)
                    spans, items = index.scan(words) if words and index.items else ([], set())
                    if was:
                        spans = merge(spans + [(s["start"], s["end"]) for s in was["spans"]])
                        items |= set(was["items"])
                    made.append({"n_words": len(words), "spans": [{"start": s, "end": e} for s, e in spans],
                                 "items": sorted(i for i in items if i is not None)})
                yield pa.RecordBatch.from_arrays([*b.columns[:keep], pa.array(made, ARROW_STATE)],
                                                 [*b.schema.names[:keep], state])

        out = C.map_batches(out.withColumn(raw, C.text_bytes(text_col)), scan, schema)
        if blocks > 1:
            out = scratch.table(out, f"pass-{block}")
            if block:
                scratch.drop(f"pass-{block - 1}")
    return out


def n_hit(state: str = "decontam"):
    """Number of hit words of a state column."""
    return F.aggregate(F.col(state)["spans"], F.lit(0).cast("long"), lambda a, x: a + (x["end"] - x["start"]).cast("long"))


def contaminated(state: str = "decontam", share: tuple[int, int] = (1, 20)):
    num, den = share
    return (n_hit(state) > 0) & (n_hit(state) * den >= F.col(state)["n_words"] * num)


def decontaminate(docs: DataFrame, benchmark: DataFrame, mode: str = "documents", text_col: str = "text",
                  max_hit_share: tuple[int, int] = (1, 20), **how) -> DataFrame:
    """The documents after removal, with their own columns.

    ``mode="documents"`` drops documents whose hit words are at least ``max_hit_share``
    of their words (and at least one); ``mode="spans"`` keeps every document and cuts
    the hit words out of its text (what stands between two spans stays)."""
    (state,) = C.fresh(docs, "decontam")
    found = find_hits(docs, benchmark, text_col=text_col, state=state, **how)
    if mode == "documents":
        return found.where(~contaminated(state, max_hit_share)).drop(state)
    if mode != "spans":
        raise ValueError(f"mode is 'documents' or 'spans', not {mode!r}")
    cuts = F.transform(F.col(state)["spans"], lambda x: F.array(x["start"], x["end"]))
    cut = F.when(F.size(cuts) > 0, cut_words(F.col(text_col), cuts)).otherwise(F.col(text_col))
    return found.withColumn(text_col, cut).select(*docs.columns)


@F.pandas_udf(T.StringType())
def cut_words(texts: pd.Series, cuts: pd.Series) -> pd.Series:
    def one(text, spans):
        if text is None or spans is None or not len(spans):
            return text
        raw = text.encode()
        at = [m.span() for m in WORD.finditer(raw)]
        out, last = [], 0
        for start, end in spans:
            out.append(raw[last:at[start][0]])
            last = at[end - 1][1]
        return b"".join([*out, raw[last:]]).decode()

    return pd.Series([one(t, s) for t, s in zip(texts, cuts, strict=True)], dtype=object)
