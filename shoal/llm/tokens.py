"""Token files: flat unsigned integers plus 64-bit document offsets, memory-mapped.

Documents are dealt by ranges of their id, so files in order hold the documents in order.
Every task writes two files of its own, ``<part>.ids`` (little-endian unsigned 16- or
32-bit integers, whichever the vocabulary fits) and ``<part>.off`` (n + 1 unsigned 64-bit
offsets in ids, from 0), and returns one manifest row.  Prefix sums of the manifest's
counts are the parts' bases: document k of a part starts at base + off[k].  A part's files
carry the task attempt in their names and only attempts named in the manifest count, so a
lost executor or a second attempt leaves no half-written or doubled part.

Cases: a null text is the empty text and has the end id alone; null ids come first; rows
repeated or tied on the id are all written, ordered by their text; an empty table gives an
empty manifest; further columns are not read.
"""

from __future__ import annotations

import re
import zlib
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shoal.llm import common as C

CACHE = 600_000  # chunks and runs a task remembers


_ENCODERS: dict[int, WordEncoder] = {}


class WordEncoder:
    """Ids of a text by the tokenizers library, one white-space chunk at a time.

    The tokenizer drops white space before it splits, and neither its normaliser nor its
    splitting looks across it, so a text's ids are its chunks' ids in order.  A chunk of
    plain letters and then plain marks is split once more, at the border where the
    tokenizer splits it anyway.  Chunks and runs already seen are looked up; every other
    string goes through the library: plain runs, which its normaliser only lower-cases,
    through its BPE model, all else through the whole of it.  A worker keeps its encoder
    from task to task."""

    PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?#$%&*|]*)")

    def __init__(self, model: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(model)
        self.wide = self.library.get_vocab_size() > 1 << 16
        self.kind = "<u4" if self.wide else "<u2"
        self.runs: dict[str, bytes] = {"": b""}
        self.chunks: dict[bytes, bytes] = {}
        # the byte-level alphabet: printable bytes stand for themselves, the others for 256 and on
        own = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [c for c in range(256) if c not in set(own)]
        self.alphabet = {c: c for c in own} | {c: 256 + k for k, c in enumerate(rest)}

    @classmethod
    def of(cls, model: str) -> WordEncoder:
        key = hash(model)
        if key not in _ENCODERS:
            _ENCODERS.clear()
            _ENCODERS[key] = cls(model)
        return _ENCODERS[key]

    def ids(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def run(self, text: str) -> bytes:
        got = self.runs.get(text)
        if got is None:
            if len(self.runs) >= CACHE:
                self.runs = {"": b""}
            units = text.encode().decode("latin-1").translate(self.alphabet)
            got = self.runs[text] = np.array([t.id for t in self.library.model.tokenize(units)], self.kind).tobytes()
        return got

    def chunk(self, raw: bytes) -> bytes:
        text = raw.decode("utf-8", "replace")
        plain = self.PLAIN.fullmatch(text)
        got = self.run(plain[1].lower()) + self.run(plain[2]) if plain else self.ids(text)
        if len(self.chunks) >= CACHE:
            self.chunks.clear()
        self.chunks[raw] = got
        return got

    def __call__(self, raw: bytes) -> bytes:
        get, make = self.chunks.get, self.chunk
        return b"".join([get(w) or make(w) for w in raw.split()])


def _fs(uri: str):
    """(file system, path) of a folder: a local or shared path, file:, hdfs:, s3: ..."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), urlparse(uri).path
    if "://" in uri:
        return pafs.FileSystem.from_uri(uri)
    return pafs.LocalFileSystem(), uri


def write(docs: DataFrame, folder: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the token files of ``docs`` under ``folder``; returns the manifest
    (part, name, bits, n_docs, n_ids), written beside them as Parquet."""

    with open(tokenizer, encoding="utf-8") as f:  # a vocabulary file of fixed size
        model = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches):
        ctx = TaskContext.get()
        part = ctx.partitionId()
        name = f"{part:06d}-{ctx.taskAttemptId()}"
        fs, path = _fs(folder)
        fs.create_dir(path, recursive=True)
        enc = WordEncoder.of(model.value)
        end = np.array([end_id], enc.kind).tobytes()
        width, lengths, keys = len(end), [], []
        with fs.open_output_stream(f"{path}/{name}.ids") as out:
            for b in batches:
                for raw in b.column(1).to_pylist():
                    x = enc(raw) + end
                    out.write(x)
                    lengths.append(len(x) // width)
                keys.append(b.column(0))
        off = np.zeros(len(lengths) + 1, "<u8")
        np.cumsum(np.array(lengths, "<u8"), out=off[1:])
        if not len(lengths):
            return
        with fs.open_output_stream(f"{path}/{name}.off") as out:
            out.write(off.tobytes())
        with fs.open_output_stream(f"{path}/{name}.key") as out, pa.ipc.new_file(out, pa.schema([("key", keys[0].type)])) as w:
            for k in keys:
                w.write_batch(pa.record_batch([k], names=["key"]))
        yield pa.RecordBatch.from_pylist([{"part": part, "name": name, "bits": width * 8, "n_docs": len(lengths), "n_ids": int(off[-1])}],
                                         pa.schema([("part", pa.int32()), ("name", pa.string()), ("bits", pa.int32()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]))

    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("key"), C.text_bytes(text_col).alias("text"))
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    sorted_rows = rows.repartitionByRange(n, F.col("key")).sortWithinPartitions("key", "text")
    C.map_batches(sorted_rows, run, "part int, name string, bits int, n_docs long, n_ids long") \
        .write.mode("overwrite").parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest")


def bases(manifest: DataFrame) -> DataFrame:
    """The manifest with each part's first document and first id: prefix sums over one
    row a file, never over documents."""
    w = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.select("*", F.coalesce(F.sum("n_ids").over(w), F.lit(0)).alias("base"),
                           F.coalesce(F.sum("n_docs").over(w), F.lit(0)).alias("base_doc"))


class Part:
    """One part's files, mapped into memory (a remote store's are read)."""

    def __init__(self, folder: str, name: str, bits: int):
        fs, path = _fs(folder)
        if isinstance(fs, pafs.LocalFileSystem):
            self.ids = np.memmap(f"{path}/{name}.ids", f"<u{bits // 8}", "r")
            self.off = np.memmap(f"{path}/{name}.off", "<u8", "r")
        else:
            read = lambda end: fs.open_input_file(f"{path}/{name}.{end}").read()
            self.ids = np.frombuffer(read("ids"), f"<u{bits // 8}")
            self.off = np.frombuffer(read("off"), "<u8")
        with fs.open_input_file(f"{path}/{name}.key") as f:
            self.keys = pa.ipc.open_file(f).read_all().column("key")

    def __len__(self) -> int:
        return len(self.off) - 1

    def doc(self, k: int) -> np.ndarray:
        return self.ids[int(self.off[k]):int(self.off[k + 1])]


def read(spark: SparkSession, manifest: DataFrame, folder: str, id_type: str, id_col: str = "doc_id") -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of every document, read back from the files."""

    def run(batches):
        for b in batches:
            for m in b.to_pylist():
                part = Part(folder, m["name"], m["bits"])
                step = 10_000
                for lo in range(0, len(part), step):
                    hi = min(lo + step, len(part))
                    off = part.off[lo:hi + 1].astype(np.int64)
                    crc = [zlib.crc32(np.ascontiguousarray(part.doc(k), "<u4")) for k in range(lo, hi)]
                    keys = part.keys.slice(lo, hi - lo).combine_chunks()
                    yield pa.RecordBatch.from_arrays([keys, pa.array(off[:-1] + m["base"]), pa.array(np.diff(off)), pa.array(crc, pa.int64())],
                                                     [id_col, "start", "n_tokens", "ids_crc32"])

    rows = bases(manifest).repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))), "part")
    return rows.mapInArrow(run, f"{id_col} {id_type}, start long, n_tokens long, ids_crc32 long")


def documents(spark: SparkSession, manifest: DataFrame, folder: str, id_type: str, id_col: str = "doc_id") -> DataFrame:
    """(id, ids): the stored documents themselves."""

    def run(batches):
        for b in batches:
            for m in b.to_pylist():
                part = Part(folder, m["name"], m["bits"])
                for lo in range(0, len(part), 1000):
                    hi = min(lo + 1000, len(part))
                    off = part.off[lo:hi + 1].astype(np.int64)
                    flat = np.ascontiguousarray(part.ids[off[0]:off[-1]], np.int64)
                    ids = pa.LargeListArray.from_arrays(off - off[0], flat).cast(pa.list_(pa.int64()))
                    yield pa.RecordBatch.from_arrays([part.keys.slice(lo, hi - lo).combine_chunks(), ids], [id_col, "ids"])

    return manifest.repartition(max(spark.sparkContext.defaultParallelism, 1), "part").mapInArrow(run, f"{id_col} {id_type}, ids array<long>")
