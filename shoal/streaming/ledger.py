"""A small durable table of what batches report: progress (K4) and payload types.

One entry a batch, a JSON-lines file named by its key; writing a key again replaces its
entry, so a batch that is replayed counts once.  Entries are written under another name and
renamed, so a reader sees whole ones only.  When ``roll_after`` entries have gathered, the
older half is merged into one file; readers skip entries that a roll already holds, so a
crash between the roll and the removal of its entries neither loses nor doubles any.

An entry's rows are few by nature (a query's counters, a batch's column names); all reading
is of ``roll_after`` small files at most.
"""

from __future__ import annotations

import json
import threading
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

ROLL_AFTER = 200
Rows = list[dict]


def file_system(spark: SparkSession, path: str):
    """(Hadoop file system, Path) of a path."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), p


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """The file ``path`` with ``text``, whole or not at all."""
    fs, target = file_system(spark, path)
    tmp = file_system(spark, f"{path}.{uuid.uuid4().hex[:8]}.tmp")[1]
    out = fs.create(tmp, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if not fs.rename(tmp, target):  # a rename doesn't replace
        fs.delete(target, False)
        if not fs.rename(tmp, target):
            raise OSError(f"cannot write {path}")


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = file_system(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


@dataclass
class Ledger:
    """``combine`` merges the rows of several entries into those that mean the same."""

    spark: SparkSession
    path: str
    combine: Callable[[Iterable[Rows]], Rows]
    roll_after: int = ROLL_AFTER
    _lock: threading.Lock = field(default_factory=threading.Lock, repr=False)

    def _names(self) -> tuple[list[str], str | None]:
        """(keys of the entries no roll holds, name of the newest roll)."""
        fs, p = file_system(self.spark, self.path)
        if not fs.exists(p):
            return [], None
        names = [s.getPath().getName() for s in fs.listStatus(p)]
        rolls = sorted(n for n in names if n.startswith("roll-") and n.endswith(".json"))
        held = rolls[-1][5:-5] if rolls else ""
        keys = sorted(n[6:-5] for n in names if n.startswith("entry-") and n.endswith(".json"))
        return [k for k in keys if k > held], rolls[-1] if rolls else None

    def _load(self, name: str) -> Rows:
        return [json.loads(line) for line in read_text(self.spark, f"{self.path}/{name}").splitlines() if line]

    def _write(self, name: str, rows: Rows) -> None:
        write_text(self.spark, f"{self.path}/{name}", "\n".join(json.dumps(r, sort_keys=True) for r in rows))

    def put(self, key: str, rows: Rows) -> None:
        """The entry ``key`` is these rows.  Keys grow (a batch's number, padded)."""
        with self._lock:
            self._write(f"entry-{key}.json", rows)
            keys, roll = self._names()
            if len(keys) > self.roll_after:
                self._roll(keys[:len(keys) // 2], roll)

    def _roll(self, keys: list[str], old: str | None) -> None:
        parts = ([self._load(old)] if old else []) + [self._load(f"entry-{k}.json") for k in keys]
        self._write(f"roll-{keys[-1]}.json", self.combine(parts))
        fs, _ = file_system(self.spark, self.path)
        for name in [f"entry-{k}.json" for k in keys] + ([old] if old else []):
            fs.delete(file_system(self.spark, f"{self.path}/{name}")[1], False)

    def entries(self) -> tuple[Rows, list[tuple[str, Rows]]]:
        """(the rows of the roll, (key, rows) of each entry that it doesn't hold, by key)."""
        with self._lock:
            keys, roll = self._names()
            return self._load(roll) if roll else [], [(k, self._load(f"entry-{k}.json")) for k in keys]

    def read(self) -> Rows:
        """The rows of all entries, merged."""
        rolled, entries = self.entries()
        return self.combine([rolled, *(rows for _, rows in entries)])
