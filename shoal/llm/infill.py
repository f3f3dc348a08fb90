"""Fill-in-the-middle: a text is cut at two ranks of its units and its parts are put in an
order that ends with the middle.

An indexable skip list finds the cuts: the lowest lane has a node for every unit, each lane
above a node for ``STEP`` nodes of the one below, and every node carries two widths, how many
units and how many code points it covers.  A descent moves along a lane while the units
passed stay within the rank, then goes down; the code points passed on the way are the cut,
exact whatever the lengths of the units.

A row is worked on alone (no shuffle), its memory is its own text.  Defined results: a null
text is the empty text; an empty text, or one that holds a sentinel, stays plain; equal rows
give equal results (the draw depends on seed and id alone; a null id draws as the empty
id); an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from shoal.llm import common as C

STEP = 8  # nodes of a lane under one node of the lane above
PLAIN, PSM, SPM = "plain", "psm", "spm"


class SkipList:
    """Lanes over units, top lane first; each lane is (units of its nodes, code points of its nodes)."""

    def __init__(self, widths: list[int]):
        lanes = [([1] * len(widths), widths)]
        while len(lanes[-1][0]) > STEP:
            below = lanes[-1]
            at = range(0, len(below[0]), STEP)
            lanes.append(tuple([sum(w[i:i + STEP]) for i in at] for w in below))
        self.lanes = lanes[::-1]

    def descend(self, target: int, by: int = 0) -> tuple[int, int]:
        """(units, code points) of the longest run of whole units from the start whose width
        stays within ``target``: of units (``by`` 0) or of code points (``by`` 1)."""
        passed, node = [0, 0], 0
        for lane in self.lanes:
            units, chars = lane
            while node < len(units) and passed[by] + lane[by][node] <= target:
                passed[0] += units[node]
                passed[1] += chars[node]
                node += 1
            node *= STEP  # the first node below the one that was too wide
        return passed[0], passed[1]


def lines(text: str) -> list[int]:
    """Code points of ``[^\\n]*\\n|[^\\n]+``, left to right."""
    parts = text.split("\n")
    widths = [len(p) + 1 for p in parts[:-1]]
    return widths + [len(parts[-1])] if parts[-1] else widths


def words(text: str) -> list[int]:
    """Words with the white space behind them (leading white space is a unit of its own)."""
    return [m.end() - m.start() for m in re.finditer(r"\s+|\S+\s*", text)]


def characters(text: str) -> list[int]:
    return [1] * len(text)


@dataclass(frozen=True)
class Infill:
    """``rate`` per cent of the texts are cut, ``spm`` per cent of those put the suffix first."""

    seed: int = 7
    rate: int = 100
    spm: int = 50
    units: Callable[[str], list[int]] = lines
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def draws(self, doc_id) -> tuple[int, int, int, int]:
        digest = hashlib.sha256(f"{self.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
        return tuple(int(digest[i:i + 8], 16) for i in (0, 8, 16, 24))

    def cut(self, doc_id, text: str) -> tuple[int, str, int | None, int | None, str]:
        """(units, form, code points of the prefix, of the middle, output)."""
        nodes = SkipList(self.units(text))
        n = sum(nodes.lanes[0][0])
        h1, h2, h3, h4 = self.draws(doc_id)
        if not text or any(s in text for s in (self.prefix, self.suffix, self.middle)) or h3 % 100 >= self.rate:
            return n, PLAIN, None, None, text
        low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
        a, b = nodes.descend(low)[1], nodes.descend(high)[1]
        parts = {"P": self.prefix + text[:a], "M": self.middle + text[a:b], "S": self.suffix + text[b:]}
        form = SPM if h4 % 100 < self.spm else PSM
        order = "SPM" if form == SPM else "PSM"
        return n, form, a, b - a, "".join(parts[k] for k in order)

    def restore(self, form: str, output: str) -> str:
        """The text again, from output and form alone: its parts hold no sentinel, so the first
        one of each kind is the mark."""
        if form == PLAIN:
            return output
        first, second = (self.suffix, self.prefix) if form == SPM else (self.prefix, self.suffix)
        one, rest = output[len(first):].split(second, 1)
        two, middle = rest.split(self.middle, 1)
        return two + middle + one if form == SPM else one + middle + two


RESULT = "n long, form string, prefix_chars long, middle_chars long, output string"


def transform(docs: DataFrame, how: Infill = Infill(), text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id, n units, form, prefix_chars, middle_chars, output) of every document."""
    names = [c.split()[0] for c in RESULT.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]

    def run(batches):
        for b in batches:
            rows = [how.cut(i, t or "") for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
            cols = zip(*rows, strict=True) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], [id_col, *names])

    kind = docs.schema[id_col].dataType.simpleString()
    return C.map_batches(docs.select(id_col, text_col), run, f"`{id_col}` {kind}, {RESULT}")


def restored(cut: DataFrame, how: Infill = Infill(), id_col: str = "doc_id") -> DataFrame:
    """``cut`` with the column ``restored``: each text rebuilt from ``output`` and ``form``."""
    schema = StructType([*cut.schema.fields, StructField("restored", StringType())])

    def run(batches):
        for b in batches:
            texts = [how.restore(f, o) for f, o in zip(b.column("form").to_pylist(), b.column("output").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], [*b.schema.names, "restored"])

    return C.map_batches(cut, run, schema)


def digests(docs: DataFrame, how: Infill = Infill()) -> DataFrame:
    """The digest columns of the driver query."""
    both = restored(transform(docs, how), how)
    sha = lambda c: F.sha2(F.col(c).cast("binary"), 256)
    return both.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       sha("output").alias("output_sha256"), sha("restored").alias("restored_sha256"))
