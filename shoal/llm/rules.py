"""Quality rules as a short-circuit cascade.

``rule_order`` runs every rule on a sample, measures its cost (seconds a document) and
its rejections, and orders the rules by rejections per second; ``cascade`` then stops
at a document's first rejecting rule.  The order changes only the time taken: a document
is kept if and only if no rule rejects it.

Cases: a null, empty or blank text has no words and fails the base rule; repeated rows
are judged alike; very long texts are scanned whole; an empty table gives no rows and
the rules' written order; further columns of the input don't matter.
"""

from __future__ import annotations

import re
import time
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoal.llm import common as C

SAMPLE_ROWS = 2_000  # rows (about) that order the rules
WINDOW = 8
SYMBOLS = re.compile(rb"[#*$%&|<>]")


class Doc:
    """One text, its words, and figures that several rules share (computed on first use)."""

    def __init__(self, raw: bytes):
        self.raw = raw
        self.words = C.space_words(raw)

    @property
    def n_words(self) -> int:
        return len(self.words)

    @property
    def word_chars(self) -> int:
        return len(b"".join(self.words).decode("utf-8", "replace"))

    @property
    def n_symbols(self) -> int:
        return len(SYMBOLS.findall(self.raw))

    @property
    def n_dup_lines(self) -> int:
        seen, n = set(), 0
        for line in self.raw.split(b"\n"):
            if line in seen:
                n += 1
            elif line.split():
                seen.add(line)
        return n

    @property
    def n_repeat_words(self) -> int:
        """Words inside 8-word windows found twice or more in the text."""
        w = self.words
        if len(set(w)) == len(w):
            return 0
        windows = list(zip(*(w[i:] for i in range(WINDOW)), strict=False))
        times = Counter(windows)
        if len(times) == len(windows):
            return 0
        n, covered = 0, 0
        for i, x in enumerate(windows):
            if times[x] > 1:
                n += i + WINDOW - max(i, covered)
                covered = i + WINDOW
        return n


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Doc], bool]


RULES = (
    Rule("symbols", lambda d: 10 * d.n_symbols > 3 * d.n_words),
    Rule("dup_lines", lambda d: 10 * d.n_dup_lines > 6 * sum(1 for x in d.raw.split(b"\n") if x.split())),
    Rule("word_length", lambda d: not 2 * d.n_words <= d.word_chars <= 20 * d.n_words),
    Rule("marks", lambda d: 10 * sum(x.endswith(b"!!") for x in d.words) > 3 * d.n_words),
    Rule("stutter", lambda d: 10 * sum(map(bytes.__eq__, d.words, d.words[1:])) > 3 * d.n_words),
    Rule("top_word", lambda d: 10 * max(Counter(d.words).values(), default=0) > 4 * d.n_words),
)


def base(d: Doc) -> tuple[int, int, int, int, int, bool]:
    repeat = d.n_repeat_words
    return d.n_words, d.word_chars, d.n_symbols, d.n_dup_lines, repeat, d.n_words < 20 or 100 * repeat > 30 * d.n_words


def rule_order(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text",
               sample_rows: int = SAMPLE_ROWS, seed: int = 7) -> list[tuple[str, float, int, int]]:
    """(rule, seconds a document, rejections, sampled documents), best rejection per cost first.

    The sample is random over the whole table, about ``sample_rows`` rows at any size;
    one row a rule and task comes back."""
    n = docs.count()
    part = docs.sample(min(1.0, sample_rows / max(n, 1)), seed) if n > sample_rows else docs

    def trial(batches):
        seconds, rejected, seen = Counter(), Counter(), 0
        for b in batches:
            for raw in b.column(0).to_pylist():
                d = Doc(raw)
                if base(d)[-1]:
                    continue  # the cascade never sees these
                seen += 1
                for r in rules:
                    t = time.perf_counter()
                    rejected[r.name] += r.rejects(d)
                    seconds[r.name] += time.perf_counter() - t
        rows = [{"rule": r.name, "s": float(seconds[r.name]), "rejected": rejected[r.name], "seen": seen} for r in rules]
        yield pa.RecordBatch.from_pylist(rows, pa.schema([("rule", pa.string()), ("s", pa.float64()), ("rejected", pa.int64()), ("seen", pa.int64())]))

    rows = C.map_batches(part.select(C.text_bytes(text_col).alias("text")), trial, "rule string, s double, rejected long, seen long") \
        .groupBy("rule").agg(F.sum("s"), F.sum("rejected"), F.sum("seen")).collect()
    at = {r[0]: (r[1] / max(r[3], 1), int(r[2]), int(r[3])) for r in rows}
    known = [(r.name, *at.get(r.name, (0.0, 0, 0))) for r in rules]
    # one imagined rejection keeps rules apart that reject nothing in the sample: cheaper first
    return sorted(known, key=lambda x: -(x[2] + 1) / (x[3] + 2) / max(x[1], 1e-9))


def cascade(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text", id_col: str = "doc_id",
            order: list[str] | None = None) -> DataFrame:
    """(id, base figures, base_failed, kept): one narrow pass, a document's rules in order
    until one rejects it."""
    names = order if order is not None else [r[0] for r in rule_order(docs, rules, text_col)]
    by = {r.name: r for r in rules}
    ordered = [by[n] for n in names]

    def judge(batches):
        for b in batches:
            cols = [[] for _ in range(7)]
            for raw in b.column(1).to_pylist():
                d = Doc(raw)
                figures = base(d)
                kept = not figures[-1] and not any(r.rejects(d) for r in ordered)
                for c, v in zip(cols, (*figures, kept), strict=True):
                    c.append(v)
            kinds = [pa.int64()] * 5 + [pa.bool_()] * 2
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))],
                                             [id_col, *OUT])

    OUT = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"{id_col} {kind}, " + ", ".join(f"{c} {'boolean' if c in OUT[5:] else 'long'}" for c in OUT)
    return C.map_batches(docs.select(id_col, C.text_bytes(text_col).alias("text")), judge, schema)
