"""SentencePiece encoding and decoding as a weighted finite-state transducer.

``Transducer`` compiles a model file: its normaliser (space to U+2581, a leading one put
before the text), its pieces and the byte fallback for characters no piece has.  A text
is composed with it word by word: the states are (position, last piece), the arcs
are pieces, and the encoding is the shortest path in the tropical semiring.

* unigram models: an arc costs minus the piece's score;
* BPE models: an arc costs 0 if its piece may follow the last one - merging the two
  pieces' characters gives these two pieces again - and is missing otherwise.  Merging
  is local, so exactly one path remains, and it is the library's merge result.

No piece spans the start of a word, so words compose alone, and a word already met is
looked up (up to a bound).  Runs of U+2581 have pieces of one tied, lowest score; they
merge last and from the left, which one pass with a stack does.

Cases: a null text gives null ids; an empty text no ids; very long texts and words are
encoded whole, in time proportional to their length; repeated rows are encoded alike; an
empty table gives an empty result; further columns are returned as they are.  U+2581 in a
text is read as a space, as the library does, so it comes back as one.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoal.llm import common as C

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6  # piece types of the file format
UNIGRAM, BPE = 1, 2
WORDS = 100_000  # words a worker remembers, twice
PAIRS = 1_000_000  # and pairs of pieces


def _fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of one protocol buffer message."""

    def varint(i: int) -> tuple[int, int]:
        v = shift = 0
        while True:
            v |= (raw[i] & 127) << shift
            shift += 7
            i += 1
            if raw[i - 1] < 128:
                return v, i

    i = 0
    while i < len(raw):
        key, i = varint(i)
        kind = key & 7
        if kind == 0:
            value, i = varint(i)
        else:
            n = {1: 8, 5: 4}.get(kind)
            if n is None:
                n, i = varint(i)
            value, i = raw[i:i + n], i + n
        yield key >> 3, value


class Transducer:
    def __init__(self, model: bytes):
        self.ids: dict[str, int] = {}
        self.pieces: list[str] = []
        self.cost: list[float] = []
        self.byte: dict[int, int] = {}
        self.out: list[bytes] = []
        self.table: pa.Array | None = None  # ``out`` as a column
        self.unk, kind, norm = 0, UNIGRAM, {}
        for number, value in _fields(model):
            if number == 1:
                f = dict(_fields(value))
                piece, score, typ = f.get(1, b"").decode(), struct.unpack("<f", f[2])[0] if 2 in f else 0.0, f.get(3, NORMAL)
                i = len(self.pieces)
                self.pieces.append(piece)
                self.cost.append(-score)
                if typ == NORMAL:
                    self.ids[piece] = i
                    self.out.append(piece.replace(SPACE, " ").encode())
                elif typ == BYTE:
                    self.byte[int(piece[3:5], 16)] = i
                    self.out.append(bytes([int(piece[3:5], 16)]))
                elif typ == UNKNOWN:
                    self.unk = i
                    self.out.append(" ⁇ ".encode())
                elif typ == CONTROL:
                    self.out.append(b"")
                else:
                    raise ValueError(f"pieces of type {typ} are not supported")
            elif number == 2:
                kind = dict(_fields(value)).get(3, UNIGRAM)
            elif number == 3:
                norm = dict(_fields(value))
        if kind not in (UNIGRAM, BPE):
            raise ValueError("only unigram and BPE models are supported")
        if norm.get(2) or norm.get(4, 1):
            raise ValueError("only the identity normaliser, without removal of spaces, is supported")
        if any(SPACE in p.lstrip(SPACE) or p.startswith(SPACE * 2) and p.strip(SPACE) for p in self.ids):
            raise ValueError("pieces that span words are not supported")
        self.bpe, self.prefix = kind == BPE, bool(norm.get(3, 1))
        self.score = {p: self.cost[i] for p, i in self.ids.items()}
        self.trie: dict = {}
        for p, i in self.ids.items():
            if self.bpe and self.merged(p) != [p]:
                continue  # merging its characters never gives this piece: no arc has it
            node = self.trie
            for ch in p:
                node = node.setdefault(ch, {})
            node[""] = i
        self.single = {p for p in self.ids if len(p) == 1}
        self.longest = max(map(len, self.ids), default=1)
        self.follows: dict[int, bool] = {}
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    # -- arcs ---------------------------------------------------------------------------
    def merged(self, text: str, border: int = 0) -> list[str]:
        """The pieces that merging leaves of a short string: best score first, then leftmost.
        With a ``border``, merging stops (with the pieces so far) where it would cross it."""
        parts, get, none = list(text), self.score.get, float("inf")
        costs = [get(x + y, none) for x, y in zip(parts, parts[1:], strict=False)]
        while costs and (best := min(costs)) < none:
            k = costs.index(best)
            if border:
                if k == border - 1:
                    break
                if k < border:
                    border -= 1
            parts[k:k + 2] = [parts[k] + parts[k + 1]]
            del costs[k]
            if k:
                costs[k - 1] = get(parts[k - 1] + parts[k], none)
            if k < len(costs):
                costs[k] = get(parts[k] + parts[k + 1], none)
        return parts

    def may_follow(self, a: int, b: int) -> bool:
        """Whether piece b may follow piece a on a path."""
        p, q = self.pieces[a], self.pieces[b]
        got = self.merged(p + q, len(p)) == [p, q] and p + q not in self.score
        if len(self.follows) >= PAIRS:
            self.follows.clear()
        self.follows[a * len(self.pieces) + b] = got
        return got

    # -- shortest paths -----------------------------------------------------------------
    def path(self, text: str) -> list[int]:
        """Ids of the shortest path through characters that all are pieces."""
        return self.merge_path(text) if self.bpe else self.score_path(text)

    def merge_path(self, text: str) -> list[int]:
        """The one path whose pieces may follow each other: its weight is 0, so a state that is
        reached is final; the furthest is left first, and the search ends where the text does."""
        n, trie, follows, size = len(text), self.trie, self.follows, len(self.pieces)
        last: list[int | None] = [None] * (n + 1)  # the piece that ends here
        back = [0] * (n + 1)
        last[0], todo = -1, [0]
        while todo and last[n] is None:
            i = todo.pop()
            here, node, j = last[i], trie, i
            while j < n and (node := node.get(text[j])) is not None:
                j += 1
                p = node.get("")
                if p is None or last[j] is not None:
                    continue
                if here >= 0:
                    ok = follows.get(here * size + p)
                    if not (self.may_follow(here, p) if ok is None else ok):
                        continue
                last[j], back[j] = p, i
                todo.append(j)
        return self.stitched(last, back)

    def score_path(self, text: str) -> list[int]:
        n, trie = len(text), self.trie
        last: list[int | None] = [None] * (n + 1)
        back = [0] * (n + 1)
        dist = [float("inf")] * (n + 1)
        last[0], dist[0] = -1, 0.0
        for i in range(n):
            if last[i] is None:
                continue
            node = trie
            for j in range(i, n):
                node = node.get(text[j])
                if node is None:
                    break
                p = node.get("")
                if p is not None and dist[i] + self.cost[p] < dist[j + 1]:
                    dist[j + 1], last[j + 1], back[j + 1] = dist[i] + self.cost[p], p, i
        return self.stitched(last, back)

    @staticmethod
    def stitched(last: list[int | None], back: list[int]) -> list[int]:
        ids, i = [], len(last) - 1
        while i:
            ids.append(last[i])
            i = back[i]
        return ids[::-1]

    def spaces(self, n: int) -> list[int]:
        """Ids of a run of n U+2581."""
        if not self.bpe:
            return self.path(SPACE * n)
        stack: list[int] = []
        for _ in range(n):
            stack.append(1)
            while len(stack) > 1 and SPACE * (stack[-2] + stack[-1]) in self.ids and stack[-2] + stack[-1] <= self.longest:
                stack[-2:] = [stack[-2] + stack[-1]]
        return [self.ids[SPACE * k] for k in stack]

    def word(self, word: str) -> list[int]:
        """Ids of U+2581 (any number) and a word; unknown characters go to the byte arcs."""
        body = word.lstrip(SPACE)
        n = len(word) - len(body)
        if not body:
            return self.spaces(n)
        ids, known = [], SPACE if n else ""
        if self.single.issuperset(body):
            known += body
            body = ""
        for ch in body:
            if ch in self.ids:
                known += ch
                continue
            ids += self.path(known)
            known = ""
            if self.byte:
                ids += [self.byte[b] for b in ch.encode("utf-8", "surrogatepass")]
            elif not ids or ids[-1] != self.unk:
                ids.append(self.unk)
        ids += self.path(known)
        if n > 1 or not self.bpe:
            alone = n and ids[0] == self.ids.get(SPACE)
            if self.bpe:
                return self.spaces(n) + ids[1:] if alone else self.spaces(n - 1) + ids
            if n > 1:
                return self.path(SPACE * (n - 1)) + ids
        return ids

    def encode(self, text: str) -> bytes:
        """Little-endian 32-bit ids of a text."""
        if not text:
            return b""
        get, out = self.words.get, []
        for w in WORD.findall((SPACE if self.prefix else "") + text.replace(" ", SPACE)):
            ids = get(w)
            if ids is None:
                ids = self.older.get(w) or pack(self.word(w))
                if len(w) < 200:
                    self.words[w] = ids
                    if len(self.words) >= WORDS:  # of the words before, those met again are taken over
                        self.words, self.older = {}, self.words
                        get = self.words.get
            out.append(ids)
        return b"".join(out)

    def decode(self, ids: list[int]) -> bytes:
        """The inverse composition: UTF-8 of the ids' pieces and bytes."""
        return self.unprefixed(b"".join([self.out[i] for i in ids]))

    def decode_all(self, ids: pa.ListArray) -> list[bytes | None]:
        """``decode`` of every list; no id becomes a Python object."""
        if self.table is None:
            self.table = pa.array(self.out, pa.binary())
        offsets = pc.subtract(ids.offsets, ids.offsets[0])
        joined = pc.binary_join(pa.ListArray.from_arrays(offsets, self.table.take(ids.values.slice(ids.offsets[0].as_py(), offsets[-1].as_py()))), b"")
        return [self.unprefixed(x) if there else None for x, there in zip(joined.to_pylist(), ids.is_valid().to_pylist(), strict=True)]

    def unprefixed(self, text: bytes) -> bytes:
        return text[1:] if self.prefix and text[:1] == b" " else text


def version_of(model: bytes) -> str:
    return f"pieces {crc32(model)}"


def transducer(model: bytes) -> Transducer:
    """The model's transducer; a worker keeps it, with the words met, from task to task."""
    held = C.hold(version_of(model))
    if "transducer" not in held:
        held["transducer"] = Transducer(model)
    return held["transducer"]


def pack(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}i", *ids)


WORD = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


def compiled(model_file: str) -> bytes:
    """The model's bytes, read on the driver: they go to the tasks with the broadcast."""
    with open(model_file, "rb") as f:
        return f.read()


def encode(docs: DataFrame, model_file: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` with ``ids_col``: array of piece ids (null for a null text), in the place of a
    column of that name."""
    docs = docs.drop(ids_col)
    model = docs.sparkSession.sparkContext.broadcast(compiled(model_file))
    (raw,) = C.fresh(docs, "raw_text")

    def run(batches):
        t = transducer(model.value)
        for b in batches:
            coded = [None if x is None else t.encode(x) for x in b.column(b.num_columns - 1).to_pylist()]
            sizes = np.array([0, *(len(x) // 4 if x else 0 for x in coded)], np.int64)
            flat = np.frombuffer(b"".join(x for x in coded if x), "<i4")
            offsets = pa.array(np.cumsum(sizes).astype(np.int32), mask=np.array([*(x is None for x in coded), False]))
            ids = pa.ListArray.from_arrays(offsets, pa.array(flat, pa.int32()))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], ids], [*b.schema.names[:-1], ids_col])

    schema = T.StructType([*docs.schema.fields, T.StructField(ids_col, T.ArrayType(T.IntegerType()))])
    return C.map_batches(docs.withColumn(raw, F.col(text_col)), run, schema, version_of(model.value))


def decode(coded: DataFrame, model_file: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``coded`` with ``text_col``: the text of its ids (null for null ids), in the place of a
    column of that name."""
    coded = coded.drop(text_col)
    model = coded.sparkSession.sparkContext.broadcast(compiled(model_file))

    def run(batches):
        t = transducer(model.value)
        for b in batches:
            col = b.column(b.schema.get_field_index(ids_col))
            texts = [None if x is None else x.decode("utf-8", "replace") for x in t.decode_all(col)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], [*b.schema.names, text_col])

    schema = T.StructType([*coded.schema.fields, T.StructField(text_col, T.StringType())])
    return C.map_batches(coded, run, schema, version_of(model.value))
