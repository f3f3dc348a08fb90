"""Quality classifier: a weak-label model and a hashed linear scorer.

Two questions are asked of a text: is it junk, and is it toxic?  For each, several
overlapping labellers vote bad, good or nothing: shape heuristics, lexicons of words and
word beginnings, and the ``labels`` table where it covers a document.  Expectation-
maximisation over all documents' vote patterns estimates how often each labeller is right;
the posteriors label a bounded sample, and an L1-regularised logistic scorer over hashed
words, word beginnings and shape levels is trained on it; its weights are 0 or more and
each counts once a document, in training and in scoring, however many words share it.  The
scorer then judges every document, labelled or not.

Bounds: lexicons and scorer are fitted on at most ``sample_rows`` labelled rows, chosen by
a hash of their id; vote patterns are counted over all documents, and there are at most
3 to the number of labellers of them.  The sample's words and slots are counted on Spark;
the driver holds the lexicons and, of each sampled row, the slots that training looks at.

Cases: a null or empty text has no words, no votes but its label's, and is kept; repeated
rows are scored alike; very long texts are scored whole; documents named several times in
``labels`` take the worst label; labels without a document, or null, don't matter; without
any usable label or document the scorer is empty and keeps everything; further columns of
the documents are returned as they are.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from dataclasses import dataclass, field
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoal.llm import common as C

SAMPLE_ROWS = 12_000
SUPPORT = 5.0  # bad rows that must speak for a feature
STEMS = (4, 5, 6)  # bytes of a word's beginning
LEVELS = 10
TASKS = ("junk", "toxic")
_NOT = {name: bytes(c for c in range(256) if chr(c) not in chars) for name, chars in (
    ("symbols", "#*$%&|<>"), ("upper", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"), ("letters", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"))}
BAD, GOOD, NONE = "b", "g", "-"


class Shape:
    """Shares that describe a text's form, from 0 to 1."""

    NAMES = ("symbols", "marks", "upper", "repeats", "stutter", "common")
    BOUNDS = ((0.05, 0.15), (0.05, 0.3), (0.2, 0.6), (0.1, 0.4), (0.05, 0.3), (0.25, 0.5))  # good below, bad above

    def __init__(self, raw: bytes):
        w = raw.split()
        n = max(len(w), 1)
        four = len(w) - 3
        count = lambda name: len(raw.translate(None, _NOT[name]))
        self.n = len(w)
        self.shares = (
            min(1.0, count("symbols") / n / 2),
            sum(x.endswith(b"!!") for x in w) / n if b"!!" in raw else 0.0,
            count("upper") / max(count("letters"), 1),
            1 - len(set(zip(w, w[1:], w[2:], w[3:], strict=False))) / four if four > 0 else 0.0,
            sum(map(bytes.__eq__, w, w[1:])) / n,
            max(Counter(w).values()) / n if len(w) >= 20 else 0.0,
        )

    def votes(self) -> str:
        """One vote a heuristic; shares in between get none."""
        if not self.n:
            return NONE * len(self.NAMES)
        return "".join(GOOD if s < lo else BAD if s > hi else NONE for s, (lo, hi) in zip(self.shares, self.BOUNDS, strict=True))

    def features(self) -> list[int]:
        """Every level that a share reaches."""
        return [_slot(b"\0%s %d" % (name.encode(), i)) for name, s in zip(self.NAMES, self.shares, strict=True)
                for i in range(1, 1 + int(s * LEVELS + 1e-9))]


def _slot(feature: bytes) -> int:
    """32 bits: a text of 100,000 words meets the few thousand slots of weight by chance about
    once in ten times, where a table of 2^18 would meet a third of them."""
    return crc32(feature)


def stems(word: bytes) -> list[bytes]:
    return [word[:k] for k in STEMS if len(word) > k]


class Kept(dict):
    """What ``make`` says of a word, remembered up to a bound."""

    LIMIT = 150_000

    def __init__(self, make):
        self.make = make

    def __missing__(self, word: bytes):
        if len(self) >= self.LIMIT:
            self.clear()
        v = self[word] = self.make(word)
        return v


SLOTS = "slots"  # the version of what holds for every model


def kept(name: str, version, make) -> Kept:
    """A worker's cache of that name, from task to task; a new version drops all others."""
    held = C.hold(version)
    if name not in held:
        held[name] = Kept(make)
    return held[name]


def slots(word: bytes) -> tuple[int, ...]:
    """The hashed features of a word."""
    return (_slot(word), *(_slot(b"\1" + s) for s in stems(word)))


@dataclass
class Lexicon:
    words: frozenset = frozenset()
    beginnings: frozenset = frozenset()

    def marks(self, word: bytes) -> tuple[bool, bool]:
        return word in self.words, not self.beginnings.isdisjoint(stems(word))

    @staticmethod
    def votes(counts: tuple[int, int]) -> str:
        return "".join(BAD if x >= 2 else GOOD if x == 0 else NONE for x in counts)

    @staticmethod
    def features(counts: tuple[int, int]) -> list[int]:
        return [_slot(b"\2%d %d" % (k, i)) for k, n in enumerate(counts) for i in range(1, 1 + min(n, 5))]


def total(rows: list[tuple], width: int) -> tuple:
    """Column sums."""
    return tuple(map(sum, zip(*rows, strict=True))) if rows else (0,) * width


class Weights(dict):
    """slot -> a weight for each task; ``weights[:, slot] = w`` gives all tasks the same."""

    def __setitem__(self, at, weight):
        if isinstance(at, tuple):
            at, weight = at[1], [weight] * len(TASKS)
        super().__setitem__(at, weight)


@dataclass
class Model:
    weights: dict = field(default_factory=Weights)  # slot -> weight for each task, of slots that have any
    bias: tuple[float, ...] = (-1.0,) * len(TASKS)
    lexicon: Lexicon = field(default_factory=Lexicon)
    accuracy: dict = field(default_factory=dict)  # (task, labeller) -> share of its votes that are right


def _label(col: str, bad_value: int):
    return F.when(F.col(col) == bad_value, BAD).when(F.col(col).isNotNull(), GOOD).otherwise(NONE)


def label_votes(labels: DataFrame) -> DataFrame:
    """(doc, junk_label, toxic_label): one row a labelled id, the worst label if several."""
    rank = lambda c, bad: F.min(F.when(F.col(c) == bad, 0).when(F.col(c).isNotNull(), 1).otherwise(2))
    one = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(rank("quality", 0).alias("j"), rank("toxic", 1).alias("t"))
    vote = lambda c: F.element_at(F.array(F.lit(BAD), F.lit(GOOD), F.lit(NONE)), F.col(c) + 1)
    return one.select(F.col("doc_id").alias("doc"), vote("j").alias("junk_label"), vote("t").alias("toxic_label"))


def sample(docs: DataFrame, votes: DataFrame, id_col: str, text_col: str, rows: int, scratch: C.Scratch) -> DataFrame:
    """Votes, words (as Latin-1 text) and slots of at most ``rows`` labelled documents (the bounded
    fitting sample), as a table.  Of several rows of one id the one with the least hash counts."""
    few = votes.orderBy(F.xxhash64("doc"), "doc").limit(rows)  # proven bound: safe to broadcast

    def read(batches):
        cache = kept("slots", SLOTS, slots)
        for b in batches:
            made = []
            for raw in b.column(2).to_pylist():
                words = sorted(set(C.alnum_words(raw)))
                shape = Shape(raw)
                ids = shape.features()
                for w in words:
                    ids.extend(cache[w])
                made.append((shape.votes(), np.unique(np.array(ids, np.int64)).tolist(), [w.decode("latin-1") for w in words]))
            v, f, w = zip(*made, strict=True) if made else ((), (), ())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(v, pa.string()), pa.array(f, pa.list_(pa.int64())),
                                              pa.array(w, pa.list_(pa.string()))], ["junk_label", "toxic_label", "shape", "slots", "words"])

    one = docs.select(F.col(id_col).alias("d"), C.text_bytes(text_col).alias("text")).join(F.broadcast(few), F.col("d") == F.col("doc")) \
        .groupBy("doc", "junk_label", "toxic_label").agg(F.min(F.struct(F.xxhash64("text"), "text"))["text"].alias("text"))
    made = C.map_batches(one.select("junk_label", "toxic_label", "text"), read,
                         "junk_label string, toxic_label string, shape string, slots array<long>, words array<string>", SLOTS)
    return scratch.table(made, "sample")


def lexicon(rows: DataFrame) -> Lexicon:
    """Words and word beginnings that toxic rows have and others don't, counted on Spark: those
    alone that speak come back."""
    known = rows.where(F.col("toxic_label") != NONE).withColumn("bad", (F.col("toxic_label") == BAD).cast("int"))
    bad, n = known.agg(F.coalesce(F.sum("bad"), F.lit(0)), F.count("*")).first()
    if not 0 < bad < n:
        return Lexicon()
    begin = lambda w: F.transform(F.filter(F.array(*map(F.lit, STEMS)), lambda k: F.length(w) > k), lambda k: F.substring(w, F.lit(1), k))
    beginnings = F.array_distinct(F.flatten(F.transform("words", begin)))

    def picked(found, least: int) -> frozenset:
        counts = known.select("bad", F.explode(found).alias("x")).groupBy("x").agg(F.sum("bad").alias("a"), F.sum(1 - F.col("bad")).alias("b"))
        odds = F.log((F.col("a") + 0.5) / (bad + 1)) - F.log((F.col("b") + 0.5) / (n - bad + 1))
        return frozenset(r["x"].encode("latin-1") for r in counts.where((F.col("a") >= least) & (odds >= 4)).select("x").collect())

    return Lexicon(picked(F.col("words"), 4), picked(beginnings, 8))


def em(patterns: dict[str, int], labellers: int, rounds: int = 60) -> tuple[dict[str, float], list[float]]:
    """Posterior that a pattern's documents are bad, and each labeller's accuracy.

    Every labeller has its own chances of each vote for bad and for good documents; the
    last labeller is the labels table, and starts as the most trusted."""
    keys = list(patterns)
    if not keys:
        return {}, [0.0] * labellers
    n = np.array([patterns[k] for k in keys], float)
    votes = np.array([[{BAD: 0, GOOD: 1, NONE: 2}[c] for c in k] for k in keys])
    trust = np.ones(labellers)
    trust[-1] = 6
    lean = ((votes == 0) * trust).sum(1) - ((votes == 1) * trust * 0.5).sum(1)
    post = 1 / (1 + np.exp(-(lean - 0.5)))
    for _ in range(rounds):
        share = np.clip((post * n).sum() / n.sum(), 1e-4, 1 - 1e-4)
        logit = np.full(len(keys), math.log(share / (1 - share)))
        for j in range(labellers):
            for v in range(3):
                hit = votes[:, j] == v
                p1 = ((post * n)[hit].sum() + 0.5) / ((post * n).sum() + 1.5)
                p0 = (((1 - post) * n)[hit].sum() + 0.5) / (((1 - post) * n).sum() + 1.5)
                logit[hit] += np.clip(math.log(p1 / p0), -6, 6)
        post = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
    right = []
    for j in range(labellers):
        bad, good = votes[:, j] == 0, votes[:, j] == 1
        total = n[bad | good].sum()
        right.append(float(((post * n)[bad].sum() + ((1 - post) * n)[good].sum()) / total) if total else 0.0)
    return dict(zip(keys, post.tolist(), strict=True)), right


def row_weights(target: np.ndarray) -> tuple[np.ndarray, float]:
    """(what each row weighs, the L1 term): both classes weigh the same in sum; a feature gets a
    weight only if more than about SUPPORT bad rows speak for it."""
    bad = max(target.sum(), 1.0)
    return np.where(target > 0.5, 0.5 / bad, 0.5 / max((1 - target).sum(), 1.0)), 0.25 * SUPPORT / bad


def train(features: list[np.ndarray], target: np.ndarray, steps: int = 400) -> tuple[np.ndarray, float]:
    """Logistic regression on 0/1 features with weights of 0 or more under an L1 term, by
    accelerated projected gradient steps.  ``features`` are each row's numbers from 0 up; they
    need only hold what speaks at zero weights (:func:`speaking`): no other would leave zero."""
    out = np.zeros(max((int(f.max()) + 1 for f in features if len(f)), default=0), np.float32)
    if not len(out) or not 0 < target.mean() < 1:
        return out, -1.0
    m = len(features)
    weight, l1 = row_weights(target)
    rows = np.repeat(np.arange(m, dtype=np.int32), [len(f) for f in features])
    cols = np.concatenate(features)
    pull = np.bincount(cols, (weight * (target - 0.5))[rows], len(out))
    speaks = pull > l1
    rows, cols = rows[speaks[cols]], cols[speaks[cols]]
    used, cols = np.unique(cols, return_inverse=True)
    if not len(used):
        return out, -1.0
    most = np.bincount(rows, minlength=m).max() + 1
    rate = 4.0 / most  # below the inverse of the largest curvature, as the weights sum to 1
    w = np.zeros(len(used))
    b = 0.0
    for penalty in (l1, l1 / 50):  # choose the features, then weigh the chosen almost freely
        open_ = np.ones(len(used), bool) if penalty == l1 else w > 0
        v, bv, t = w, b, 1.0
        for _ in range(steps):
            z = np.bincount(rows, v[cols], m) + bv
            err = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - target)
            nw = np.maximum(v - rate * (np.bincount(cols, err[rows], len(used)) + penalty), 0) * open_
            nb = bv - rate * err.sum()
            t, old = (1 + math.sqrt(1 + 4 * t * t)) / 2, t
            v, bv = nw + (old - 1) / t * (nw - w), nb + (old - 1) / t * (nb - b)
            w, b = nw, nb
    out[used] = w
    return out, float(b)


def speaking(voted: DataFrame, key: str, post: dict[str, float]) -> np.ndarray:
    """Slots whose pull at zero weights is above the L1 term: of a row's slots the only ones that
    training looks at.  Each row pulls by its posterior; summed exactly, on Spark."""
    counts = {r[key]: r["count"] for r in voted.groupBy(key).count().collect()}  # at most 3 to the labellers
    keys = sorted(counts)
    target = np.repeat([post.get(k, 0.0) for k in keys], [counts[k] for k in keys])
    if not len(target) or not 0 < target.mean() < 1:
        return np.empty(0, np.int64)
    weight, l1 = row_weights(target)
    first = np.cumsum([0, *(counts[k] for k in keys)])[:-1]
    pulls = voted.sparkSession.createDataFrame([(k, float(weight[i] * (target[i] - 0.5))) for k, i in zip(keys, first, strict=True)], f"{key} string, pull double")
    each = voted.select(key, F.explode("slots").alias("slot")).groupBy("slot", key).count().join(F.broadcast(pulls), key)
    found = each.groupBy("slot").agg(F.sum((F.col("pull") * F.col("count")).cast("decimal(38,24)")).alias("pull")).where(F.col("pull") > 0.999 * l1)
    return np.array(sorted(r["slot"] for r in found.select("slot").collect()), np.int64)  # each in several bad rows of the sample


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> Model:
    scratch = C.Scratch(docs.sparkSession, "classifier")
    votes = label_votes(labels)
    rows = sample(docs, votes, id_col, text_col, sample_rows, scratch)
    lex = lexicon(rows)
    version = uuid.uuid4().hex

    def vote(batches):
        marks = kept("marks", version, lex.marks)
        for b in batches:
            out = []
            for raw in b.column(1).to_pylist():
                words = set(C.alnum_words(raw))
                out.append((Shape(raw).votes(), lex.votes(total([marks[w] for w in words], 2)) if words else NONE * 2))
            s, t = zip(*out, strict=True) if out else ((), ())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s, pa.string()), pa.array(t, pa.string())], ["d", "shape", "lex"])

    kind = docs.schema[id_col].dataType.simpleString()
    cast = C.map_batches(docs.select(F.col(id_col).alias("d"), C.text_bytes(text_col).alias("text")), vote, f"d {kind}, shape string, lex string", version)
    seen = cast.join(votes, F.col("d") == F.col("doc"), "left").groupBy(
        "shape", "lex", F.coalesce("junk_label", F.lit(NONE)).alias("j"), F.coalesce("toxic_label", F.lit(NONE)).alias("t")).count().collect()
    junk, toxic = Counter(), Counter()
    for r in seen:
        junk[r["shape"] + r["j"]] += r["count"]
        toxic[r["lex"] + r["t"]] += r["count"]
    names = ((*Shape.NAMES, "labels"), ("lexicon", "beginnings", "labels"))
    posts, accuracy = [], {}
    for task, counts, labellers in zip(TASKS, (junk, toxic), names, strict=True):
        post, right = em(counts, len(labellers))
        posts.append(post)
        accuracy.update({(task, name): r for name, r in zip(labellers, right, strict=True)})

    def keyed(batches):
        """A row's pattern for each task, and its slots with those of its lexicon counts."""
        marks = kept("marks", version, lex.marks)
        for b in batches:
            made = []
            for j, t, shape, own, words in zip(*(c.to_pylist() for c in b.columns), strict=True):
                counts = total([marks[w.encode("latin-1")] for w in words], 2)
                made.append((shape + j, lex.votes(counts) + t, sorted({*own, *lex.features(counts)})))
            cols = zip(*made, strict=True) if made else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.string(), pa.string(), pa.list_(pa.int64())), strict=True)],
                                             ["junk", "toxic", "slots"])

    voted = scratch.table(C.map_batches(rows, keyed, "junk string, toxic string, slots array<long>", version), "voted")
    weights, bias = {}, []
    for task, post in zip(TASKS, posts, strict=True):
        speaks = speaking(voted, task, post)

        def chosen(batches, speaks=speaks):
            """Each row's speaking slots, by their number."""
            for b in batches:
                lists, out = b.column(1), []
                ends = np.append(0, np.cumsum(lists.value_lengths().to_numpy()))
                flat = lists.flatten().to_numpy()
                at = np.minimum(np.searchsorted(speaks, flat), len(speaks) - 1)
                hit = speaks[at] == flat if len(speaks) else np.zeros(len(flat), bool)
                for i, j in zip(ends, ends[1:], strict=False):
                    out.append(at[i:j][hit[i:j]].astype("<i4").tobytes())
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], ["key", "slots"])

        got = sorted((r["key"], bytes(r["slots"])) for r in C.map_batches(voted.select(task, "slots"), chosen, "key string, slots binary").collect())
        w, b = train([np.frombuffer(x, "<i4") for _, x in got], np.array([post.get(k, 0.0) for k, _ in got]))
        for k in np.flatnonzero(w).tolist():
            own = weights.setdefault(int(speaks[k]), [0.0] * len(TASKS))
            own[TASKS.index(task)] = float(w[k])
        bias.append(b)
    return Model(weights, tuple(bias), lex, accuracy)


def score(docs: DataFrame, model: Model, state: str, text_col: str = "text") -> DataFrame:
    """``docs`` with ``state``: struct(junk, toxic, kept); a score above 0 rejects."""
    cast = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias, model.lexicon))  # slots and words of the sample that speak
    (raw_col,) = C.fresh(docs, "raw_text")
    kind = T.StructType([T.StructField("junk", T.DoubleType()), T.StructField("toxic", T.DoubleType()), T.StructField("kept", T.BooleanType())])
    arrow = pa.struct([("junk", pa.float64()), ("toxic", pa.float64()), ("kept", pa.bool_())])

    version = uuid.uuid4().hex

    def run(batches):
        weights, bias, lex = cast.value
        strong = weights
        begins = kept("begins", version, lambda s: s in lex.beginnings or _slot(b"\1" + s) in strong)
        zero = ((), False, False)

        def say(word: bytes) -> tuple:
            """The word's slots of known weight and its marks; nearly all words have none."""
            a, b, c = STEMS
            if not (begins[word[:a]] or begins[word[:b]] or begins[word[:c]] or _slot(word) in strong or word in lex.words):
                return zero
            return (tuple(i for i in slots(word) if i in strong), *lex.marks(word))

        said = kept("said", version, say)
        for b in batches:
            made = []
            for raw in b.column(b.num_columns - 1).to_pylist():
                marks = [m for m in map(said.__getitem__, set(C.alnum_words(raw))) if m != zero]
                counts = sum(m[1] for m in marks), sum(m[2] for m in marks)
                # every slot counts once a document, as in training
                found = sorted({i for m in marks for i in m[0]} | {i for i in Shape(raw).features() + lex.features(counts) if i in strong})
                s = [round(v + sum(weights[i][k] for i in found), 6) for k, v in enumerate(bias)]
                made.append({"junk": s[0], "toxic": s[1], "kept": not raw.strip() or max(s) <= 0})
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(made, arrow)], [*b.schema.names[:-1], state])

    return C.map_batches(docs.withColumn(raw_col, C.text_bytes(text_col)), run, T.StructType([*docs.schema.fields, T.StructField(state, kind)]), version)


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The documents that the fitted scorer keeps, with their own columns."""
    (state,) = C.fresh(docs, "verdict")
    return score(docs, fit(docs, labels, id_col, text_col, **how), state, text_col).where(F.col(state)["kept"]).drop(state)
