"""Jaccard join of documents' word-shingle sets by signature trees.

Two documents link when their sets' Jaccard similarity is at least ``share``; linked
documents form components.  No link between different sets is lost:

1. Equal sets are one node (the smallest document id).
2. Cheap links first: nodes that agree in one of eight min-hashes are compared with the
   smallest node there, exactly.  Groups of near copies join up through a few links.
3. Every other link joins two different components.  Tokens are ordered by their hash, and
   nodes post the first ``1.5 (1 - share) n`` of theirs.  What two linked sets don't have in
   common leaves them ``k = (1 - share) share n / 2`` posted tokens at least that they do
   (``least_common``): a node with fewer posted tokens that any other node posts has no
   further links, and the others may leave out their ``k - 1`` most frequent of these and
   still meet under one.  So passages and headings that many documents share don't bring
   them together.
   Under each token whose nodes belong to several components stands a signature tree:
   leaves have their size and a bitmap, which says of each slot whether an odd number of the
   set's tokens falls there, inner nodes the AND and OR of the bitmaps, the range of sizes and
   the component if it is one.  Common tokens cancel out, so every slot in which two bitmaps
   differ holds a token that only one of the sets has.  A dual traversal drops pairs of tree
   nodes whose least possible difference, sizes or common component rule out a new link;
   leaf pairs that remain are compared exactly.
4. Components of all links.

Two nodes meet under many tokens.  Tokens with the same smallest node are dealt together, in
parts of bounded size, so a task names their pairs once and not under every token.  A token
under which very many nodes stand is dealt in blocks; every pair of blocks is traversed by
a task of its own.

Cases: a document without words (or text) has an empty set, links with nothing and is its
own component; fewer words than a shingle has are one shingle; repeated rows link; rows
with equal id count as one document; a null id joins the component of an equal set with an
id, else its component is null; an empty table gives an empty result; very long texts are
taken whole; further columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shoal.llm import common as C
from shoal.llm import stars

SHINGLE = 5
SHARE = (80, 100)
BINS = 8  # min-hashes of the cheap links
WORDS = 16  # 64-bit words of a bitmap
FAN = 8
BLOCK = 1024
PART = 16  # blocks' rows that one part of a node's tokens has, about
PAIRS = 1 << 17  # pairs a task holds back to name each once


class Shingles:
    def __init__(self, n: int = SHINGLE):
        self.n = n

    def __call__(self, raw: bytes) -> np.ndarray:
        """Sorted distinct shingle hashes of a text."""
        return np.unique(C.window_hashes(C.word_hashes(C.lower_words(raw)), self.n))


def signature(tokens: np.ndarray) -> np.ndarray:
    slots = (tokens >> np.uint64(20)) % np.uint64(WORDS * 64)
    return np.packbits((np.bincount(slots.astype(np.int64), minlength=WORDS * 64) & 1).astype(np.uint8))


def posted(n: int, share: tuple[int, int]) -> int:
    """How many of its tokens a set of n posts."""
    num, den = share
    return min(n, 3 * (den - num) * n // (2 * den) + 1)


def least_common(n, share: tuple[int, int]):
    """At least so many posted tokens a set of n has in common with any set it links with.

    Up to the smaller of the two last posted hashes, one of the sets, of m tokens, posts all
    of its tokens there, ``posted(m)``.  It misses the other set in at most (1 - share) m
    tokens, so over (1 - share) m / 2 posted ones are common; and m is share n or more."""
    num, den = share
    return F.floor((den - num) * F.ceil(n * num / den) / (2 * den)) + 1


def sets_of(rows: DataFrame, n: int, share: tuple[int, int]) -> DataFrame:
    """One row a document: its set's size, 128-bit hash, min-hashes, bitmap and posted tokens."""

    def run(batches):
        shingles = Shingles(n)
        edges = (np.arange(BINS, dtype=np.uint64) << np.uint64(61))
        for b in batches:
            size, h1, h2, low, bits, prefix = [], [], [], [], [], []
            for raw in b.column(1).to_pylist():
                s = shingles(raw)
                size.append(len(s))
                h1.append(int(C.mix(s).sum().view(np.int64)))
                h2.append(int(C.mix(s ^ C._ODD[9]).sum().view(np.int64)))
                at = np.searchsorted(s, edges)
                firsts = s[at[at < len(s)]]
                low.append(np.unique(firsts).view(np.int64))
                bits.append(signature(s).tobytes())
                prefix.append(s[:posted(len(s), share)].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(size, pa.int32()), pa.array(h1, pa.int64()), pa.array(h2, pa.int64()),
                 _lists(low), pa.array(bits, pa.binary()), _lists(prefix)],
                ["doc", "n", "h1", "h2", "low", "bits", "prefix"])

    return C.map_batches(rows, run, "doc long, n int, h1 long, h2 long, low array<long>, bits binary, prefix array<long>")


def _lists(parts: list[np.ndarray]) -> pa.Array:
    off = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) for p in parts], out=off[1:])
    return pa.ListArray.from_arrays(pa.array(off), pa.array(np.concatenate([*parts, np.empty(0, np.int64)])))


def linked(pairs: DataFrame, texts: DataFrame, n: int, share: tuple[int, int]) -> DataFrame:
    """The pairs (a, b) whose sets link, compared exactly."""
    num, den = share
    held = {}

    def test(center, members):
        shingles = held.setdefault("s", Shingles(n))
        sets = [shingles(t) for t in center]
        out = []
        for b, text, *_ in members:
            s = shingles(text)
            for c in sets:
                if den * min(len(c), len(s)) >= num * max(len(c), len(s)):
                    both = len(np.intersect1d(c, s, assume_unique=True))
                    if both and den * both >= num * (len(c) + len(s) - both):
                        out.append((b,))
                        break
        return out

    return stars.compare(pairs, texts, test, [], "a long, b long")


class Tree:
    """A signature tree over leaves in order of size; level 0 are the leaves."""

    def __init__(self, size: np.ndarray, bits: np.ndarray, label: np.ndarray):
        self.levels = [(size, size, bits, bits, label)]
        while len(self.levels[-1][0]) > 1:
            lo, hi, every, some, label = self.levels[-1]
            at = np.arange(0, len(lo), FAN)
            least, most = np.minimum.reduceat(label, at), np.maximum.reduceat(label, at)
            self.levels.append((np.minimum.reduceat(lo, at), np.maximum.reduceat(hi, at), np.bitwise_and.reduceat(every, at, axis=0),
                                np.bitwise_or.reduceat(some, at, axis=0), np.where(least == most, least, -1)))

    def at(self, level: int):
        return self.levels[min(level, len(self.levels) - 1)]


def _may_link(one, two, share: tuple[int, int]) -> np.ndarray:
    """Whether sets below two nodes (least size, greatest size, AND and OR of the bitmaps) may
    link: slots that are odd in all sets of one and even in all of the other bound from below
    how many tokens only one of two sets has."""
    num, den = share
    (lo1, hi1, every1, some1), (lo2, hi2, every2, some2) = one, two
    differ = np.bitwise_count((every1 & ~some2) | (every2 & ~some1)).sum(1, dtype=np.int64)
    return (den * hi1 >= num * lo2) & (den * hi2 >= num * lo1) & ((num + den) * differ <= (den - num) * (hi1 + hi2))


def dual(a: Tree, b: Tree, share: tuple[int, int], chunk: int = 32_768):
    """(leaf of a, leaf of b) arrays that may link and don't have one label; each unordered
    pair once if a is b."""
    todo = [(max(len(a.levels), len(b.levels)) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while todo:
        level, i, j = todo.pop()
        if len(i) > chunk:
            todo += [(level, i[k:k + chunk], j[k:k + chunk]) for k in range(0, len(i), chunk)]
            continue
        *one, label1 = (x[i] for x in a.at(level))
        *two, label2 = (x[j] for x in b.at(level))
        ok = _may_link(one, two, share) & ((label1 < 0) | (label1 != label2))
        i, j = i[ok], j[ok]
        if not len(i):
            continue
        if level == 0:
            yield i, j
            continue
        i, j = _down(i, j, a, level)
        j, i = _down(j, i, b, level)
        if a is b:
            once = i < j if level == 1 else i <= j
            i, j = i[once], j[once]
        if len(i):
            todo.append((level - 1, i, j))


def _down(own: np.ndarray, other: np.ndarray, tree: Tree, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs with the children in ``own``'s place; a shorter tree waits at its root."""
    if level >= len(tree.levels):
        return own, other
    kids, other = (own[:, None] * FAN + np.arange(FAN)).ravel(), np.repeat(other, FAN)
    there = kids < len(tree.levels[level - 1][0])
    return kids[there], other[there]


def _trees(t: pa.Table, share: tuple[int, int], last: bool, out: list) -> pa.Table | None:
    """Traverse the tree, or pair of trees, of every group of ``t`` (each token, i and j in one
    run, sorted by own, n) into ``out``; but for ``last``, the final group is handed back unfinished.

    Groups of up to ``FAN`` rows are trees of one inner node; the leaf pairs of all of them
    are tested together."""
    key = np.stack([t.column(c).to_numpy() for c in ("token", "i", "j")])
    edge = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(0)) + 1
    start = np.concatenate([[0], edge]).astype(np.int64)
    end = np.concatenate([edge, [t.num_rows]]).astype(np.int64)
    rest = None
    if not last:
        rest = t.slice(int(start[-1])).combine_chunks()
        start, end = start[:-1], end[:-1]
    if not len(start):
        return rest
    node, comp, own = (t.column(c).to_numpy() for c in ("node", "comp", "own"))
    size = t.column("n").to_numpy().astype(np.int64)
    bits = np.frombuffer(b"".join(t.column("bits").to_pylist()), np.uint64).reshape(-1, WORDS)
    found = []
    count = end - start
    alone = key[1][start] == key[2][start]
    for k in range(2, FAN + 1):
        first = start[(count == k) & alone]
        if len(first):
            x, y = np.triu_indices(k, 1)
            i, j = (first[:, None] + x).ravel(), (first[:, None] + y).ravel()
            differ = comp[i] != comp[j]
            i, j = i[differ], j[differ]
            for c in range(0, len(i), 32_768):
                a, b = i[c:c + 32_768], j[c:c + 32_768]
                ok = _may_link((size[a], size[a], bits[a], bits[a]), (size[b], size[b], bits[b], bits[b]), share)
                found.append((a[ok], b[ok]))
    for g in np.flatnonzero((count > FAN) | ~alone).tolist():
        s, e = int(start[g]), int(end[g])
        _, label = np.unique(comp[s:e], return_inverse=True)
        if label.max() == 0:
            continue
        if alone[g]:
            tree = Tree(size[s:e], bits[s:e], label)
            found += [(x + s, y + s) for x, y in dual(tree, tree, share)]
        elif (cut := int(np.searchsorted(own[s:e], own[s], "right"))) < e - s:
            m = s + cut
            one, two = Tree(size[s:m], bits[s:m], label[:cut]), Tree(size[m:e], bits[m:e], label[cut:])
            found += [(x + s, y + m) for x, y in dual(one, two, share)]
    if found:
        x, y = (node[np.concatenate(c)] for c in zip(*found, strict=True))
        out.append(_once(np.stack([np.minimum(x, y), np.maximum(x, y)])))
    return rest


def _once(pairs: np.ndarray) -> np.ndarray:
    """Each column of ``pairs`` once."""
    pairs = pairs[:, np.lexsort(pairs[::-1])]
    return pairs[:, np.concatenate([[True], (pairs[:, 1:] != pairs[:, :-1]).any(0)])] if pairs.shape[1] else pairs


def parts(mixed: DataFrame) -> DataFrame:
    """``mixed`` (t, n_nodes, lead: the token's smallest node) with ``part``: the tokens of one
    lead in parts that have ``PART`` blocks' rows on average, or one token."""
    size = F.least("n_nodes", F.lit(2 * BLOCK))
    rows = mixed.groupBy("lead").agg(F.ceil(F.sum(size) / (PART * BLOCK)).alias("parts")).select(F.col("lead").alias("pl"), "parts")
    return mixed.join(rows, F.col("lead") == F.col("pl")).select("t", "n_nodes", F.xxhash64("lead", F.pmod(F.xxhash64("t"), "parts")).alias("part"))


def candidates(rows: DataFrame, share: tuple[int, int]) -> DataFrame:
    """(a, b) from ``rows`` (token, n_nodes, part, node, comp, n, bits): the signature trees' pairs.

    Tokens with more than ``BLOCK`` nodes on average a block are dealt in blocks; the pair of
    blocks (i, j) is a group of its own.  The groups of a part stand together, so their
    common pairs are seen soon after each other."""
    blocks = F.ceil(F.col("n_nodes") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("node"), blocks).cast("int")
    dealt = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1))) \
        .select("token", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "comp", "n", "bits", "part")
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = dealt.repartition(n, "part", "i", "j").sortWithinPartitions("part", "i", "j", "token", "own", "n", "node").drop("part")

    def run(batches):
        held, wait, new = None, np.empty((2, 0), np.int64), []  # the last, perhaps unfinished group; pairs held back
        for b in batches:
            t = pa.Table.from_batches([b])
            held = _trees(pa.concat_tables([held, t]) if held is not None else t, share, False, new)
            if wait.shape[1] + sum(p.shape[1] for p in new) > PAIRS:
                wait, new = _once(np.concatenate([wait, *new], axis=1)), []
                if wait.shape[1] > PAIRS // 2:
                    yield _pairs(wait)
                    wait = wait[:, :0]
        if held is not None:
            _trees(held, share, True, new)
        yield _pairs(_once(np.concatenate([wait, *new], axis=1)))

    return C.map_batches(dealt, run, "a long, b long").where("a <> b").distinct()


def _pairs(pairs: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["a", "b"])


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = SHINGLE, share: tuple[int, int] = SHARE) -> DataFrame:
    """(id, n_shingles, component_id) for every document."""
    spark = docs.sparkSession
    scratch = C.Scratch(spark, "setjoin")
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), C.text_bytes(text_col).alias("text"))
    texts = rows.select(F.col("doc").alias("node"), "text")
    sets = scratch.table(sets_of(rows, n, share), "sets")

    # 1. equal sets
    same = sets.where("n > 0").groupBy("h1", "h2", "n").agg(F.min("doc").alias("node")).where("node IS NOT NULL")
    key = same.select(F.col("h1").alias("k1"), F.col("h2").alias("k2"), F.col("n").alias("kn"), "node")
    nodes = scratch.table(sets.where("n > 0").select("doc", "n", "h1", "h2").join(
        key, (F.col("h1") == F.col("k1")) & (F.col("h2") == F.col("k2")) & (F.col("n") == F.col("kn"))).select("doc", "n", "h1", "h2", "node"), "nodes")
    reps = sets.join(nodes.where("doc = node").select(F.col("doc").alias("rep"), F.col("h1").alias("k1"), F.col("h2").alias("k2")).distinct(),
                     (F.col("doc") == F.col("rep")) & (F.col("h1") == F.col("k1")) & (F.col("h2") == F.col("k2")))
    several = nodes.where("doc IS NOT NULL").groupBy("doc").agg(F.min("node").alias("b"), F.max("node").alias("a")).where("a > b").select("a", "b")

    # 2. cheap links
    low = reps.select(F.col("doc").alias("b"), F.explode("low").alias("h"))
    head = low.groupBy("h").agg(F.min("b").alias("a"), F.max("b").alias("last")).where("a < last").select(F.col("h").alias("hh"), "a")
    star = scratch.table(low.join(head, F.col("h") == F.col("hh")).where("a <> b").select("a", "b").distinct(), "star")
    links = scratch.table(linked(star, texts, n, share).distinct().union(several.select("b", "a")), "links-1")
    first = scratch.table(C.components(spark, links.select("a", "b"), scratch, "comp-1"), "first")

    # 3. links between components
    C.free_shuffles(spark)  # of the compared texts, before the posted tokens are dealt
    posts = reps.select(F.col("doc").alias("node"), F.explode("prefix").alias("token"))
    shared = posts.groupBy("token").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select(F.col("token").alias("t"), "times")
    own = Window.partitionBy("node")
    sizes = reps.select(F.col("doc").alias("sn"), "n")
    rarest = posts.join(shared, F.col("token") == F.col("t")).join(sizes, F.col("node") == F.col("sn")) \
        .select("token", "node", "n", F.count(F.lit(1)).over(own).alias("has"), F.row_number().over(own.orderBy("times", "token")).alias("place")) \
        .where(F.col("place") <= F.col("has") - least_common(F.col("n"), share) + 1)
    comp = first.select(F.col("node").alias("cn"), "component")
    met = scratch.table(rarest.join(comp, F.col("node") == F.col("cn"), "left")
                        .select("token", "node", F.coalesce("component", "node").alias("comp")), "met")
    C.free_shuffles(spark)
    mixed = met.groupBy("token").agg(F.min("comp").alias("least"), F.max("comp").alias("most"), F.min("node").alias("lead"), F.count(F.lit(1)).alias("n_nodes")) \
        .where("least < most").select(F.col("token").alias("t"), "n_nodes", "lead")
    marks = reps.select(F.col("doc").alias("d"), "n", "bits")
    leaves = met.join(parts(scratch.table(mixed, "mixed")), F.col("token") == F.col("t")).join(marks, F.col("node") == F.col("d")) \
        .select("token", "n_nodes", "part", "node", "comp", "n", "bits")
    done = star.select(F.col("a").alias("da"), F.col("b").alias("db"))
    pairs = scratch.table(candidates(leaves, share).join(done, (F.col("a") == F.col("da")) & (F.col("b") == F.col("db")), "left_anti"), "pairs")
    scratch.drop("met", "mixed")
    more = linked(pairs, texts, n, share)

    # 4. components
    all_links = scratch.table(links.select("a", "b").union(more).distinct(), "links-2")
    comp = scratch.table(C.components(spark, all_links, scratch, "comp-2"), "component")
    out = sets.select("doc", "n", "h1", "h2").join(key, (F.col("h1") == F.col("k1")) & (F.col("h2") == F.col("k2")) & (F.col("n") == F.col("kn")), "left") \
        .join(comp.select(F.col("node").alias("cn"), "component"), F.col("node") == F.col("cn"), "left")
    return out.select(F.col("doc").alias(id_col), F.col("n").cast("long").alias("n_shingles"),
                      F.coalesce("component", "node", "doc").alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The documents but one of each component: the one whose id is the component's; rows
    without a component, or with a text of no words, stay; of rows with equal id, all."""
    found = join(docs, id_col, text_col, **how)
    gone, mark = C.fresh(docs, "gone_id", "gone_mark")
    drop = found.where(f"component_id <> {id_col} AND n_shingles > 0").select(F.col(id_col).alias(gone)).distinct()
    return docs.join(drop.hint("shuffle_hash"), F.col(id_col) == F.col(gone), "left_anti")
