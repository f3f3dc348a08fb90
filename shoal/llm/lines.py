"""Line deduplication by a distributed suffix array over line-ID sequences.

Every document is a sequence of line IDs (its lines with a word; blank lines are passed
over and stay).  Prefix doubling names the runs of 1, 2, 4, ... lines: a level's names
are ranks, taken by one range-partitioned sort of the distinct (rank, rank) pairs of the
level below, so they order the suffixes.  A run found once is dropped from the next
level, as no longer run from there can repeat; what remains shrinks from level to level.
Cutting the suffix array where the common prefix falls below ``min_lines`` leaves its
intervals: the groups of equal windows of ``min_lines`` lines.  Each later member's
longest common prefix with the first is found by going down the levels again; those that
can't be extended to the left are the maximal repeated runs.

A run of ``min_lines`` or more lines is deleted wherever it isn't its first copy, in order
of (document, line).

DataFrame operations only.  Groups are counted with map-side aggregation, joins that meet
a hot line have one row per name on the other side, so adaptive skew joins split them.

Cases: a null text stays null and has no lines; an empty or blank text is unchanged; lines
are compared as they are; rows with equal id and equal text are one document and get the
same result, rows with equal id and different texts are ordered by a hash of the text; a
null id comes first; an empty table gives an empty result; further columns are returned as
they are, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoal.llm import common as C

MIN_LINES = 1  # a repeated line alone is a run, too
KEY = ["doc", "th", "pos"]


def line_table(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, th, pos, line_no, h1, h2): every line with a word, numbered within its document."""
    lines = F.filter(
        F.transform(F.split(F.col("text"), "\n"), lambda x, i: F.struct(i.alias("no"), x.alias("x"))),
        lambda s: F.length(F.btrim(s["x"], F.lit(" \t\x0b\f\r"))) > 0)
    rows = docs.select(F.col(id_col).alias("doc"), F.xxhash64(text_col).alias("th"), F.col(text_col).alias("text")) \
        .where("text IS NOT NULL").select("doc", "th", F.posexplode(lines).alias("pos", "line"))
    x = F.col("line.x")
    return rows.select("doc", "th", "pos", F.col("line.no").alias("line_no"), F.xxhash64(x).alias("h1"),
                       F.xxhash64(F.lit("line"), x).alias("h2")).dropDuplicates(KEY)


def ranked(pairs: DataFrame) -> DataFrame:
    """(a, b, rank) of the pairs found twice or more; ranks keep the pairs' order.

    A range-partitioned sort numbers its rows within each partition, above the
    partition's own number: no count passes and no single task."""
    keys = pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("a", "b")
    n = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return keys.repartitionByRange(n, "a", "b").sortWithinPartitions("a", "b") \
        .withColumn("rank", F.monotonically_increasing_id())


def named(pairs: DataFrame, ranks: DataFrame) -> DataFrame:
    r = ranks.select(F.col("a").alias("ra"), F.col("b").alias("rb"), "rank")
    return pairs.join(r, (F.col("a") == F.col("ra")) & (F.col("b") == F.col("rb"))).select(*KEY, "rank")


def at(table: DataFrame, shift, rank: str) -> DataFrame:
    """A level's rows moved back by ``shift`` lines, under other names for a join."""
    return table.select(F.col("doc").alias("d2"), F.col("th").alias("t2"), (F.col("pos") - shift).alias("p2"), F.col("rank").alias(rank))


def same_place(pos):
    return F.col("doc").eqNullSafe(F.col("d2")) & (F.col("th") == F.col("t2")) & (pos == F.col("p2"))


class LineRuns:
    """The repeated line runs of ``docs``; ``levels[k]`` has the names of repeated runs of 2^k lines."""

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"):
        self.docs, self.id_col, self.text_col = docs, id_col, text_col
        self.scratch = C.Scratch(docs.sparkSession, "lines")
        self.lines = self.scratch.table(line_table(docs, id_col, text_col), "lines")
        pairs = self.lines.select(*KEY, F.col("h1").alias("a"), F.col("h2").alias("b"))
        self.levels = [self.scratch.table(named(pairs, ranked(pairs)), "level-0")]
        while True:
            k = len(self.levels)
            low = self.levels[-1]
            pairs = low.join(at(low, F.lit(1 << (k - 1)), "b"), same_place(F.col("pos"))).select(*KEY, F.col("rank").alias("a"), "b")
            up = self.scratch.table(named(pairs, ranked(pairs)), f"level-{k}")
            if up.isEmpty():
                break
            self.levels.append(up)

    def windows(self, n: int) -> DataFrame | None:
        """(doc, th, pos, a, b): windows of ``n`` lines that repeat or may; (a, b) names them
        (two overlapping runs of a power of two cover them).  None if no run is as long."""
        k = n.bit_length() - 1
        if k >= len(self.levels):
            return None
        t = self.levels[k]
        return t.join(at(t, F.lit(n - (1 << k)), "b"), same_place(F.col("pos"))).select(*KEY, F.col("rank").alias("a"), "b")

    def runs(self, min_lines: int = MIN_LINES) -> DataFrame:
        """(doc, th, pos, n, first): every left-maximal later copy of a repeated run: its
        place, its length in lines and where the first copy begins.

        Equal windows of ``min_lines`` lines are a group; its smallest place is the first
        copy.  The length is the longest common prefix with it, found level by level from
        the names of the longest runs down."""
        win = self.windows(min_lines)
        if win is None:
            return self.levels[0].select(*KEY, F.lit(0).alias("n"), F.struct(*KEY).alias("first")).where(F.lit(False))
        # a table of its own, so that the join below is one that hot windows are split in
        first = self.scratch.table(win.groupBy("a", "b").agg(F.min(F.struct(*KEY)).alias("first"))
                                   .select(F.col("a").alias("ra"), F.col("b").alias("rb"), "first"), "first")
        late = self.scratch.table(
            win.join(first, (F.col("a") == F.col("ra")) & (F.col("b") == F.col("rb")))
            .where(~F.struct(*KEY).eqNullSafe(F.col("first"))).select(*KEY, "first"), "late")
        before = late.select(F.col("doc").alias("d2"), F.col("th").alias("t2"), (F.col("pos") + 1).alias("p2"),
                             F.col("first").withField("pos", F.col("first.pos") + 1).alias("f2"))
        state = late.join(before, same_place(F.col("pos")) & F.col("first").eqNullSafe(F.col("f2")), "left_anti") \
            .withColumn("n", F.lit(0))
        for k in range(len(self.levels) - 1, -1, -1):
            mine = at(self.levels[k], F.lit(0), "r")
            its = mine.select(F.struct(F.col("d2").alias("doc"), F.col("t2").alias("th"), F.col("p2").alias("pos")).alias("f2"), F.col("r").alias("fr"))
            there = F.col("first").withField("pos", F.col("first.pos") + F.col("n"))
            state = state.join(mine, same_place(F.col("pos") + F.col("n")), "left").drop("d2", "t2", "p2") \
                .join(its, there.eqNullSafe(F.col("f2")), "left") \
                .select(*KEY, "first", (F.col("n") + F.when(F.col("r") == F.col("fr"), 1 << k).otherwise(0)).alias("n"))
        return self.scratch.table(state, "runs")

    def cleaned(self, min_lines: int = MIN_LINES, marks: bool = False) -> DataFrame:
        """The documents, later copies of repeated runs deleted from their texts.

        With ``marks``, also ``n_lines``, ``n_deleted`` and ``longest_run`` (in lines, of
        the later copies that start in the document)."""
        runs = self.runs(min_lines)
        gone = _moved(runs.select("doc", "th", F.explode(F.sequence("pos", F.col("pos") + F.col("n") - 1)).alias("pos")).distinct())
        per = self.lines.join(gone, same_place(F.col("pos"))).groupBy("doc", "th").agg(F.collect_list("line_no").alias("gone"))
        if marks:
            same = lambda p: F.col("doc").eqNullSafe(F.col(f"{p}_doc")) & (F.col("th") == F.col(f"{p}_th"))
            per = self.lines.groupBy("doc", "th").agg(F.count(F.lit(1)).alias("n_lines")) \
                .join(_as(per, "g"), same("g"), "left") \
                .join(_as(runs.groupBy("doc", "th").agg(F.max("n").alias("longest_run")), "r"), same("r"), "left") \
                .select("doc", "th", "gone", "n_lines", "longest_run")
        names = C.fresh(self.docs, "doc", "th", "gone", "n_lines", "longest_run", "hash")
        per = per.select(*(F.col(o).alias(n) for o, n in zip(("doc", "th", "gone", "n_lines", "longest_run"), names, strict=False) if o in per.columns))
        doc, th, gone_col, n_lines, run, hashed = names
        whole = self.docs.withColumn(hashed, F.xxhash64(self.text_col)).join(
            per.hint("shuffle_hash"), F.col(self.id_col).eqNullSafe(F.col(doc)) & (F.col(hashed) == F.col(th)), "left")
        # a one-element transform binds the split lines once
        text = F.transform(F.array(F.split(F.col(self.text_col), "\n")), lambda x: F.array_join(F.transform(
            F.array_except(F.sequence(F.lit(0), F.size(x) - 1), F.col(gone_col)), lambda i: F.get(x, i)), "\n"))[0]
        out = [F.when(F.size(gone_col) > 0, text).otherwise(F.col(c)).alias(c) if c == self.text_col else F.col(c) for c in self.docs.columns]
        if not marks:
            return whole.select(*out)
        none = F.lit(0).cast("long")
        return whole.select(*out, F.coalesce(F.col(n_lines), none).alias("n_lines"),
                            F.when(F.col(gone_col).isNull(), none).otherwise(F.size(gone_col).cast("long")).alias("n_deleted"),
                            F.coalesce(F.col(run).cast("long"), none).alias("longest_run"))


def _moved(df: DataFrame) -> DataFrame:
    """The place columns under other names, for a join."""
    return df.withColumnsRenamed({"doc": "d2", "th": "t2", "pos": "p2"})


def _as(df: DataFrame, p: str) -> DataFrame:
    return df.select(F.col("doc").alias(f"{p}_doc"), F.col("th").alias(f"{p}_th"), *(c for c in df.columns if c not in ("doc", "th")))
