"""Line runs, set joins and passages: against brute force and SQL."""

import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from shoal.llm import common as C
from shoal.llm import lines, oracles, passages, queries, setjoin

SF = "/root/testdata/sf0.001"


def sf_texts():
    return duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet' ORDER BY 1").fetchall()


def shingles(text):
    w = C.lower_words((text or "").encode())
    return {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def brute_components(rows):
    """{id: (set size, component)} of (id, text) rows by comparing all pairs."""
    sets = [(i, shingles(t)) for i, t in rows]
    par = {i: i for i, _ in rows if i is not None}

    def find(x):
        while par[x] != x:
            x = par[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            both = len(a & b)
            if i is not None and j is not None and both and 100 * both >= 80 * (len(a) + len(b) - both):
                x, y = find(i), find(j)
                par[max(x, y)] = min(x, y)
    return {(i, len(s), None if i is None else find(i)) for i, s in sets}


def near_copies(seed, groups=12, most=25, words=60):
    rnd = random.Random(seed)
    vocab = [f"v{k}" for k in range(3000)]
    head = "a common heading line that many of the texts begin with".split()
    rows, i = [], 0
    for _ in range(groups):
        base = head + [rnd.choice(vocab) for _ in range(rnd.randint(20, words))]
        for _ in range(rnd.randint(1, most)):
            w = list(base)
            for _ in range(rnd.randint(0, 4)):
                w[rnd.randrange(len(w))] = rnd.choice(vocab)
            rows.append((i, " ".join(w)))
            i += 1
    rnd.shuffle(rows)
    return rows


def test_jaccard_join_finds_every_link(spark):
    rows = near_copies(5)
    got = setjoin.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {tuple(r) for r in got} == brute_components(rows)


def test_jaccard_join_on_documents(spark):
    assert {tuple(r) for r in queries.op7_jaccard_join(spark, SF).collect()} == brute_components(sf_texts())


def test_jaccard_join_in_blocks_without_cheap_links(spark, monkeypatch):
    # tokens' nodes are split into many blocks, and the trees have to find every link
    monkeypatch.setattr(setjoin, "BLOCK", 3)
    monkeypatch.setattr(setjoin, "FAN", 2)
    real = setjoin.sets_of
    monkeypatch.setattr(setjoin, "sets_of", lambda *a: real(*a).withColumn("low", F.array().cast("array<long>")))
    rows = near_copies(9, groups=4, most=30, words=30)
    got = setjoin.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {tuple(r) for r in got} == brute_components(rows)


@pytest.mark.parametrize("words", [1500, 4000])
def test_unlinked_pairs_are_named_once_at_most(spark, monkeypatch, words):
    # texts that have three quarters in common meet under hundreds of tokens
    rnd = random.Random(words)
    base = [f"b{k}" for k in range(3 * words // 4)]
    rows = [(i, " ".join([*base, *(f"w{rnd.randrange(10**9)}" for _ in range(words - len(base)))])) for i in range(24)]
    rows += [(50, rows[3][1].replace("b700 ", "c ")), (51, rows[9][1] + " tail")]
    real, made = C.map_batches, []

    def counted(df, fn, schema):
        out = real(df, fn, schema)
        if schema == "a long, b long" and "token" in df.columns:
            made.append(out.count())
        return out

    monkeypatch.setattr(C, "map_batches", counted)
    got = setjoin.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {tuple(r) for r in got} == brute_components(rows)
    assert len(made) == 1 and made[0] <= 26 * 25 // 2


def test_jaccard_join_cases(spark):
    long = " ".join(f"z{k}" for k in range(30_000))
    rows = [(1, None), (2, ""), (3, " \n"), (4, "one two"), (5, "One  TWO"), (6, "one two three"), (7, long), (8, long + " tail"),
            (9, "p q r s t u v"), (9, "p q r s t u v"), (10, long), (None, "p q r s t u v"), (None, "only null id here at all")]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, n int, component_id int")
    got = sorted((tuple(r) for r in setjoin.join(df).collect()), key=str)
    want = [(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 1, 4), (6, 1, 6), (7, 29_996, 7), (8, 29_997, 7), (9, 3, 9), (9, 3, 9),
            (10, 29_996, 7), (None, 3, 9), (None, 2, None)]
    assert got == sorted(want, key=str)
    kept = setjoin.keep_one(df)
    assert kept.columns == df.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [1, 2, 3, 4, 6, 7, 9, 9] and ids.count(None) == 2
    assert setjoin.join(df.limit(0)).count() == 0


def test_linked_sets_post_enough_common_tokens(spark):
    rng = np.random.default_rng(6)
    worst = 0
    for _ in range(400):
        n = int(rng.integers(1, 120))
        x = np.unique(rng.integers(1, 1 << 40, n))
        miss = int(rng.integers(0, max(1, len(x) // 5 + 1)))
        y = np.sort(np.concatenate([rng.permutation(x)[miss:], rng.integers(1, 1 << 40, int(rng.integers(0, len(x) // 4 + 1)))]))
        x, y = np.sort(x), np.unique(y)
        both = len(np.intersect1d(x, y))
        if both and 100 * both >= 80 * (len(x) + len(y) - both):
            c = len(np.intersect1d(x[:setjoin.posted(len(x), (80, 100))], y[:setjoin.posted(len(y), (80, 100))]))
            for s in (x, y):
                assert c >= 20 * -(-len(s) * 80 // 100) // 200 + 1
            worst += 1
    assert worst > 100
    got = spark.range(1, 300).select("id", setjoin.least_common(F.col("id"), (80, 100)).alias("k")).collect()
    assert all(r["k"] == 20 * -(-r["id"] * 80 // 100) // 200 + 1 for r in got)


def test_signature_tree_traversal_is_complete():
    rng = np.random.default_rng(2)
    for m in (1, 7, 8, 9, 70):
        base = rng.choice(5000, 80, replace=False)
        sets = [np.unique(np.concatenate([rng.choice(base, rng.integers(60, 80), replace=False), rng.choice(9000, rng.integers(0, 12))])) for _ in range(m)]
        sets.sort(key=len)
        tokens = [C.mix(s.astype(np.uint64)) for s in sets]
        bits = np.stack([np.frombuffer(setjoin.signature(t).tobytes(), np.uint64) for t in tokens])
        tree = setjoin.Tree(np.array([len(s) for s in sets]), bits, np.arange(m))
        found = {(int(x), int(y)) for i, j in setjoin.dual(tree, tree, (80, 100), chunk=50) for x, y in zip(i, j, strict=True)}
        for x in range(m):
            for y in range(x + 1, m):
                both = len(np.intersect1d(sets[x], sets[y]))
                if 100 * both >= 80 * (len(sets[x]) + len(sets[y]) - both):
                    assert (x, y) in found
        assert all(x < y for x, y in found)
    same = setjoin.Tree(np.array([5, 5]), np.ones((2, setjoin.WORDS), np.uint64), np.array([1, 1]))
    assert not list(setjoin.dual(same, same, (80, 100)))


def test_components(spark):
    from shoal.llm.common import Scratch

    chain = [(k, k + 1) for k in range(100, 140)] + [(7, 500), (500, 501), (1, 7), (300, 300), (None, 4)]
    got = C.components(spark, spark.createDataFrame(chain, "a long, b long"), Scratch(spark, "test"), "c").collect()
    want = {k: 100 for k in range(100, 141)} | {1: 1, 7: 1, 500: 1, 501: 1}
    assert {r["node"]: r["component"] for r in got} == want


def test_line_dedup_against_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    rel = con.execute(oracles.ORACLES["op6_line_dedup"])
    names = [d[0] for d in rel.description]
    want = sorted(tuple(r) for r in rel.fetchall())
    assert sorted(tuple(r[n] for n in names) for r in queries.op6_line_dedup(spark, SF).collect()) == want


@pytest.mark.parametrize("least", [1, 2, 3])
def test_line_runs_against_brute_force(spark, least):
    rnd = random.Random(least)
    docs = []
    for i in range(14):
        seq = [rnd.choice("abcde") for _ in range(rnd.randint(0, 9))]
        docs.append((i, "\n".join(x if rnd.random() < 0.8 else x + "\n \n" for x in seq)))
    docs += [(20, "\n".join("ab" * 40)), (21, "\n".join("ab" * 40)), (None, "q\nr\ns"), (22, "q\nr\ns"), (23, None), (24, ""), (25, "only"), (26, "\n\n")]
    df = spark.createDataFrame([(*d, 1, 2) for d in docs], "doc_id long, text string, doc int, gone int")
    got = {r["doc_id"]: r["text"] for r in lines.LineRuns(df).cleaned(least).collect()}
    seen, want = set(), {}
    for i, text in sorted(docs, key=lambda d: (d[0] is not None, d[0])):
        if text is None:
            want[i] = None
            continue
        raw = text.split("\n")
        at = [k for k, x in enumerate(raw) if x.strip()]
        gone = set()
        for p in range(len(at) - least + 1):
            w = tuple(raw[k] for k in at[p:p + least])
            if w in seen:
                gone.update(at[p:p + least])
            seen.add(w)
        want[i] = "\n".join(x for k, x in enumerate(raw) if k not in gone)
    assert got == want
    assert lines.LineRuns(df).cleaned(least).columns == df.columns
    assert lines.LineRuns(df.limit(0)).cleaned(least).count() == 0


def test_line_dedup_runs_no_python(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    plan = lines.LineRuns(df).cleaned()._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_equal_rows_are_one_document(spark):
    df = spark.createDataFrame([(1, "a\nb"), (1, "a\nb"), (1, "a\nb\nc"), (2, "x\na\nb")], "doc_id long, text string")
    got = sorted((r["doc_id"], r["text"]) for r in lines.LineRuns(df).cleaned().collect())
    assert got[0][1] == got[1][1] or got[1][1] == got[2][1]
    assert sum(t.startswith("a\nb") for _, t in got) in (1, 2) and got[-1] == (2, "x")


def test_compact_windows_are_the_cartesian_tree():
    rng = np.random.default_rng(4)
    for h in (rng.integers(0, 1 << 60, 200).astype(np.uint64), np.zeros(300, np.uint64), rng.integers(0, 4, 150).astype(np.uint64)):
        wins = passages.compact_windows(h, 20)
        for s in range(len(h) - 19):  # every passage of 20 lies in exactly one node that holds its minimum
            holders = [(a, c, b) for a, c, b in wins if a <= s <= c <= s + 19 <= b]
            assert len(holders) == 1 and h[holders[0][1]] == h[s:s + 20].min()
        assert len(wins) <= len(h)


def test_planted_passages_are_found(spark):
    rnd = random.Random(8)
    word = lambda n: [f"k{rnd.randrange(10**6)}" for _ in range(n)]
    passage, other = word(60), word(80)
    docs = [(i, word(100) + passage + word(rnd.randint(0, 90))) for i in range(5)]
    near = list(other)
    near[40] = "edited"
    docs += [(10, word(30) + other), (11, near + word(200)), (12, word(300)), (13, word(20) + passage[:40] + word(30))]
    rows = [(i, " ".join(w)) for i, w in docs] + [(14, " ".join(docs[7][1])), (15, "x y"), (16, None), (17, ""), (None, " ".join(passage))]
    df = spark.createDataFrame([(*r, "s") for r in rows], "doc_id long, text string, spans string")
    got = {r["doc_id"]: r for r in passages.per_document(df).collect()}
    for i in range(1, 5):
        (s,) = got[i]["spans"]
        assert (s["start"], s["end"], s["source"], s["source_start"], s["source_end"]) == (100, 160, 0, 100, 160) and got[i]["class_id"] == 0
    (s,) = got[11]["spans"]
    assert s["source"] == 10 and s["start"] <= 3 and s["end"] >= 77
    assert [tuple(x) for x in got[14]["spans"]] == [(0, 300, 12, 0, 300)] and got[14]["class_id"] == 12
    assert all(got[i]["n_spans"] == 0 and got[i]["class_id"] == i for i in (13, 15, 16, 17)) and got[0]["n_spans"] == 0
    cut = {r["doc_id"]: r["text"] for r in passages.cut(df).collect()}
    assert "".join(passage) not in (cut[2] or "").replace(" ", "") and cut[0] == rows[0][1] and cut[16] is None and cut[14] == ""
    assert passages.cut(df).columns == df.columns
    assert passages.per_document(df.limit(0)).count() == 0


def test_exact_repeats_of_the_documents_are_covered(spark):
    words = {i: C.lower_words((t or "").encode()) for i, t in sf_texts()}
    seen, want = {}, {}
    for i, w in words.items():
        mine = {tuple(w[k:k + 50]): k for k in range(len(w) - 49)}
        for k in (k for k in range(len(w) - 49) if tuple(w[k:k + 50]) in seen):
            want.setdefault(i, set()).update(range(k, k + 50))
        seen.update(dict.fromkeys(mine, i))
    got = {r["doc_id"]: {p for s in r["spans"] or [] for p in range(s["start"], s["end"])} for r in queries.op8_substring_dedup(spark, SF).collect()}
    assert want and all(len(p & got[i]) >= 0.9 * len(p) for i, p in want.items())


def test_no_near_copy_at_the_threshold_is_left_out(spark):
    # one word of 54 replaced: 45 of 55 shingles are common, similarity 0.818
    rnd = random.Random(3)
    rows = []
    for k in range(300):
        w = [f"t{rnd.randrange(10**6)}" for _ in range(54)]
        rows += [(2 * k, " ".join(w)), (2 * k + 1, " ".join([*w[:27], "edited", *w[28:]]))]
    got = passages.per_document(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == {i: i - i % 2 for i in range(600)}


def test_tokens_are_dealt_in_blocks_and_repeated_ones_marked(spark, monkeypatch):
    rnd = random.Random(11)
    docs = [[f"u{rnd.randrange(10**9)}" for _ in range(5000)] for _ in range(30)]
    for k in range(1, 30, 2):
        docs[k][100:160] = docs[k - 1][300:360]
    docs.append(["same"] * 90)
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(docs)], "doc_id long, text string").repartition(4).persist()
    tokens = [set(C.window_hashes(C.word_hashes(C.lower_words(" ".join(w).encode())), 5).tolist()) for w in docs]
    seen = {}
    for t in tokens:
        for x in t:
            seen[x] = seen.get(x, 0) + 1
    every = np.array(list(seen), np.uint64)
    bits = passages.repeated_tokens(df.select(C.text_bytes().alias("text")))
    mark = passages.marked(every, bits) > 0
    often = np.array([seen[x] > 1 for x in every.tolist()])
    assert often.sum() == 15 * 56 and mark[often].all() and mark.sum() <= often.sum() + 20
    real, made = C.map_batches, []

    def counted(df, fn, schema):
        out = real(df, fn, schema)
        made.append(out.count())
        return out

    monkeypatch.setattr(C, "map_batches", counted)
    got = {r["doc_id"]: r["class_id"] for r in passages.per_document(df).collect()}
    assert got == {i: min(i - i % 2, 30) for i in range(31)}
    assert sum(made) < sum(len(t) for t in tokens)


def test_dense_passages_against_brute_force():
    rng = np.random.default_rng(7)
    least = passages.shortest()
    for kinds, odds in ((10**6, 0.8), (10**6, 0.7), (25, 0.8), (3, 0.9)):
        tokens = C.mix(rng.integers(0, kinds, 90).astype(np.uint64))
        known = {t: rng.random() < odds for t in dict.fromkeys(tokens.tolist())}
        mark = np.array([known[t] for t in tokens.tolist()], np.uint8)
        may, need = passages.dense(tokens, mark)
        for s in range(len(tokens)):
            for e in range(s + least, len(tokens) + 1):
                here = set(tokens[s:e].tolist())
                if 100 * sum(not known[t] for t in here) <= 20 * len(here):
                    assert may[s:e].all() and 0 < need <= -(-80 * len(here) // 100)
