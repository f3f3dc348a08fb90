"""Fill-in-the-middle against slices taken unit by unit."""

import hashlib
import re

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st

from shoal.llm import infill, oracles, queries

SF = "/root/testdata/sf0.001"


def test_query_against_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    df = queries.QUERIES["op13_fill_in_middle"](spark, SF)
    rel = con.execute(oracles.ORACLES["op13_fill_in_middle"])
    at = [[d[0] for d in rel.description].index(c) for c in df.columns]
    key = lambda r: r[0]
    assert sorted(map(tuple, df.collect()), key=key) == sorted((tuple(r[i] for i in at) for r in rel.fetchall()), key=key)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=700), st.integers(0, 800))
def test_descent_reaches_every_rank(widths, rank):
    nodes = infill.SkipList(widths)
    at = min(rank, len(widths))
    assert nodes.descend(rank) == (at, sum(widths[:at]))
    units, chars = nodes.descend(rank * 7, by=1)
    assert chars == sum(widths[:units]) <= rank * 7 and (units == len(widths) or chars + widths[units] > rank * 7)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab\n <PSM>é🙂", max_size=200), st.integers(0, 50), st.sampled_from(["lines", "words", "characters"]))
def test_cut_and_restore(text, doc_id, unit):
    how = infill.Infill(units=getattr(infill, unit))
    n, form, prefix, middle, out = how.cut(doc_id, text)
    assert how.restore(form, out) == text and sum(how.units(text)) == len(text)
    if unit == "lines":
        assert how.units(text) == [len(x) for x in re.findall(r"[^\n]*\n|[^\n]+", text)]
    if form == infill.PLAIN:
        assert out == text and (not text or re.search("<[PSM]>", text))
    else:
        assert prefix + middle <= len(text) and len(out) == len(text) + 9


def test_cases(spark):
    texts = [(1, ""), (2, None), (3, "has <S> inside\nx"), (4, "\n\n\n"), (5, "one line"), (5, "one line"), (None, "null id\nb\nc"),
             (7, "é🙂\n" * 50_000), (8, "no end " * 100_000)]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in texts], "doc_id long, text string, form string, n int")
    got = infill.restored(infill.transform(df)).collect()
    assert [(r["doc_id"], r["restored"]) for r in got] == [(i, t or "") for i, t in texts]
    assert [r["form"] == infill.PLAIN for r in got] == [True, True, True] + [False] * 6
    assert got[4]["output"] == got[5]["output"] and [r["n"] for r in got] == [0, 0, 2, 3, 1, 1, 3, 50_000, 1]
    h = hashlib.sha256(b"7:7").hexdigest()
    low, high = sorted(int(h[i:i + 8], 16) % 50_001 for i in (0, 8))
    assert (got[7]["prefix_chars"], got[7]["middle_chars"]) == (low * 3, (high - low) * 3)
    assert infill.digests(df.limit(0)).count() == 0
    none = infill.transform(df, infill.Infill(rate=0)).collect()
    assert all(r["form"] == infill.PLAIN for r in none)
