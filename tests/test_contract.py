"""Contract rows: one hand-written input per edge case, per function."""

import json

import pytest
from pyspark.sql import functions as F

from shoal.functions import jsonfn as J
from shoal.functions import timefn as T


def one(spark, text, expr):
    df = spark.createDataFrame([(text,)], "value string").select(J.parse_doc("value").alias("doc"))
    return df.select(expr("doc").alias("r")).collect()[0]["r"]


@pytest.mark.parametrize(
    "doc,key,expected",
    [
        ('{"z":{"mac":"m1"}}', "mac", "m1"),  # nested find
        ('{"mac":{"x":1}}', "mac", None),  # an object is no match
        ('{"a":[{"mac":"m1"}]}', "mac", None),  # arrays are not searched
        ('{"mac":"top","a":{"mac":"nest"}}', "mac", "nest"),  # sorted keys, depth first
        ('{"a":{"mac":null},"b":{"mac":"m1"}}', "mac", "m1"),  # a null match is skipped
        ('{"a":[1,2]}', "a", "[1,2]"),  # arrays are values, as JSON text
        ('{"n":12}', "n", "12"),
        ('[1]', "mac", None),  # non-object root
        ('{bad', "mac", None),  # malformed
    ],
)
def test_find(spark, doc, key, expected):
    assert one(spark, doc, lambda d: J.json_find(d, key)) == expected


def test_find_null_document(spark):
    df = spark.createDataFrame([(None,)], "value string")
    r = df.select(J.parse_doc("value").alias("doc")).select(J.json_has("doc", "mac").alias("r")).collect()[0]["r"]
    assert r is False


def test_duplicate_keys_last_wins(spark):
    assert one(spark, '{"a":1,"a":2}', lambda d: J.json_find(d, "a")) == "2"


def test_put_overwrites(spark):
    out = one(spark, '{"hour":"01"}', lambda d: J.doc_to_json(J.json_put(d, {"hour": "07"})))
    assert json.loads(out) == {"hour": "07"}


def test_replace_nested_not_arrays(spark):
    out = one(spark, '{"o":{"hw_type":1},"a":[{"hw_type":2}]}',
              lambda d: J.doc_to_json(J.json_replace(d, "hw_type", "v7")))
    assert json.loads(out) == {"a": [{"hw_type": 2}], "o": {"hw_type": "v7"}}


def test_replace_absent_and_empty(spark):
    assert json.loads(one(spark, '{"x":1}', lambda d: J.doc_to_json(J.json_replace(d, "hw_type", "v")))) == {"x": 1}
    assert json.loads(one(spark, '{"e":{}}', lambda d: J.doc_to_json(J.json_replace(d, "hw_type", "v")))) == {"e": {}}
    assert json.loads(one(spark, '{"e":{}}', lambda d: J.doc_to_json(J.json_sanitize_keys(d)))) == {"e": {}}


def test_sanitize(spark):
    out = one(spark, '{"@a b.c-d":1,"o-p.q":{"x-y":2}}', lambda d: J.doc_to_json(J.json_sanitize_keys(d)))
    assert json.loads(out) == {"a_b_c_d": 1, "o-p_q": {"x_y": 2}}


def test_sanitize_strict(spark):
    out = one(spark, '{"o-p":{"x":2}}', lambda d: J.doc_to_json(J.json_sanitize_keys(d, strict=True)))
    assert json.loads(out) == {"o_p": {"x": 2}}


def test_copy(spark):
    same = one(spark, '{"s":"1","d":"2"}', lambda d: J.doc_to_json(J.json_copy(d, "s", "d")))
    assert json.loads(same) == {"s": "1", "d": "2"}
    absent = one(spark, '{"x":1}', lambda d: J.doc_to_json(J.json_copy(d, "s", "d")))
    assert json.loads(absent) == {"x": 1, "d": None}
    nested = one(spark, '{"o":{"s":"5","d":null}}', lambda d: J.doc_to_json(J.json_copy(d, "s", "d")))
    assert json.loads(nested) == {"o": {"s": "5"}, "d": "5"}


@pytest.mark.parametrize("depth", [1, 3, 8])
def test_any_depth(spark, depth):
    """Objects below the unrolled levels are walked like the others."""
    deep = '{"k-1":1.50,"mac":"m","hw_type":null,"a":[{"x-y":1}],"":"e\\"q"}'
    for i in range(40):
        deep = '{"l%d":%s,"z-%d":%d}' % (i, deep, i, i)

    def at_bottom(text):
        node = json.loads(text)
        for i in reversed(range(40)):
            assert "z_%d" % i in node or "z-%d" % i in node
            node = node["l%d" % i]
        return node

    assert one(spark, deep, lambda d: J.json_find(d, "mac", depth)) == "m"
    assert one(spark, deep, lambda d: J.json_find(d, ["nope", "k-1"], depth)) == "1.5"
    assert one(spark, deep, lambda d: J.json_has(d, "nope", depth)) is False
    clean = at_bottom(one(spark, deep, lambda d: J.doc_to_json(J.json_sanitize_keys(d, depth))))
    assert clean == {"k_1": 1.5, "mac": "m", "hw_type": None, "a": [{"x-y": 1}], "": 'e"q'}
    assert at_bottom(one(spark, deep, lambda d: J.doc_to_json(J.json_replace(d, "hw_type", "v7", depth))))["hw_type"] == "v7"
    filled = one(spark, deep, lambda d: J.doc_to_json(J.json_copy(d, "mac", "hw_type", depth)))
    assert json.loads(filled)["hw_type"] == "m" and "hw_type" not in at_bottom(filled)


def test_wide_objects_below_the_unrolled_levels_take_linear_time(spark):
    """4,000 keys six levels down: found, cleaned, and about as fast as at the top."""
    import time

    def document(level):
        d = {f"k-{i}.x": {"v-w": i} if i % 7 == 0 else i for i in range(4000)}
        for _ in range(level - 1):
            d = {"a-b": 1, "o.p": d}
        return json.dumps(d)

    def run(level):
        df = spark.createDataFrame([(document(level),)], "value string").select(J.parse_doc("value").alias("doc"))
        df = df.select(J.doc_to_json(J.json_sanitize_keys("doc")).alias("clean"), J.json_find("doc", "k-3999.x").alias("found"))
        best, row = 1e9, None
        for _ in range(4):
            start = time.perf_counter()
            row = df.collect()[0]
            best = min(best, time.perf_counter() - start)
        return best, row

    (flat, top), (deep, low) = run(1), run(6)
    assert top["found"] == low["found"] == "3999"
    inner = json.loads(low["clean"])
    for _ in range(5):
        inner = inner["o_p"]
    assert inner == json.loads(top["clean"]) and inner["k-7_x"] == {"v_w": 7} and inner["k_1_x"] == 1
    assert deep < 4 * flat + 0.5  # a walk that is quadratic in the keys takes ten times as long and more


def times(spark, texts, expr):
    df = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("ms", T.epoch_millis("t"))
    return [r["r"] for r in df.select(expr.alias("r")).collect()]


def test_seconds_and_millis(spark):
    assert times(spark, ["1634909251", "1634909251444"], T.epoch_date("ms")) == ["2021-10-22"] * 2
    assert times(spark, ["1634909251", "1634909251444"], T.epoch_hour("ms")) == ["13"] * 2
    assert times(spark, ["1634909251"], T.normalize_epoch("t")) == ["1634909251000"]
    assert times(spark, ["1634909251"], T.epoch_datetime("ms")) == ["2021-10-22 13:27:31"]


def test_other_zone(spark):
    assert times(spark, ["1634909251444"], T.epoch_hour("ms", "Asia/Kolkata")) == ["18"]
    # the earliest plausible time is midnight there, too
    assert times(spark, ["1262284200", "1262284199"], T.valid_epoch("t", "Asia/Kolkata")) == [True, False]


@pytest.mark.parametrize("text", ["", "-1", "1634909251.5", "9223372036854775807", "1" * 30, None, "12x"])
def test_invalid_epochs(spark, text):
    assert times(spark, [text], T.valid_epoch("t")) == [False]


def test_lower_bound(spark):
    assert times(spark, ["1262304000", "1262303999"], T.valid_epoch("t")) == [True, False]


def test_decimals(spark):
    df = spark.createDataFrame([("12.5",), ("x",), ("-12.5",)], "v string")
    from shoal.operators.refine import decimal_columns

    got = [r["v"] for r in decimal_columns(df, ["v"]).select(F.col("v").cast("string").alias("v")).collect()]
    assert got == ["13", None, "-13"]


def test_case_twins(spark):
    from shoal.operators import refine as R
    from shoal.plans.profiles import PROFILES

    p = PROFILES["m7"]
    df = spark.createDataFrame([('{"metrics":{"A":"1","a":null},"thedate":"d"}',),
                                ('{"metrics":{"a":"1","A":null},"thedate":"d"}',)], "value string")
    prepared = R.prepare(df, p)
    flat = R.flatten(prepared, p, R.discover_keys(prepared))
    assert flat.columns == ["a", "thedate"]
    assert [r["a"] for r in flat.collect()] == ["1", "1"]


def test_flatten_odd_keys(spark):
    from shoal.operators import refine as R
    from shoal.plans.profiles import PROFILES

    p = PROFILES["m7"]
    odd = {"it's": "1", 'say "hi"': "2", "both'\"": "3"}  # quote kinds: ', ", and both
    text = json.dumps({"metrics": odd, "thedate": "d"})
    prepared = R.prepare(spark.createDataFrame([(text,)], "value string"), p)
    row = R.flatten(prepared, p, R.discover_keys(prepared)).collect()[0].asDict()
    assert row == {**odd, "thedate": "d"}


def test_read_raw_batch_reads_committed_text(spark):
    import tempfile

    from shoal.sources.stream import read_raw_batch

    d = tempfile.mkdtemp() + "/raw"
    spark.createDataFrame([("a", "2024-01-01", "01")], "value string, date string, hour string") \
        .write.partitionBy("date", "hour").text(d)
    assert [r["value"] for r in read_raw_batch(spark, d).collect()] == ["a"]


def test_has_column_and_drop_duplicate_columns(spark):
    from shoal.operators.refine import drop_duplicate_columns, has_column

    a = spark.createDataFrame([(1, "x", (2,))], "id int, v string, s struct<n:int>")
    b = spark.createDataFrame([(1, "y")], "id int, v string")
    assert has_column(a, "s.n") and has_column(a, "V") and not has_column(a, "s.m") and not has_column(a, "v.n")
    joined = a.join(b, a["id"] == b["id"])
    out = drop_duplicate_columns(joined, b)
    assert out.columns == ["id", "v", "s"]
    assert out.collect()[0]["v"] == "x"  # the other frame's copy is the one dropped


def test_epoch_functions_match_python(spark):
    import random
    from datetime import datetime, timezone

    rng = random.Random(7)
    now = int(datetime.now(timezone.utc).timestamp())
    texts = []
    for _ in range(400):
        s = rng.randint(1_000_000_000, now + 10 ** 9)
        kind = rng.random()
        texts.append(str(s) if kind < 0.4 else str(s * 1000 + rng.randint(0, 999)) if kind < 0.8 else
                     rng.choice(["", "12a", "-5", "1e9", " 1634909251", "0", str(10 ** 20)]))
    texts += ["1262304000", "1262303999", "1262304000000", "1262303999999", str(now)]

    def expect(t):
        if not t.isdigit() or not t.isascii():
            return (False, None, None)
        ms = int(t) * 1000 if len(t) < 13 else int(t)
        if ms >= 2 ** 63:
            return (False, None, None)
        ok = 1262304000 <= ms // 1000 <= now
        ts = datetime.fromtimestamp(ms // 1000, timezone.utc)
        return (ok, ts.strftime("%Y-%m-%d"), ts.strftime("%H"))

    df = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("ms", T.epoch_millis("t"))
    got = df.select("t", T.valid_epoch("t").alias("ok"), T.epoch_date("ms").alias("d"), T.epoch_hour("ms").alias("h")).collect()
    for r in got:
        ok, d, h = expect(r["t"])
        assert r["ok"] == ok, r["t"]
        if ok:
            assert (r["d"], r["h"]) == (d, h), r["t"]


def test_named_columns_and_the_rest(spark):
    from shoal.operators import refine as R
    from shoal.plans.profiles import PROFILES

    p = PROFILES["m7"].with_options(columns=("b", "A"), rest_column="others")
    rows = [('{"metrics":{"a":"1","b":"2","c":"3","@d":{"x":1}},"thedate":"d"}',), ('{"metrics":{"A":"4"},"thedate":"d"}',), ('{"metrics":7}',)]
    flat = R.flatten(R.prepare(spark.createDataFrame(rows, "value string"), p), p)
    assert flat.columns == ["a", "b", "others", "thedate"]
    got = sorted(((r["a"], r["b"], r["others"]) for r in flat.collect()), key=str)
    assert got == [("1", "2", '{"@d":{"x":1},"c":"3"}'), ("4", None, None), (None, None, None)]


def test_every_key_is_a_column(spark):
    from shoal.plans import stages as S
    from shoal.plans.profiles import PROFILES

    wide = {f"k{i}": str(i) for i in range(6000)}
    row = S.stage2(spark.createDataFrame([(json.dumps({"metrics": wide, "thedate": "d"}),)], "value string"), PROFILES["m7"])
    assert len(row.columns) == 6002 and "_rest" not in row.columns  # the keys, the date, the copied mac


def test_sql_built_stage1_other_zone_and_odd_keys(spark):
    from shoal.plans import stages as S
    from shoal.plans.profiles import PROFILES

    p = PROFILES["m7"].with_options(tz="Asia/Kolkata", time_field="it's time")
    text = json.dumps({"metrics": {"mac": "m", "it's time": "1634909251444"}})
    row = S.stage1(spark.createDataFrame([(text,)], "value string"), p).collect()[0]
    assert (row["date"], row["hour"]) == ("2021-10-22", "18")  # 13:27 UTC is 18:57 in Kolkata
    assert json.loads(row["value"])["hour"] == "18"
