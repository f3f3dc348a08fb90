"""The Column walkers against a plain-Python walker on random nested documents.

The Python walker below lives only in the tests; it states the contract directly:
keys in sorted order, depth first, objects descended at any depth, arrays opaque, later
key wins on a clean-up clash.  ``depth`` only says how many levels are unrolled.
"""

import json
import random
import re

import pytest

from shoal.functions import jsonfn as J

KEYS = ["mac", "hw_type", "a-b", "a_b", "a.b", "@x", "x", "e f", "e_f", "k", "o-p"]
SCALARS = ["s1", "s2", 7, 0, True, False, None, "", "m-1"]


def rand_doc(rng, level=1, max_level=5):
    d = {}
    for _ in range(rng.randint(0, 5)):
        r = rng.random()
        k = rng.choice(KEYS)
        if r < 0.3 and level < max_level:
            d[k] = rand_doc(rng, level + 1, max_level)
        elif r < 0.4:
            d[k] = [rng.choice(SCALARS), {"mac": "in-array"}]
        else:
            d[k] = rng.choice(SCALARS)
    return d


def text(v):
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, (list, dict)):
        return json.dumps(v, separators=(",", ":"))
    return str(v)


def py_find(d, key):
    for k in sorted(d):
        v = d[k]
        if isinstance(v, dict):
            r = py_find(v, key)
            if r is not None:
                return r
        elif k == key and v is not None:
            return text(v)
    return None


def py_replace(d, key, value):
    out = {}
    for k in sorted(d):
        v = d[k]
        if isinstance(v, dict):
            out[k] = py_replace(v, key, value)
        else:
            out[k] = value if k == key else v
    return out


def clean(k, scalar):
    k = re.sub(r"[ \t\n\x0b\f\r.]", "_", k.replace("@", ""))
    return k.replace("-", "_") if scalar else k


def py_sanitize(d):
    out = {}
    for k in sorted(d):  # later (sorted) entry wins a clash
        v = d[k]
        if isinstance(v, dict):
            out[clean(k, False)] = py_sanitize(v)
        else:
            out[clean(k, True)] = v
    return out


def py_drop(d, key):
    out = {}
    for k, v in d.items():
        if isinstance(v, dict):
            out[k] = py_drop(v, key)
        elif k != key:
            out[k] = v
    return out


def py_copy(d, src, dst):
    if py_find(d, dst) is not None:
        return d
    cleaned = py_drop(d, dst)
    cleaned = dict(cleaned)
    cleaned[dst] = py_find(cleaned, src)
    return cleaned


def norm(v):
    """Spark's JSON of a found value compared as parsed data."""
    return json.loads(v) if isinstance(v, str) else v


@pytest.fixture(scope="module")
def docs():
    rng = random.Random(20260101)
    return [rand_doc(rng) for _ in range(300)]


@pytest.mark.parametrize("depth", [1, 2, 3, 8])
def test_walkers_match_plain_python(spark, docs, depth):
    from shoal.operators.filters import with_doc

    df = with_doc(spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)], "i int, value string"))
    doc = "doc"
    out = df.select(
        "i",
        J.json_find(doc, "mac", depth).alias("find"),
        J.doc_to_json(J.json_replace(doc, "hw_type", "v7", depth)).alias("replace"),
        J.doc_to_json(J.json_sanitize_keys(doc, depth)).alias("sanitize"),
        J.doc_to_json(J.json_copy(doc, "k", "mac", depth)).alias("copy"),
    ).orderBy("i").collect()
    for row in out:
        d = docs[row["i"]]
        assert row["find"] == py_find(d, "mac"), (d, row["find"])
        assert json.loads(row["replace"]) == py_replace(d, "hw_type", "v7"), d
        assert json.loads(row["sanitize"]) == py_sanitize(d), d
        assert json.loads(row["copy"]) == py_copy(d, "k", "mac"), d


def test_put_matches_reference(spark, docs):
    from shoal.operators.filters import with_doc

    df = with_doc(spark.createDataFrame([(i, json.dumps(d), "1", None) for i, d in enumerate(docs)], "i int, value string, one string, none string"))
    out = df.select(
        "i",
        J.doc_to_json(J.json_put("doc", columns={"x": "one", "hour": "none"})).alias("j"),
        J.doc_to_json(J.json_put("doc", {"x": "1", "hour": None})).alias("k"),
    )
    for row in out.collect():
        expect = dict(docs[row["i"]])
        expect.update({"x": "1", "hour": None})
        assert json.loads(row["j"]) == expect and json.loads(row["k"]) == expect
