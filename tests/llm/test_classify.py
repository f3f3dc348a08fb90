"""The weak-label model and the hashed scorer: held-out accuracy and cases."""

import random

import numpy as np

from shoal.llm import classify


def corpus(spark, n=900, seed=3):
    rnd = random.Random(seed)
    words = ["".join(rnd.choice("aeioulmnrst") for _ in range(rnd.randint(3, 8))) for _ in range(800)]
    bad = ["zorgab", "zorgix", "kwelpa", "kwelto", "vrudge"]
    docs, labels = [], []
    for i in range(n):
        w = [rnd.choice(words) for _ in range(rnd.randint(30, 80))]
        kind = i % 5
        if kind == 0:
            for _ in range(4):
                w[rnd.randrange(len(w))] = rnd.choice(bad)
        if kind == 1:
            w = [x + "$$$" for x in w] if i % 2 else [x for x in w[:8] for _ in range(6)]
        docs.append((i, " ".join(w), "v"))
        if i < n * 2 // 3:
            labels.append((i, 0 if kind == 1 else 1, 1 if kind == 0 else 0))
    return (spark.createDataFrame(docs, "doc_id long, text string, verdict string"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_held_out_accuracy(spark):
    docs, labels = corpus(spark)
    model = classify.fit(docs, labels)
    got = classify.score(docs, model, "v").select("doc_id", "v").collect()
    held = [r for r in got if r["doc_id"] >= 600]
    right = sum(r["v"]["kept"] == (r["doc_id"] % 5 > 1) for r in held)
    assert right >= 0.97 * len(held)
    assert model.accuracy["toxic", "labels"] > 0.9 and model.accuracy["junk", "symbols"] > 0.6


def test_em_weighs_labellers_by_accuracy():
    rnd, counts = random.Random(1), {}
    for _ in range(20_000):
        bad = rnd.random() < 0.3
        vote = lambda right: "b" if bad == (rnd.random() < right) else "g"  # noqa: E731,B023
        key = vote(0.95) + vote(0.6) + (vote(0.9) if rnd.random() < 0.5 else "-")
        counts[key] = counts.get(key, 0) + 1
    post, right = classify.em(counts, 3)
    assert abs(right[0] - 0.95) < 0.05 and abs(right[1] - 0.6) < 0.06 and abs(right[2] - 0.9) < 0.06
    assert post["bg-"] > 0.5 > post["gb-"]
    assert classify.em({}, 3)[0] == {}


def test_training_needs_both_classes():
    weights, bias = classify.train([np.array([1, 2])], np.array([0.0]))
    assert not weights.any() and bias < 0


def test_cases(spark):
    docs, labels = corpus(spark, 300)
    odd = spark.createDataFrame([(None, None, "v"), (1000, "", "v"), (1001, "  ", "v"), (1002, "a b " * 50_000, "v"), (0, "x y", "v"), (0, "x y", "v")], docs.schema)
    more = labels.union(spark.createDataFrame([(None, 0, 1), (2, None, None), (3, 0, 0), (3, 1, 0), (99_999, 0, 1)], labels.schema))
    kept = classify.keep_good(docs.union(odd), more)
    assert kept.columns == docs.columns
    got = [r["doc_id"] for r in kept.collect()]
    assert None in got and {1000, 1001} <= set(got) and got.count(0) in (2, 3)
    assert classify.keep_good(docs, labels.limit(0)).count() == 300  # nothing learnt, nothing rejected
    assert classify.keep_good(docs.limit(0), labels).count() == 0
    votes = {r["doc"]: r["junk_label"] for r in classify.label_votes(more).collect()}
    assert votes[3] == "b" and None not in votes and votes[2] == "g"
