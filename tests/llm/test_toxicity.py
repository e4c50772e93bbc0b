import math
import random

import numpy as np
import pytest

from storeloom.llm import toxicity
from tests.conftest import SMALL


def test_held_out(spark):
    base = SMALL.replace("sf0.001", "sf0.1")
    docs, labels = (spark.read.parquet(f"{base}/{t}.parquet") for t in ("documents", "labels"))
    train, test = labels.where("doc_id % 2 = 0"), labels.where("doc_id % 2 = 1")
    model = toxicity.fit_severity(docs, train)
    known = docs.join(test.withColumnRenamed("toxic", "known"), "doc_id")
    rows = toxicity.severity(known, model, keep=["doc_id", "known"]).collect()
    rows = [(r.known, r.toxic, r.severity) for r in rows]
    bad = [got for want, got, _ in rows if want == 1]
    good = [got for want, got, _ in rows if want == 0]
    assert np.mean(bad) > 0.9 and np.mean(good) < 0.01
    assert min(s for _, got, s in rows if got) > 0.3


def test_ordinal_regression_orders_grades():
    rng = np.random.default_rng(2)
    n = 600
    x = rng.integers(0, 2, (n, 6))
    grades = np.minimum(x[:, :3].sum(axis=1), 3)
    rows, columns = np.nonzero(x)
    w, cuts = toxicity.fit_ordinal(rows, columns, grades, 6, decay=1e-4)
    assert (np.diff(cuts) > 0).all() and w[:3].min() > 1 and np.abs(w[3:]).max() < 1
    model = toxicity.SeverityModel({f"f{'abcdef'[k]}": float(w[k]) for k in range(6)}, cuts)
    texts = [" ".join(f"f{'abcdef'[k]}" for k in np.flatnonzero(r)) for r in x]
    chances = model.grades(texts)
    assert np.allclose(chances.sum(axis=1), 1) and (chances.argmax(axis=1) == grades).mean() > 0.95


def loss(w, cuts, x, grades, share, decay):
    """Weighted negative log-likelihood with its penalty, text by text."""
    total = decay * sum(v * v for v in w) / 2
    edges = [-math.inf, *cuts, math.inf]
    for row, g, s in zip(x, grades, share, strict=True):
        eta = sum(v for v, on in zip(w, row, strict=True) if on)
        chance = 1 / (1 + math.exp(-(edges[g + 1] - eta))) if g < len(cuts) else 1.0
        chance -= 1 / (1 + math.exp(-(edges[g] - eta))) if g else 0.0
        total -= s * math.log(chance)
    return total


def test_the_fit_is_where_the_gradient_is_zero():
    """Finite differences of the loss, written out, in every weight and threshold."""
    rng = np.random.default_rng(7)
    x = rng.integers(0, 2, (80, 4))
    grades = np.clip(x[:, 0] + x[:, 1] + rng.integers(-1, 2, 80), 0, 3)
    weight = rng.random(80) + 0.5
    rows, columns = np.nonzero(x)
    w, cuts = toxicity.fit_ordinal(rows, columns, grades, 4, weight, steps=6000, rate=0.02, decay=0.01)
    share, h = weight / weight.sum(), 1e-5
    point = np.concatenate([w, cuts])
    for k in range(len(point)):
        up, down = point.copy(), point.copy()
        up[k], down[k] = up[k] + h, down[k] - h
        slope = (loss(up[:4], up[4:], x, grades, share, 0.01) - loss(down[:4], down[4:], x, grades, share, 0.01)) / (2 * h)
        assert abs(slope) < 1e-3
    worse = point + 0.3
    assert loss(worse[:4], worse[4:], x, grades, share, 0.01) > loss(w, cuts, x, grades, share, 0.01)


def test_grades_follow_the_number_of_toxic_sentences(spark):
    assert toxicity.marked_sentences("vile one. good two! vile vile three\nfour", {"vile"}) == 2
    assert toxicity.marked_sentences("... \n!", {"vile"}) == 0 and toxicity.marked_sentences("", {"vile"}) == 0
    rng = random.Random(3)
    words = [f"w{c}" for c in "abcdefghijklmnop"]
    hard = ["vile", "crude", "nasty", "foul"]

    def text(k):  # of ten sentences, k hold one of the words, of which more are distinct the larger k is
        return " ".join(" ".join(rng.choices(words, k=6) + ([hard[i % len(hard)]] if i < k else [])) + "."
                        for i in range(10))

    many = [(i, i % 10 if i % 2 else 0) for i in range(600)]
    docs = spark.createDataFrame([(i, text(k)) for i, k in many], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(k > 0)) for i, k in many], "doc_id long, toxic int")
    got = {r.doc_id: r.severity for r in toxicity.severity(docs, toxicity.fit_severity(docs, labels)).collect()}
    mean = [np.mean([got[i] for i, k in many if k == n]) for n in (0, 1, 3, 9)]
    assert mean == sorted(mean) and mean[0] < 0.3 and mean[-1] > mean[1] + 0.5


def test_awkward_input(spark, clashing):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.fit_severity(clashing, none) is None
    assert {r.toxic for r in toxicity.severity(clashing, None).collect()} == {False}
    rng = random.Random(1)
    words = [f"w{c}" for c in "abcdefghij"]
    texts = [(i, " ".join(rng.choices(words, k=20) + (["vile"] * (i % 4) + ["mean"] if i % 3 == 0 else [])))
             for i in range(90)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(90)] + [(0, 0), (None, 1), (5, None)],
                                   "doc_id long, toxic int")
    model = toxicity.fit_severity(docs, labels)
    got = {r.doc_id: r for r in toxicity.severity(docs, model).collect()}
    assert all(r.toxic == (i % 3 == 0) for i, r in got.items())
    assert toxicity.severity(docs.limit(0), model).count() == 0
    nulls = toxicity.severity(clashing.where("text is null"), model).first()
    assert not nulls.toxic and nulls.severity == pytest.approx(0, abs=0.6)
    only = toxicity.fit_severity(docs, labels.where("toxic = 1 and doc_id > 0"))
    assert all(r.toxic for r in toxicity.severity(docs, only).collect())
