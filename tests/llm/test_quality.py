import re
from collections import Counter, defaultdict

import numpy as np

from storeloom.llm import quality


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    places = defaultdict(list)
    for i in range(len(words) - 7):
        places[tuple(words[i:i + 8])].append(i)
    covered = {k for p in places.values() if len(p) > 1 for i in p for k in range(i, i + 8)}
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeated += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeated,
            len(covered), len(words) < 20 or 100 * len(covered) > 30 * len(words))


def test_base_counts(spark, clashing, texts):
    model = quality.QualityModel(np.zeros(64), float("-inf"))
    got = quality.apply_quality(clashing, model, keep_columns=["doc_id"]).collect()
    assert Counter((r[0], *r[1:7]) for r in got) == Counter((i, *plain(t)) for i, t in texts)
    everything = quality.apply_quality(clashing, model)
    assert len(set(everything.columns)) == len(everything.columns) and everything.count() == len(texts)
    assert all(r.kept == (not r.base_failed) for r in got)


def test_scores_are_mean_log_ratios():
    rng = np.random.default_rng(1)
    model = quality.QualityModel(rng.normal(size=97), 0.0)
    texts = ["", "abc", "abcd", "some  words\nhere", "é" * 9, "", "word " * 40]
    for t, score in zip(texts, quality.scores(texts, model), strict=True):
        b = b" ".join(t.encode().split())
        grams, counts = quality.gram_buckets([t], 97)
        assert counts[0] == len(grams) == max(0, len(b) - 3)
        assert np.isclose(score, model.log_ratio[grams].mean() if len(grams) else 0)


def test_fit_separates_and_keep_good_agrees(spark):
    good = [(i, " ".join(f"word{(i * 7 + k) % 50} plain" for k in range(30))) for i in range(60)]
    bad = [(100 + i, " ".join(f"w{k}### $$%{(i * k) % 9}" for k in range(40))) for i in range(20)]
    docs = spark.createDataFrame(good + bad, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(40)] + [(100 + i, 0) for i in range(10)]
                                   + [(39, 0), (None, 1)], "doc_id long, quality int")
    model = quality.fit_quality(docs, labels)
    rows = quality.apply_quality(docs, model).collect()
    assert {r.doc_id for r in rows if r.kept} == {i for i, _ in good}
    kept = quality.keep_good(docs, model)
    assert kept.schema == docs.schema and {r.doc_id for r in kept.collect()} == {i for i, _ in good}
    again = quality.fit_quality(docs.repartition(7), labels.repartition(3))
    assert again.threshold == model.threshold and (again.log_ratio == model.log_ratio).all()


def test_without_trusted_documents_or_rows(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.fit_quality(docs, none).threshold == float("-inf")
    empty = docs.limit(0)
    model = quality.fit_quality(empty, none)
    assert quality.apply_quality(empty, model).count() == 0
