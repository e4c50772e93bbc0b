import math
from collections import Counter

import numpy as np
import pytest

from storeloom.llm import topk


def brute(rows, k, step):
    clean = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
             if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    asked = {(i, tuple(v)) for i, v in clean if i % step == 0}
    out = []
    for i, q in asked:
        found = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), j) for j, v in clean
                       if j != i and len(v) == len(q))
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(found[:k])]
    return Counter(out)


@pytest.mark.parametrize("size", [3, 64, 4096])
def test_against_all_scores(spark, size):
    rng = np.random.default_rng(size)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=6)]) for i in range(150)]
    rows += [(200 + i, [0.5, 0.5, 0.5, 0.5, 0.5, 0.5]) for i in range(60)]
    rows += [(300, None), (310, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (320, [math.nan] * 6), (None, rows[0][1]),
             (330, [math.inf] * 6), (340, [1.0, 2.0]), (350, [3.0, -2.0]), (360, []), (370, []), (10, rows[10][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    got = topk.top_k(df, df.where("vec_id % 10 = 0"), 5, block=size, query_block=7)
    assert Counter(map(tuple, got.collect())) == brute(rows, 5, 10)


def test_large_values_and_empty(spark):
    rows = [(i, [float((-1) ** i * i * 1e5), 3.0e6 - i]) for i in range(40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk.top_k(df, df.where("vec_id % 10 = 0"), 3)
    assert Counter(map(tuple, got.collect())) == brute(rows, 3, 10)
    assert topk.top_k(df.limit(0), df.limit(0), 5).count() == 0
    assert topk.top_k(df.limit(1), df.limit(1), 5).count() == 0


def test_stops_early():
    vectors = np.zeros((1000, 4), np.int64)
    vectors[:, 0] = np.arange(1000)
    lists = topk.Lists(np.arange(1000), vectors)
    ids, scores = lists.top(-1, np.array([3, 0, 0, 0]), 2)
    assert ids.tolist() == [999, 998] and scores.tolist() == [2997, 2994]


def test_large_values_in_several_blocks(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.integers(-10 ** 6, 10 ** 6, 3) * (5 if i % 9 else 1)]) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(2)
    got = topk.top_k(df, df.where("vec_id % 10 = 0"), 3, block=128)
    assert Counter(map(tuple, got.collect())) == brute(rows, 3, 10)


def test_each_block_passes_once_for_a_group_of_queries(spark):
    rows = [(i, [float(i), 1.0] if i % 4 else [1.0, 2.0, float(i)]) for i in range(200)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3).selectExpr(
        "vec_id AS id", "array(vec_id, -vec_id) AS head", "transform(embedding, x -> bigint(x)) AS vector")
    data, asked = topk.pack(df, 16).localCheckpoint(), topk.pack(df.where("id % 2 = 0"), 4).localCheckpoint()

    class Counts:
        def __init__(self, keys, heads, queries):
            assert (heads[:, 0] == keys).all() and (heads[:, 1] == -keys).all() and len(queries) == len(keys)
            self.keys, self.met = keys, []

        def look(self, ids, heads, vectors):
            assert vectors.dtype == np.int16 and (heads[:, 0] == ids).all()
            self.met.append(ids)

        def results(self):
            met = np.concatenate(self.met)
            yield [np.repeat(self.keys, len(met)), np.tile(met, len(self.keys)),
                   np.full(len(met) * len(self.keys), len(self.keys))]

    for held in (1, 60, 1 << 22):
        found = topk.meetings(data, asked, Counts, ["q", "v", "held"], "q long, v long, held long", held).collect()
        want = {(q, v) for q in range(0, 200, 2) for v in range(200) if (q % 4 == 0) == (v % 4 == 0)}
        assert len(found) == len(want) and {(r.q, r.v) for r in found} == want
        if held > 60:
            # All queries of a dimension are in one place, whatever the number of their blocks.
            assert {r.held for r in found} == {50}


def test_bound_is_kept_from_block_to_block(monkeypatch):
    rng = np.random.default_rng(4)
    good = rng.integers(50, 90, (300, 3))
    bad = rng.integers(-20, 20, (300, 3))
    queries = rng.integers(1, 9, (10, 3))
    search = topk.Search(np.arange(10), queries, 4)
    search.look(np.arange(300, 600), good)
    products = []
    monkeypatch.setattr(topk, "product", lambda *a: products.append(a))
    search.look(np.arange(600, 900), bad)
    assert not products
    monkeypatch.undo()
    spread = np.zeros((600, 3), np.int64)
    spread[:, 0] = np.arange(600)
    search.look(np.arange(600), spread)
    rows = np.concatenate([good, bad, spread])
    ids = np.concatenate([np.arange(300, 900), np.arange(600)])
    for q in range(10):
        scores = rows @ queries[q]
        first = [i for i in np.lexsort((ids, -scores)) if ids[i] != q][:4]
        assert search.ids[q].tolist() == ids[first].tolist() and search.scores[q].tolist() == scores[first].tolist()
