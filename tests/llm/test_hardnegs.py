"""Hard negatives against all scores."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from storeloom.llm import hardnegs


def brute(rows, step, positives=5, negatives=3, low=50, high=95):
    clean = [(i, y, [math.floor(256 * x) for x in v]) for i, v, y in rows
             if None not in (i, v, y) and all(x is not None and math.isfinite(x) for x in v)]
    out = Counter()
    for i, y, a in {(i, y, tuple(v)) for i, y, v in clean if i % step == 0}:
        scored = sorted((-sum(p * q for p, q in zip(a, v, strict=True)), j, z) for j, z, v in clean
                        if j != i and len(v) == len(a))
        for ps, j, _ in [s for s in scored if s[2] == y][:positives]:
            window = [(s, k) for s, k, z in scored if z != y and low * -ps <= 100 * -s <= high * -ps][:negatives]
            out.update((i, j, r, k, -ps, -s) for r, (s, k) in enumerate(window, 1))
    return out


def data(size=160):
    rng = np.random.default_rng(size)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(0.4, 0.6, size=5)], int(rng.integers(4))) for i in range(size)]
    # One very common vector over two labels, ties, zero scores, and what takes no part.
    rows += [(200 + i, [0.5, 0.5, 0.5, 0.5, 0.5], i % 2) for i in range(60)]
    rows += [(300 + i, [0.3, 0.3, 0.3, 0.3, 0.3], 2 + i % 2) for i in range(20)]
    rows += [(400, [0.0] * 5, 0), (401, [0.0] * 5, 1), (399, [0.0] * 5, 0), (398, [0.0] * 5, 3)]
    rows += [(500, None, 1), (510, [1.0, None, 1.0, 1.0, 1.0], 1), (520, [math.nan] * 5, 1), (None, rows[0][1], 1),
             (530, [math.inf] * 5, 1), (540, rows[3][1], None), (550, [1.0, 2.0], 1), (560, [2.0, 1.0], 1),
             (570, [1.0, 1.0], 2), (580, [], 1), (590, [], 2), (10, rows[10][1], rows[10][2]), (600, [-1.0] * 5, 9)]
    return rows


@pytest.mark.parametrize("block, anchor_block", [(7, 3), (64, 16), (4096, 512)])
def test_against_all_scores(spark, block, anchor_block):
    rows = data()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3)
    got = hardnegs.mine(df, df.where("vec_id % 10 = 0"), block=block, anchor_block=anchor_block)
    want = brute(rows, 10)
    assert sum(want.values()) > 100 and Counter(map(tuple, got.collect())) == want


def test_other_numbers_of_positives_and_windows(spark):
    rows = data(90)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label long")
    for args in ((1, 1, 0, 100), (3, 7, 90, 90), (9, 2, 20, 60)):
        got = hardnegs.mine(df, df.where("vec_id % 25 = 0"), *args, block=50)
        assert Counter(map(tuple, got.collect())) == brute(rows, 25, *args)
    with pytest.raises(ValueError):
        hardnegs.mine(df, df, low=90, high=50)


def test_empty_and_clashing(spark):
    df = spark.createDataFrame(data(60), "vec_id long, embedding array<double>, label long")
    assert hardnegs.mine(df.limit(0), df.limit(0)).count() == 0
    assert hardnegs.mine(df, df.limit(0)).count() == 0
    assert hardnegs.mine(df.limit(1), df.limit(1)).count() == 0
    odd = df.withColumns({c: F.lit(1) for c in ("id", "vector", "anchor", "score", "rank", "block", "dim", "g", "kind")})
    want = brute(data(60), 20)
    assert Counter(map(tuple, hardnegs.mine(odd, odd.where("vec_id % 20 = 0")).collect())) == want


def test_first_scores_with_ties():
    assert hardnegs.first_of(np.array([3, 9, 3, 9, 1]), 3).tolist() == [1, 3, 0]
    assert hardnegs.first_of(np.array([], np.int64), 3).tolist() == []
    assert hardnegs.bounds(7, 50, 95) == (4, 6) and hardnegs.bounds(0, 50, 95) == (0, 0)
    least, largest = hardnegs.bounds(-10, 50, 95)
    assert least > largest
    big = np.full((1, 4), 1 << 28)
    assert hardnegs.product(big, big).tolist() == [[1 << 58]]


def test_a_cell_sends_no_more_however_many_blocks_pass():
    rng = np.random.default_rng(8)
    vectors, labels = rng.integers(-9, 30, (600, 4)), rng.integers(0, 3, 600)
    ids = rng.permutation(600) // 2  # each id twice
    vectors[100:140], ids[100:140], labels[100:140] = vectors[100], ids[100], labels[100]
    anchors = np.arange(0, 600, 20)
    heads = np.stack([ids[anchors], labels[anchors]], axis=1)
    first = hardnegs.Positives(anchors, heads, vectors[anchors], 5)
    for start in range(0, 600, 7):
        part = slice(start, start + 7)
        first.look(ids[part], labels[part, None], vectors[part])
    found = [np.concatenate(c) for c in zip(*first.results(), strict=True)]
    scores = {int(a): sorted((-int(s), int(i)) for k, _, s, _, i in zip(*found, strict=True) if k == a) for a in anchors}
    for a in anchors.tolist():
        every = sorted((-int(vectors[a] @ v), int(i)) for v, i, y in zip(vectors, ids, labels, strict=True)
                       if y == labels[a] and i != ids[a])
        assert scores[a] == every[:5]
    heads = np.array([[*h, 5, *(-s for s, _ in scores[int(a)])] for a, h in zip(anchors, heads, strict=True)])
    inside = hardnegs.Windows(anchors, heads, vectors[anchors], 3, 50, 95)
    for start in range(0, 600, 7):
        part = slice(start, start + 7)
        inside.look(ids[part], labels[part, None], vectors[part])
    found = [np.concatenate(c) for c in zip(*inside.results(), strict=True)]
    for a in anchors.tolist():
        sent = Counter((-int(s), int(i)) for k, _, s, _, i in zip(*found, strict=True) if k == a)
        every = Counter((-int(vectors[a] @ v), int(i)) for v, i, y in zip(vectors, ids, labels, strict=True)
                        if y != labels[a] and i != ids[a])
        assert sum(sent.values()) <= 15 and sent <= every
        for positive, _ in scores[a]:
            low, high = hardnegs.bounds(-positive, 50, 95)
            window = [x for x in sorted(every.elements()) if low <= -x[0] <= high][:3]
            assert [x for x in sorted(sent.elements()) if low <= -x[0] <= high][:3] == window
