import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from storeloom.llm import jaccard


def plain(rows, similarity=0.8):
    sets = []
    for _, text in rows:
        w = (text or "").encode().split()
        sets.append({tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    parent = list(range(len(rows)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = [0] * len(rows)
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and both >= similarity * (len(sets[a]) + len(sets[b]) - both) - 1e-9:
                links[a] += 1
                links[b] += 1
                parent[top(a)] = top(b)
    least = defaultdict(list)
    for x in range(len(rows)):
        least[top(x)].append((rows[x][0] is None, rows[x][0]))
    return Counter((rows[x][0], min(least[top(x)], key=lambda v: (v[0], v[1] or 0))[1], links[x])
                   for x in range(len(rows)))


def copies(n, seed, length=100, edits=3):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(5000)}" for _ in range(length)]
    out = []
    for _ in range(n):
        text = list(base)
        for _ in range(rng.randrange(edits + 1)):
            text[rng.randrange(length)] = f"e{rng.randrange(10**6)}"
        out.append(" ".join(text))
    return out


@pytest.mark.parametrize("block", [8, 512])
def test_all_links(spark, docs, block):
    rows = [(i, t) for i, t in enumerate(
        [t for s in range(6) for t in copies(5, s)] + copies(70, 99, edits=6) + [f"tiny {k % 3}" for k in range(7)]
        + [f"lone{k} " * 9 for k in range(5)] + ["", None, " \n", "one", "one"])]
    rows += [(None, rows[0][1]), (None, "only a null id has this text"), (3, rows[3][1]), (3, rows[3][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = jaccard.join(df, block=block).select("doc_id", "class_id", "n_links").collect()
    assert Counter(map(tuple, got)) == plain(rows)


def test_keep_first(spark, clashing):
    rows = [(i, t) for i, t in enumerate(copies(9, 1, edits=1) + copies(4, 2, edits=1) + ["", None, "a b", "a b"])]
    rows += [(0, rows[0][1]), (0, rows[0][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = jaccard.keep_first(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == [0, 9, 13, 14, 15]
    assert jaccard.keep_first(clashing).columns == clashing.columns


def test_common():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 300, n).astype(np.uint64)) for n in (5, 80, 200, 1, 90)]
    want = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    off = ~np.eye(5, dtype=bool)
    assert (jaccard.common(sets, width=7)[off] == np.array(want)[off]).all()


def test_prefixes_reach_the_recall():
    d = jaccard.prefix_length()
    assert 1 - (1 - 0.8 ** d) ** jaccard.TRIES >= jaccard.RECALL
    assert 1 - (1 - 0.8 ** (d + 1)) ** jaccard.TRIES < jaccard.RECALL or d == jaccard.DEPTH


def test_empty(spark, docs):
    assert jaccard.join(docs.limit(0)).count() == 0
    assert jaccard.keep_first(docs.limit(0)).count() == 0


def test_components(spark):
    chain = [(f"{k:03d}".encode(), f"{k + 1:03d}".encode()) for k in range(40)]
    edges = spark.createDataFrame(chain + [(b"x", b"y"), (b"q", b"q")], "set_key binary, root binary")
    got = {bytes(r.set_key): bytes(r.label) for r in jaccard.components(edges).collect()}
    assert got == {f"{k:03d}".encode(): b"000" for k in range(41)} | {b"x": b"x", b"y": b"x"}
