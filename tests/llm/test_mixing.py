import math
from collections import Counter, defaultdict

import numpy as np
import pytest

from storeloom.llm import mixing


def test_targets():
    assert mixing.targets([100, 100, 100], [3, 1, 2]) == [200.0, pytest.approx(250 / 3), pytest.approx(500 / 3)]
    assert sum(mixing.targets([5, 1000, 70, 0], [3, 1, 2, 3])) == pytest.approx(1.5 * 1075)
    assert mixing.targets([], []) == [] and mixing.targets([0, 0], [1, 2]) == [0, 0]


def test_hypergeometric():
    rng = np.random.default_rng(0)
    draws = [mixing.hypergeometric(rng, 30, 50, 20) for _ in range(4000)]
    assert min(draws) >= 0 and max(draws) <= 20
    assert np.mean(draws) == pytest.approx(7.5, abs=0.15)
    assert np.var(draws) == pytest.approx(20 * 3 / 8 * 5 / 8 * 60 / 79, rel=0.15)
    big = mixing.hypergeometric(rng, 6 * 10**9, 10**10, 8 * 10**9)
    assert abs(big - 3 * 10**9) < 10**6
    assert mixing.hypergeometric(rng, 5, 0, 3) == 3 and mixing.hypergeometric(rng, 0, 5, 3) == 0


def test_tree_is_exact():
    quotas = [1000, 7, 0, 350]
    tree = mixing.splitting_tree(quotas, 9, seed=4)
    assert tree.sum(axis=0).tolist() == quotas and np.ptp(tree.sum(axis=1)) <= 1 and (tree >= 0).all()
    assert (tree == mixing.splitting_tree(quotas, 9, seed=4)).all()


def test_mix(spark, clashing, texts):
    rows = mixing.mix(clashing, shards=7).collect()
    size = {}
    for r in clashing.collect():
        size.setdefault(r.source, 0)
        size[r.source] += len((r.text or "").encode().split())
    names = sorted(size, key=lambda s: (s is None, s or ""))
    wanted = dict(zip(names, mixing.targets([size[n] for n in names],
                                            [(3, 1, 2)[i % 3] for i in range(len(names))]), strict=True))
    taken = defaultdict(int)
    for r in rows:
        assert r.source_size == size[r.source] and r.target == wanted[r.source]
        words = Counter()
        for d in r.draws:
            assert 0 <= d.shard < 7 and d.words > 0 and d["first"] + d.words <= r.size
            words.update((d.run, w) for w in range(d["first"], d["first"] + d.words))
        assert not words or max(words.values()) == 1
        assert r.taken == len(words) <= 2 * r.size
        taken[r.source] += r.taken
    assert len(rows) == len(texts)
    for n in names:
        assert abs(taken[n] - wanted[n]) <= max(mixing.BLOCK_WORDS, size[n] / 256 + 1) / 2 + 1


def test_reruns_agree(spark, docs):
    pick = ["doc_id", "source", "taken"]
    first = Counter(map(tuple, mixing.mix(docs).select(pick).collect()))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        again = Counter(map(tuple, mixing.mix(docs.repartition(5)).select(pick).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert first == again


def test_documents_and_shards(spark, docs, tmp_path):
    plan = mixing.mix(docs).select("doc_id", "taken").collect()
    taken = Counter()
    for r in plan:
        taken[r.doc_id] += r.taken
    found = mixing.mixed_documents(docs)
    assert found.schema.names == docs.schema.names
    words = Counter()
    for r in found.collect():
        words[r.doc_id] += len(r.text.encode().split())
    assert +words == +taken
    mixing.write_shards(docs, str(tmp_path / "shards"), shards=4)
    shards = Counter()
    for r in spark.read.parquet(str(tmp_path / "shards")).collect():
        shards[r.doc_id] += len(r.text.encode().split())
    assert +shards == +taken


def test_empty_and_given_weights(spark, docs):
    assert mixing.mix(docs.limit(0)).count() == 0
    only = docs.where("source in ('s0', 's1')")
    rows = mixing.mix(only, {"s0": 1.0, "s1": 1.0}, share=0.5).collect()
    assert len({r.target for r in rows}) <= 2


def test_tree_with_given_totals():
    quotas, totals = [40, 0, 7, 90], [30, 50, 0, 57]
    tree = mixing.splitting_tree(quotas, 4, 3, totals)
    assert tree.sum(axis=0).tolist() == quotas and tree.sum(axis=1).tolist() == totals
    assert mixing.splitting_tree([0, 0], 3).tolist() == [[0, 0]] * 3 and mixing.splitting_tree([], 2).shape == (2, 0)


def replay(sizes, weights, shards, block_words=mixing.BLOCK_WORDS):
    """Blocks, quota and shares of the shards of each source by plain Python, all in one group."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    wanted = mixing.targets([sizes[n] for n in names], [weights[i % 3] for i in range(len(names))])
    blocks = [min(sizes[n], max(mixing.LEAST_BLOCKS, -(-sizes[n] // block_words))) for n in names]
    quotas = [min(2 * b, math.floor(b * t / sizes[n] + 0.5)) if sizes[n] else 0
              for n, b, t in zip(names, blocks, wanted, strict=True)]
    totals = mixing.splitting_tree([sum(quotas)], shards, 0)[:, 0]
    return names, blocks, quotas, mixing.splitting_tree(quotas, shards, mixing.hash_seed(0, 0), totals)


def test_the_tree_decides_what_a_shard_holds(spark, docs):
    for shards in (1, 5, 64):
        rows = mixing.mix(docs, shards=shards, block_words=64).collect()
        sizes = {r.source: r.source_size for r in rows}
        names, blocks, quotas, tree = replay(sizes, (3.0, 1.0, 2.0), shards, 64)
        got = defaultdict(set)
        for r in rows:
            for d in r.draws:
                got[r.source, d.shard].add((d.run, d.block))
        for i, n in enumerate(names):
            assert [len(got[n, k]) for k in range(shards)] == tree[:, i].tolist()
            # Every draw of the source is in one shard only.
            drawn = [b for k in range(shards) for b in got[n, k]]
            assert len(drawn) == len(set(drawn)) == quotas[i]


def test_many_sources(spark):
    """150 000 sources of a few words, one with a third of all, by way of groups."""
    from pyspark.sql import functions as F

    docs = spark.range(200_000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") >= 150_000, "big").otherwise(
            F.concat(F.lit("s"), F.lpad(F.col("id").cast("string"), 6, "0"))).alias("source"),
        F.repeat(F.lit("w "), (F.col("id") % 5 + 1).cast("int")).alias("text"))
    mixed = mixing.mix(docs, shards=4, share=0.75)
    total = mixed.agg(F.sum("size"), F.sum("taken"), F.countDistinct("source"), F.count("*"),
                      F.count_if(F.col("taken") > 2 * F.col("size"))).first()
    assert total[0] == 600_000 and abs(total[1] / 450_000 - 1) < 0.02 and total[2:] == (150_001, 200_000, 0)
    shards = {r.shard: r.n for r in mixed.select(F.explode("draws").alias("d")).groupBy("d.shard").agg(
        F.sum("d.words").alias("n")).collect()}
    assert len(shards) == 4 and max(shards.values()) < 1.05 * min(shards.values())


def test_weights_as_a_frame(spark, docs):
    given = {"s0": 2.0, "s1": 1.0, "s2": 5.0, "s3": 1.0, "s4": 1.0, None: 3.0}
    frame = spark.createDataFrame(list(given.items()), "source string, weight double")
    pick = lambda w: sorted((str(r.source), r.target) for r in mixing.mix(docs, w).collect())
    assert pick(given) == pick(frame)
    with pytest.raises(Exception, match="no weight for source"):
        mixing.mix(docs, {"s0": 1.0}).collect()


def test_shards_of_the_mix_follow_each_other(spark, docs, tmp_path):
    mixing.mixed_documents(docs, shards=6, block_words=32).write.parquet(str(tmp_path / "mix"))
    mixing.write_shards(docs, str(tmp_path / "shards"), shards=6, block_words=32)
    by_shard = {int(d.name.split("=")[1]): [tuple(r) for r in spark.read.parquet(str(d)).select("doc_id", "text").collect()]
                for d in (tmp_path / "shards").glob("shard=*")}
    assert len(by_shard) == 6
    for part in (tmp_path / "mix").glob("*.parquet"):
        rows = [tuple(r) for r in spark.read.parquet(str(part)).select("doc_id", "text").collect()]
        while rows:
            shard = next(k for k, v in by_shard.items() if rows[:len(v)] == v)
            rows = rows[len(by_shard.pop(shard)):]
    assert not by_shard
