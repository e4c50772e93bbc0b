"""Distributed order operators against one-task windows and brute force."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from storeloom.operators import joins, observe, ordered
from tests.conftest import one, rows


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one value."""
    rnd = random.Random(3)
    data = [(i, 7 if i % 3 == 0 else rnd.randint(0, 50), rnd.random()) for i in range(1000)]
    return spark.createDataFrame(data, "id int, v int, w double").repartition(5)


def test_ordered_scan_equals_window(spark, skewed):
    got = ordered.ordered_scan(skewed, [F.desc("v"), "id"], number="nr", running={"run": "v"},
                               total="n")
    w = Window.orderBy(F.desc("v"), "id")
    want = skewed.withColumns({
        "nr": F.row_number().over(w), "n": F.lit(1000),
        "run": F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0))})
    assert rows(got.select("id", "nr", "run", "n"), "id") == rows(
        want.select("id", "nr", "run", "n"), "id")


@pytest.mark.parametrize("size,n", [(1000, 5), (1000, 7), (3, 5), (5, 5), (0, 5)])
def test_ntile_equals_window(spark, skewed, size, n):
    df = skewed.filter(F.col("id") < size)
    got = ordered.ntile(df, ["v", "id"], n, "tile").select("id", "tile")
    want = df.withColumn("tile", F.ntile(n).over(Window.orderBy("v", "id"))).select("id", "tile")
    assert rows(got, "id") == rows(want, "id")


def test_quantiles_equal_percentile(spark, skewed):
    got = {r["share"]: r["quantile"] for r in rows(
        ordered.quantile_values(skewed, "v", [0.0, 0.3, 0.5, 0.95, 1.0]))}
    for share, value in got.items():
        want = one(skewed.agg(F.percentile("v", F.lit(share)).alias("p")))["p"]
        assert value == pytest.approx(want)


def test_quantiles_by_group(spark, skewed):
    df = skewed.withColumn("g", F.when(F.col("id") % 3 > 0, F.col("id") % 3))
    # One of the groups is NULL.
    got = rows(ordered.quantile_values(df, "w", [0.25, 0.5], by=["g"]), "g", "share")
    want = rows(df.groupBy("g").agg(F.percentile("w", F.lit(0.25)).alias("a"),
                                    F.percentile("w", F.lit(0.5)).alias("b")), "g")
    assert [r["quantile"] for r in got] == pytest.approx(
        [v for r in want for v in (r["a"], r["b"])])


def test_history_before_is_strict_and_skew_safe(spark):
    rnd = random.Random(5)
    start = dt.datetime(2020, 1, 1)
    def moment():
        return start + dt.timedelta(minutes=rnd.randint(0, 3000))
    events = [(1 if i % 3 == 0 else rnd.randint(2, 6), moment(), rnd.randint(0, 9))
              for i in range(400)]
    asked = [(e[0], e[1]) for e in events[:50]] + [(rnd.randint(1, 8), moment()) for _ in range(50)]
    got = ordered.history_before(
        spark.createDataFrame(asked, "k int, at timestamp_ntz"),
        spark.createDataFrame(events, "k int, at timestamp_ntz, v bigint"), "k", "at", ["v"])
    want = sorted((k, at, sum(v for ek, ea, v in events if ek == k and ea < at))
                  for k, at in set(asked))
    assert sorted((r["k"], r["at"], r["v"]) for r in got.collect()) == want


def test_basket_pairs_equal_brute_force(spark):
    """Orders of one to a hundred rows, counted by digits."""
    rnd = random.Random(11)
    items = [(1 if i % 3 == 0 else rnd.randint(2, 40), i, rnd.randint(0, 60)) for i in range(300)]
    category = {p: None if p % 10 == 0 else f"c{p % 4}" for p in range(61)}
    got = joins.basket_category_pairs(
        spark.createDataFrame(items, "order_id int, order_item_id int, product_id int"),
        spark.createDataFrame(list(category.items()),
                              "product_id int, product_category_name string"))
    want = {}
    for oa, _, a in items:
        for ob, _, b in items:
            if oa == ob and a < b:
                pair = category[a], category[b]
                want[pair] = want.get(pair, 0) + 1
    assert {(r["category_a"], r["category_b"]): r["co_purchase_count"]
            for r in got.collect()} == want


def test_ks_and_chi_square_of_equal_samples(spark, skewed):
    same = observe.feature_drift(skewed, skewed, ["v", "w"], {"id": 1.0})
    assert {(r["statistic"], r["drifted"]) for r in rows(same)} == {(0.0, False)}


def test_ks_of_disjoint_samples(spark):
    a = spark.range(100).select(F.col("id").cast("double").alias("x"))
    (r,) = rows(observe.ks_statistics(a, a.withColumn("x", F.col("x") + 1000), ["x"]))
    assert r["statistic"] == 1.0 and r["statistic"] > r["threshold"]


def test_psi_identical_shifted_and_empty_bins(spark):
    a = spark.range(1000).select(F.col("id").cast("double").alias("x"))
    assert one(observe.psi(a, a, "x"))["psi"] == 0
    moved = one(observe.psi(a, a.withColumn("x", F.col("x") + 10_000), "x"))["psi"]
    # Nine baseline bins are empty now; all of the current rows fall into the last.
    assert moved > 5


def test_version_at_against_a_range_join(spark):
    """Gaps, open ends, several versions in a slot, instants on a border, hot and unknown keys."""
    rng = random.Random(5)
    start = dt.datetime(2020, 1, 1)
    versions = []
    for k in range(8):
        day = rng.randint(0, 40)
        for n in range(rng.randint(0, 6)):
            stop = day + rng.choice([1, 2, 9, 40])
            versions.append((k, start + dt.timedelta(days=day), start + dt.timedelta(days=stop), f"v{k}-{n}"))
            day = stop + rng.choice([0, 0, 3])
        if k % 2:
            versions.append((k, start + dt.timedelta(days=day), None, f"open{k}"))
    facts = [(i, 1 if i % 3 == 0 else rng.randint(0, 9), start + dt.timedelta(hours=12 * rng.randint(-60, 400)))
             for i in range(600)]
    facts += [(600, None, start), (601, 1, None), (602, 1, versions[0][1])]
    f = spark.createDataFrame(facts, "id int, k int, at timestamp_ntz")
    v = spark.createDataFrame(versions, "k int, since timestamp_ntz, until timestamp_ntz, name string")
    want = {i: next((n for k2, a, b, n in versions if k2 == k and at and a <= at and (b is None or at < b)), None)
            for i, k, at in facts}
    for grain in ("month", "day"):
        got = ordered.version_at(f, v, "k", "at", "since", "until", ["name"], grain)
        assert {r.id: r.name for r in got.collect()} == want and got.columns == ["id", "k", "at", "name"]
    assert ordered.version_at(f, v.limit(0), "k", "at", "since", "until", ["name"]).filter("name IS NULL").count() == 603


def test_the_caller_may_choose_the_ranges(spark, skewed):
    for ranges in (1, 17):
        scan = ordered.ordered_scan(skewed, ["v", "id"], number="nr", running={"upto": "v"}, ranges=ranges)
        found = sorted((r.nr, r.id, r.upto) for r in scan.collect())
        upto = 0
        for nr, (v, i) in enumerate(sorted((r.v, r.id) for r in skewed.collect()), 1):
            upto += v
            assert found[nr - 1] == (nr, i, upto)


def test_basket_pairs_of_repeated_products_and_large_orders(spark):
    """Products listed twice count per listing, and an order beyond 256 products takes three digits."""
    items = [(1, i, i % 300) for i in range(310)] + [(2, 0, 5), (2, 1, 5), (2, 2, 7), (3, 0, 9), (4, 0, None), (4, 1, 1)]
    listed = [(p, f"c{p % 3}") for p in range(300)] + [(7, "again")]
    got = joins.basket_category_pairs(
        spark.createDataFrame(items, "order_id int, order_item_id int, product_id int"),
        spark.createDataFrame(listed, "product_id int, product_category_name string"))
    want = {}
    rows = [(o, p, c) for o, _, p in items for q, c in listed if p == q]
    for oa, a, ca in rows:
        for ob, b, cb in rows:
            if oa == ob and a < b:
                want[ca, cb] = want.get((ca, cb), 0) + 1
    assert {(r["category_a"], r["category_b"]): r["co_purchase_count"] for r in got.collect()} == want


def test_history_across_months_with_ties_and_nulls(spark):
    day = lambda m, d: dt.datetime(2020, m, d)
    events = [(1, day(1, 5), 3), (1, day(1, 5), 4), (1, day(3, 1), -9), (2, day(2, 2), 5), (None, day(1, 1), 7),
              (1, None, 8)]
    asked = [(1, day(1, 5), 10), (1, day(1, 6), 11), (1, day(2, 1), 12), (1, day(3, 1), 13), (1, day(4, 1), 14),
             (1, day(4, 1), 15), (2, day(1, 1), 16), (None, day(1, 1), 17), (3, day(5, 5), 18)]
    got = ordered.history_before(
        spark.createDataFrame(asked, "k int, at timestamp_ntz, id int"),
        spark.createDataFrame(events, "k int, at timestamp_ntz, v bigint"), "k", "at", ["v"], carry=["id"])
    assert {r["id"]: r["v"] for r in got.collect()} == {
        10: 0, 11: 7, 12: 7, 13: 7, 14: -2, 15: -2, 16: 0, 18: 0}
