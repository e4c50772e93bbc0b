"""Delay model on rows with a planted signal."""

import os
import random

import pytest
from pyspark.sql import functions as F

from storeloom.plans import features as ML
from storeloom.plans import gold as G
from tests.conftest import one, rows


@pytest.fixture(scope="module")
def features(spark):
    rnd = random.Random(1)
    data = []
    for i in range(600):
        rate = rnd.random() * 100
        data.append((i, rate, int(rnd.random() * 100 < rate), rnd.choice(["LOCAL", "NATIONAL"])))
    df = spark.createDataFrame(data, "order_id int, delay_rate_history double, is_delayed int, "
                                     "distance_category string")
    rest = {c: F.lit(1.0) for c in ML.NUMERIC if c != "delay_rate_history"}
    rest |= {c: F.lit(None).cast("string") for c in ML.CATEGORICAL if c != "distance_category"}
    return df.withColumns(rest).cache()


def test_model_finds_the_signal(spark, features):
    train, test = features.filter("order_id < 400"), features.filter("order_id >= 400")
    model = ML.train_delay_model(train, rounds=5, depth=3)
    scores = ML.score_orders(model, test)
    found = one(ML.rank_auc(scores, "delay_probability", "actual_outcome"))
    assert found["auc"] > 0.65 and found["sample_size"] == 200
    assert ML.feature_importance(model)[0][0] == "delay_rate_history"
    figures = one(ML.evaluate(scores))
    assert figures["orders"] == 200 and 0 < figures["f1"] <= 1
    levels = one(ML.risk_alert(scores, limit=0))
    assert levels["high"] + levels["medium"] + levels["low"] == 200
    assert levels["alert"] == (levels["high"] > 0)
    frame = lambda auc: spark.createDataFrame([(auc, 200)], "auc double, sample_size bigint")
    drift = one(ML.performance_drift(frame(0.8), frame(0.99), "2020-01-01 00:00:00"))
    assert drift["status"] == "CRITICAL" and drift["sample_size"] == 200
    assert [one(ML.performance_drift(frame(x), frame(0.8), "2020-01-01 00:00:00"))["status"]
            for x in (0.8, 0.75, 0.9)] == ["OK", "WARNING", "OK"]


def test_kept_model_and_predictions(spark, features, tmp_path):
    models, store = str(tmp_path / "models"), str(tmp_path / "predictions")
    train, later = features.filter("order_id < 400"), features.filter("order_id >= 400")
    model = ML.train_delay_model(train, rounds=3, depth=3)
    ML.save_model(model, models, "v1")
    ML.save_model(model, models, "v1")
    # A session of its own loads the model and scores alike.
    other = ML.load_model(models, "v1")
    plain = lambda m, df: sorted((r.order_id, r.delay_probability) for r in ML.predict(m, df).collect())
    assert plain(model, later) == plain(other, later)

    first, second = later.filter("order_id < 500"), later.filter("order_id >= 480")
    for at, rows_ in (("2020-01-01 06:00:00", first), ("2020-01-02 06:00:00", second), ("2020-01-02 06:00:00", second)):
        ML.save_predictions(ML.score_batch(other, rows_, "v1", at), store)
    ML.save_predictions(ML.score_batch(other, first, "v2", "2020-01-01 06:00:00"), store)
    held = lambda: ML.read_predictions(spark, store, "int")
    assert held().count() == 100 + 120 + 100 and held().select("prediction_id").distinct().count() == 320
    assert held().filter("actual_outcome IS NOT NULL OR risk_level IS NULL").count() == 0
    before = {d: os.stat(tmp_path / "predictions" / d).st_mtime_ns for d in ("predicted_on=2020-01-02",)}
    known = later.filter("order_id < 480").withColumn("is_delayed", F.when(F.col("order_id") % 2 == 0, F.col("is_delayed")))
    assert [str(d) for d in ML.fill_outcomes(spark, store, known, id_type="int")] == ["2020-01-01"]
    assert {d: os.stat(tmp_path / "predictions" / d).st_mtime_ns for d in before} == before
    assert held().filter("actual_outcome IS NOT NULL").count() == 80 and held().count() == 320
    assert ML.fill_outcomes(spark, store, known, id_type="int") == []
    days = ML.fill_outcomes(spark, store, later, since="2020-01-02", id_type="int")
    assert [str(d) for d in days] == ["2020-01-02"] and held().filter("actual_outcome IS NULL").count() == 120
    want = {r.order_id: r.is_delayed for r in later.collect()}
    assert all(r.actual_outcome in (None, want[r.order_id]) for r in held().collect())


def test_open_orders(spark):
    at = "order_purchase_timestamp"
    df = spark.sql("SELECT * FROM VALUES (1, timestamp_ntz'2020-01-01', NULL), (2, timestamp_ntz'2020-01-05', NULL), "
                   "(3, timestamp_ntz'2020-01-05', 1), (4, timestamp_ntz'2020-01-09', NULL), (5, NULL, NULL) "
                   f"AS t(order_id, {at}, is_delayed)")
    assert [r.order_id for r in ML.open_orders(df, "2020-01-08").collect()] == [2]


def test_importance_and_calibration_rows(spark, features):
    model = ML.train_delay_model(features, rounds=5, depth=3)
    found = rows(ML.importance_rows(spark, model), "rank")
    assert len(found) == len(ML.NUMERIC) + len(ML.CATEGORICAL) and found[0]["feature"] == "delay_rate_history"
    assert abs(sum(r["importance"] for r in found) - 1) < 1e-9
    scores = ML.score_orders(model, features)
    tenths = rows(ML.calibration(scores), "tile")
    assert [r["orders"] for r in tenths] == [60] * 10 and tenths[-1]["observed_rate"] > tenths[0]["observed_rate"] + 0.5
    # A constant model has no order.
    flat = scores.withColumn("delay_probability", F.lit(0.5))
    assert one(ML.rank_auc(flat, "delay_probability", "actual_outcome"))["auc"] == 0.5


def test_holidays_are_a_feature(spark):
    holidays = spark.sql("SELECT date'2020-01-01' AS date UNION ALL SELECT date'2020-01-01'")
    assert one(G.dim_date(spark, "2020-01-01", "2020-01-03", holidays).groupBy().agg(
        F.count("*").alias("days"), F.count_if("is_holiday").alias("free"))) == {"days": 3, "free": 1}


def test_many_categories_and_unknown_outcomes(spark, features):
    rows = features.withColumn("category_name", F.concat(F.lit("c"), F.col("order_id") % 300)).withColumn(
        "is_delayed", F.when(F.col("order_id") % 10 != 0, F.col("is_delayed")))
    scores = ML.score_orders(ML.train_delay_model(rows, rounds=2, depth=2), rows)
    assert scores.count() == 600 and scores.filter("delay_probability IS NULL").count() == 0
    assert one(ML.evaluate(scores))["orders"] == 540


def test_auc_counts_ties_half(spark):
    df = spark.createDataFrame([(0.1, 0), (0.5, 1), (0.5, 0), (0.9, 1), (None, 1), (0.3, None)],
                               "s double, y int")
    assert one(ML.rank_auc(df, "s", "y")) == {"auc": 0.875, "sample_size": 4}


def test_risk_levels_and_metrics_at_the_limits(spark):
    df = spark.createDataFrame([(0.71, 1), (0.7, 0), (0.4, 1), (0.39, 0)],
                               "delay_probability double, actual_outcome int")
    assert [r[0] for r in df.select(ML.risk_level("delay_probability")).collect()] == [
        "HIGH", "MEDIUM", "MEDIUM", "LOW"]
    r = one(ML.evaluate(df))
    assert (r["precision"], r["recall"], r["f1"]) == (0.5, 0.5, 0.5)


def test_temporal_split(spark):
    df = spark.sql("SELECT timestamp_ntz'2018-02-28 23:59:59' AS t UNION ALL "
                   "SELECT timestamp_ntz'2018-03-01' UNION ALL SELECT timestamp_ntz'2018-05-01'")
    out = ML.temporal_split(df, "t", "2018-03-01", "2018-05-01")
    assert [r["split"] for r in rows(out, "t")] == ["train", "val", "test"]


def test_retrain_rule():
    assert ML.should_retrain(31, 0) and ML.should_retrain(0, 11) and not ML.should_retrain(30, 10)


def test_features_of_missing_and_repeated_keys(spark):
    """Distinct counts leave NULL out, and only the main seller's history counts."""
    at = lambda s: F.lit(s).cast("timestamp_ntz")
    metrics = spark.createDataFrame([(1, 10.0, 4), (2, 5.0, 1)], "order_id int, total_order_value double, total_items int") \
        .withColumns({"order_purchase_timestamp": at("2020-02-01"), "order_estimated_delivery_date": at("2020-02-11"),
                      "is_late": F.lit(False)})
    items = spark.createDataFrame([(1, 7, 1), (1, 7, 2), (1, 8, 2), (1, None, None), (2, None, None)],
                                  "order_id int, product_id int, seller_id int")
    products = spark.createDataFrame([(7, 100, 10, "a"), (8, 300, 20, "b"), (8, 200, 30, "c")],
                                     "product_id int, product_weight_g int, product_volume_cm3 int, "
                                     "product_category_name string")
    routes = spark.createDataFrame([(1, 1, "S"), (1, 2, "N"), (9, 2, "N")], "order_id int, seller_id int, seller_region string") \
        .withColumns({"customer_region": F.lit("N"), "distance_category": F.lit("LOCAL"), "delay_days": F.lit(4),
                      "order_purchase_timestamp": F.when(F.col("order_id") == 9, at("2020-01-01")).otherwise(at("2020-02-01")),
                      "order_delivered_customer_date": F.when(F.col("order_id") == 9, at("2020-01-20")),
                      "is_late": F.when(F.col("order_id") == 9, True)})
    none = spark.createDataFrame([], "order_id int, payment_type string, payment_installments int, review_score int, "
                                     "review_creation_date timestamp_ntz")
    got = rows(ML.delay_features(metrics, items, products, routes, none, none), "order_id")
    assert [(r["unique_products"], r["unique_sellers"], r["weight_g"], r["category_name"], r["seller_region"],
             r["avg_delay_history"]) for r in got] == [
        (2, 2, 300, "b", "N", 4.0), (0, 0, None, "unknown", None, None)]
