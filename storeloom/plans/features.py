"""Delay prediction: features, split, model, scoring and monitoring."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import (
    SQLTransformer,
    StandardScaler,
    StringIndexer,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from storeloom.functions import columns as C
from storeloom.operators.ordered import history_before, ntile, ordered_scan
from storeloom.session import cut_lineage, ensure_checkpoint_dir
from storeloom.sources.writers import replace_partitions

NUMERIC = [
    "total_value", "total_items", "unique_products", "unique_sellers", "payment_count",
    "max_installments", "used_credit_card", "estimated_days", "weight_g", "volume_cm3",
    "avg_delay_history", "delay_rate_history", "avg_review_history", "is_same_region",
    "order_dow", "order_month", "is_weekend", "is_holiday"]
CATEGORICAL = ["size_category", "weight_category", "category_name", "seller_tier",
               "seller_region", "customer_region", "distance_category"]
LABEL = "is_delayed"


def seller_history_features(seller_orders: DataFrame, reviews: DataFrame,
                            carry: Sequence[str] | None = None,
                            asked: DataFrame | None = None) -> DataFrame:
    """Per (seller, purchase moment): what was known of the seller strictly before it. With
    ``carry``, per row of ``seller_orders``, with those columns. ``asked`` are the rows of it to answer
    for, all where it is not given.

    A delay counts from its delivery on and a score from its review on, never from the earlier
    purchase. ``seller_orders`` has one row per (seller, order).
    """
    seen, nil = F.col("order_delivered_customer_date"), F.lit(0).cast("bigint")
    delays = seller_orders.filter(seen.isNotNull()).select(
        "seller_id", seen.alias("at"), F.lit(1).cast("bigint").alias("deliveries"),
        F.col("delay_days").cast("bigint").alias("delay_sum"),
        F.col("is_late").cast("bigint").alias("late"), nil.alias("scores"), nil.alias("score_sum"))
    scores = (reviews.select("order_id", "review_score", "review_creation_date")
              .join(seller_orders.select("seller_id", "order_id"), "order_id")
              .select("seller_id", F.col("review_creation_date").alias("at"),
                      nil.alias("deliveries"), nil.alias("delay_sum"), nil.alias("late"),
                      F.col("review_score").isNotNull().cast("bigint").alias("scores"),
                      F.coalesce("review_score", F.lit(0)).cast("bigint").alias("score_sum")))
    asked = (seller_orders if asked is None else asked).select("seller_id", F.col("order_purchase_timestamp").alias("at"), *(carry or []))
    sums = history_before(asked, delays.unionByName(scores), "seller_id", "at",
                          ["deliveries", "delay_sum", "late", "scores", "score_sum"], carry=carry)
    rate = C.ratio(F.col("late") * 100, F.col("deliveries"))
    return sums.select(
        "seller_id", F.col("at").alias("order_purchase_timestamp"), *(carry or []),
        F.col("deliveries").alias("deliveries_before"),
        C.ratio(F.col("delay_sum"), F.col("deliveries")).alias("avg_delay_history"),
        rate.alias("delay_rate_history"),
        C.ratio(F.col("score_sum"), F.col("scores")).alias("avg_review_history"),
        C.seller_tier(rate).alias("seller_tier"))


def delay_features(metrics: DataFrame, items: DataFrame, products: DataFrame,
                   routes: DataFrame, payments: DataFrame, reviews: DataFrame,
                   holidays: DataFrame | None = None) -> DataFrame:
    """25 features and the target per order; the target of an order not delivered yet is NULL.

    Product, seller and route features describe the order's heaviest product (ties: the largest
    product id, then seller id). ``routes`` has one row per (seller, order).
    """
    bought = F.col("order_purchase_timestamp")
    asked = metrics.select(
        "order_id", "order_purchase_timestamp", "order_estimated_delivery_date",
        F.col("total_order_value").cast("double").alias("total_value"), "total_items",
        F.col("is_late").cast("int").alias(LABEL))
    per_product = items.select("order_id", "product_id", "seller_id").join(
        products.select("product_id", "product_weight_g", "product_volume_cm3", "product_category_name"),
        "product_id", "left")
    main = F.max(F.struct("product_weight_g", "product_id", "seller_id", "product_volume_cm3",
                          "product_category_name"))
    # Ranks within an order, instead of distinct counts that triple the rows and send them twice. The rank of
    # NULL comes first and does not count.
    order = Window.partitionBy("order_id")
    ranked = per_product.withColumns({f"_{c}": F.dense_rank().over(order.orderBy(c))
                                      for c in ("product_id", "seller_id")})
    distinct = lambda c: (F.max(f"_{c}") - F.max(F.col(c).isNull().cast("int"))).cast("bigint")
    basket = cut_lineage(ranked.groupBy("order_id").agg(
        distinct("product_id").alias("unique_products"), distinct("seller_id").alias("unique_sellers"),
        main.alias("m")))
    told = cut_lineage(routes.select(
        "order_id", "seller_id", "order_purchase_timestamp", "order_delivered_customer_date", "delay_days",
        "is_late", "seller_region", "customer_region", "distance_category")
        .join(basket.select("order_id", F.col("m.seller_id").alias("_main")), "order_id", "left")
        .withColumn("_main", F.coalesce(F.col("seller_id") == F.col("_main"), F.lit(False))))
    paid = payments.groupBy("order_id").agg(
        F.count("*").alias("payment_count"), F.max("payment_installments").alias("max_installments"),
        F.max(F.coalesce((C.clean_lower("payment_type") == "credit_card").cast("int"), F.lit(0)))
        .alias("used_credit_card"))
    history = seller_history_features(
        told, reviews, ["order_id", "seller_region", "customer_region", "distance_category"],
        told.filter("_main")).drop("order_purchase_timestamp").withColumnsRenamed(
        {"order_id": "_order", "seller_id": "_seller"})
    # By order alone, as the rows lie; the seller is a test, which an equality would make a second key.
    same = (F.col("order_id") == F.col("_order")) & F.coalesce(
        F.col("m.seller_id") == F.col("_seller"), F.lit(False))
    rows = asked.join(basket, "order_id").join(paid, "order_id", "left").join(history, same, "left")
    weekday = F.weekday(bought) + 1
    rows = rows.withColumn("is_holiday", F.lit(0))
    if holidays is not None:
        free = holidays.select(F.col("date").cast("date").alias("_day")).distinct()
        rows = (rows.drop("is_holiday").join(free, F.to_date(bought) == F.col("_day"), "left")
                .withColumn("is_holiday", F.col("_day").isNotNull().cast("int")))
    return rows.select(
        "order_id", "order_purchase_timestamp", "total_value", "total_items", "unique_products",
        "unique_sellers", "payment_count", "max_installments", "used_credit_card",
        C.elapsed_days("order_estimated_delivery_date", bought).alias("estimated_days"),
        F.col("m.product_weight_g").alias("weight_g"),
        F.col("m.product_volume_cm3").alias("volume_cm3"),
        C.size_category(F.col("m.product_volume_cm3")).alias("size_category"),
        C.weight_category(F.col("m.product_weight_g")).alias("weight_category"),
        F.coalesce(F.col("m.product_category_name"), F.lit("unknown")).alias("category_name"),
        "avg_delay_history", "delay_rate_history", "avg_review_history", "seller_tier",
        "seller_region", "customer_region", "distance_category",
        (F.col("seller_region") == F.col("customer_region")).cast("int").alias("is_same_region"),
        weekday.alias("order_dow"), F.month(bought).alias("order_month"),
        (weekday >= 6).cast("int").alias("is_weekend"), "is_holiday", LABEL)


def temporal_split(df: DataFrame, ts: str, train_end: str, val_end: str) -> DataFrame:
    """``split``: train before ``train_end``, val before ``val_end``, test from there on."""
    at = F.col(ts)
    return df.withColumn("split", F.when(at < F.lit(train_end).cast("timestamp_ntz"), "train")
                         .when(at < F.lit(val_end).cast("timestamp_ntz"), "val")
                         .when(at.isNotNull(), "test"))


def split_counts(split: DataFrame) -> DataFrame:
    return split.groupBy("split").agg(F.count("*").alias("orders"),
                                      F.sum(LABEL).alias("delayed"))


def _prepared(df: DataFrame) -> DataFrame:
    """Doubles with -1 for missing numbers, text with ``missing``."""
    return df.withColumns(
        {c: F.coalesce(F.col(c).cast("double"), F.lit(-1.0)) for c in NUMERIC}
        | {c: F.coalesce(F.col(c), F.lit("missing")) for c in CATEGORICAL})


def train_delay_model(train: DataFrame, val: DataFrame | None = None, rounds: int = 100,
                      depth: int = 6, step: float = 0.1, positive_weight: float = 1.8,
                      seed: int = 7) -> PipelineModel:
    """Encoders, scaler and boosted trees; ``val`` rows stop the rounds early.

    Labels become plain numbers, so that a column may have any number of them. Their list is
    fitted on the driver: these columns are categories, not keys.
    """
    ensure_checkpoint_dir(train.sparkSession)
    rows = _prepared(train).withColumn("_val", F.lit(False))
    if val is not None:
        rows = rows.unionByName(_prepared(val).withColumn("_val", F.lit(True)))
    rows = rows.filter(F.col(LABEL).isNotNull()).withColumns({
        "_label": F.col(LABEL).cast("double"),
        "_weight": F.when(F.col(LABEL) == 1, positive_weight).otherwise(1.0)})
    coded = [f"{c}_code" for c in CATEGORICAL]
    # A computed column loses the list of labels, which would make the trees ask for one bin each.
    numbers = ", ".join(f"{c}_code + 0.0 AS {c}_number" for c in CATEGORICAL)
    trees = GBTClassifier(featuresCol="features", labelCol="_label", weightCol="_weight",
                          maxIter=rounds, maxDepth=depth, stepSize=step, seed=seed,
                          checkpointInterval=10)
    if val is not None:
        trees = trees.setValidationIndicatorCol("_val")
    return Pipeline(stages=[
        StringIndexer(inputCols=CATEGORICAL, outputCols=coded, handleInvalid="keep"),
        SQLTransformer(statement=f"SELECT *, {numbers} FROM __THIS__"),
        VectorAssembler(inputCols=NUMERIC, outputCol="_numbers"),
        StandardScaler(inputCol="_numbers", outputCol="_scaled", withMean=True),
        VectorAssembler(inputCols=["_scaled", *[f"{c}_number" for c in CATEGORICAL]],
                        outputCol="features"),
        trees]).fit(rows)


def predict(model: PipelineModel, features: DataFrame) -> DataFrame:
    """``order_id``, ``delay_probability`` and, where known, the outcome."""
    out = model.transform(_prepared(features))
    outcome = [F.col(LABEL).alias("actual_outcome")] if LABEL in features.columns else []
    return out.select("order_id", vector_to_array("probability")[1].alias("delay_probability"),
                      *outcome)


def rank_auc(scored: DataFrame, score: str, outcome: str) -> DataFrame:
    """One row: area under the ROC curve and the rows it is taken over, those with both values.

    The share of pairs of a positive and a negative row that the score orders rightly, ties half:
    exact, from running sums over the distinct scores.
    """
    hit = F.col(outcome).cast("bigint")
    counts = (scored.filter(F.col(score).isNotNull() & hit.isNotNull()).groupBy(score)
              .agg(F.sum(hit).alias("pos"), F.sum(1 - hit).alias("neg")))
    line = ordered_scan(counts, [score], running={"below": "neg"})
    pairs = F.sum(F.col("pos") * (2 * F.col("below") - F.col("neg")))
    return line.agg(C.ratio(pairs, 2 * F.sum("pos") * F.sum("neg")).alias("auc"),
                    F.coalesce(F.sum(F.col("pos") + F.col("neg")), F.lit(0)).alias("sample_size"))


def evaluate(predictions: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Precision, recall and F1 at the threshold over known outcomes, in one pass."""
    said, was = F.col("delay_probability") >= threshold, F.col("actual_outcome") == 1
    tp, fp = F.count_if(said & was), F.count_if(said & ~was)
    fn = F.count_if(~said & was)
    return predictions.filter(F.col("actual_outcome").isNotNull()).agg(
        F.count("*").alias("orders"), tp.alias("true_positive"), fp.alias("false_positive"),
        fn.alias("false_negative"), C.ratio(tp, tp + fp).alias("precision"),
        C.ratio(tp, tp + fn).alias("recall"), C.ratio(tp * 2, tp * 2 + fp + fn).alias("f1"))


def feature_importance(model: PipelineModel) -> list[tuple[str, float]]:
    """(feature, importance), most important first."""
    weights = model.stages[-1].featureImportances.toArray()
    return sorted(zip([*NUMERIC, *CATEGORICAL], map(float, weights)), key=lambda t: -t[1])


def importance_rows(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """``rank, feature, importance``, one row per feature; the importances add up to 1."""
    return spark.createDataFrame(
        [(i, f, w) for i, (f, w) in enumerate(feature_importance(model), 1)],
        "rank int, feature string, importance double")


def calibration(predictions: DataFrame, groups: int = 10) -> DataFrame:
    """Known outcomes in equal groups by rising probability: predicted and observed rate."""
    known = predictions.filter(F.col("actual_outcome").isNotNull())
    tiles = ntile(known, ["delay_probability", "order_id"], groups, "tile")
    return tiles.groupBy("tile").agg(
        F.count("*").alias("orders"), C.mean("delay_probability").alias("predicted_rate"),
        C.mean("actual_outcome").alias("observed_rate"))


def risk_level(probability: str | Column) -> Column:
    p = F.col(probability) if isinstance(probability, str) else probability
    return F.when(p > 0.7, "HIGH").when(p >= 0.4, "MEDIUM").when(p < 0.4, "LOW")


def score_orders(model: PipelineModel, features: DataFrame, version: str = "v1") -> DataFrame:
    return predict(model, features).withColumn("risk_level", risk_level("delay_probability")) \
        .withColumn("model_version", F.lit(version))


# --- kept models and predictions ------------------------------------------------------------

PREDICTIONS = ("prediction_id string, order_id {}, delay_probability double, risk_level string, "
               "predicted_at timestamp_ntz, actual_outcome int, predicted_on date, model_version string")


def save_model(model: PipelineModel, folder: str, version: str) -> None:
    """Keep a fitted pipeline under its version; the same version again replaces it."""
    model.write().overwrite().save(f"{folder}/{version}")


def load_model(folder: str, version: str) -> PipelineModel:
    return PipelineModel.load(f"{folder}/{version}")


def open_orders(features: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    """Orders of the last ``days`` before a moment that are not delivered yet."""
    now, at = F.lit(as_of).cast("timestamp_ntz"), F.col("order_purchase_timestamp")
    return features.filter(F.col(LABEL).isNull() & (at <= now) & (at > now - F.make_dt_interval(F.lit(days))))


def score_batch(model: PipelineModel, features: DataFrame, version: str, predicted_at: str) -> DataFrame:
    """Predictions of one batch as they are kept: an id of their own, and no outcome yet."""
    rows = score_orders(model, features.drop(LABEL), version).withColumns({
        "predicted_at": F.lit(predicted_at).cast("timestamp_ntz"),
        "predicted_on": F.lit(predicted_at).cast("date"), "actual_outcome": F.lit(None).cast("int")})
    rows = rows.withColumn("prediction_id", C.md5_key(["order_id", "model_version", "predicted_at"]))
    return rows.select(*[f.split()[0] for f in PREDICTIONS.split(", ")])


def save_predictions(scores: DataFrame, store: str) -> None:
    """One partition per day and model version; the same batch again replaces itself."""
    replace_partitions(scores, store, ["predicted_on", "model_version"])


def read_predictions(spark: SparkSession, store: str, id_type: str = "bigint") -> DataFrame:
    return spark.read.schema(PREDICTIONS.format(id_type)).parquet(store)


def fill_outcomes(spark: SparkSession, store: str, outcomes: DataFrame, since: str | None = None,
                  id_type: str = "bigint") -> list:
    """Write outcomes (``order_id`` and the label, NULL while unknown) into the predictions that
    wait for them; returns the days written.

    Only days with such predictions are read whole and replaced, from ``since`` on where that is
    given. Known outcomes stay, so the same outcomes twice change nothing.
    """
    held = read_predictions(spark, store, id_type)
    if since is not None:
        held = held.filter(F.col("predicted_on") >= F.lit(since).cast("date"))
    known = outcomes.filter(F.col(LABEL).isNotNull()).groupBy("order_id").agg(F.max(LABEL).alias("_known"))
    waiting = held.filter(F.col("actual_outcome").isNull()).join(known, "order_id", "left_semi")
    # One row per day.
    days = sorted(r[0] for r in waiting.select("predicted_on").distinct().collect())
    if days:
        filled = (held.filter(F.col("predicted_on").isin(days)).join(known, "order_id", "left")
                  .withColumn("actual_outcome", F.coalesce("actual_outcome", "_known").cast("int")))
        replace_partitions(filled.select(*held.columns), store, ["predicted_on", "model_version"])
    return days


def risk_alert(scores: DataFrame, limit: int = 50) -> DataFrame:
    """Orders per risk level and whether the HIGH ones call for an alert."""
    high = F.count_if(F.col("risk_level") == "HIGH")
    return scores.agg(high.alias("high"), F.count_if(F.col("risk_level") == "MEDIUM").alias("medium"),
                      F.count_if(F.col("risk_level") == "LOW").alias("low"),
                      (high > limit).alias("alert"))


def performance_drift(current: DataFrame, baseline: DataFrame, checked_at: str) -> DataFrame:
    """One row: the current AUC, its drop from the baseline's in percent, and the level of that.
    Both are rows of ``rank_auc``."""
    drop = (F.col("auc_baseline") - F.col("auc_current")) / F.col("auc_baseline") * 100
    both = current.select(F.col("auc").alias("auc_current"), "sample_size").withColumn(
        "auc_baseline", baseline.select("auc").scalar())
    return both.select(
        F.lit(checked_at).cast("timestamp_ntz").alias("checked_at"), "auc_current", "auc_baseline",
        drop.alias("auc_drop"), "sample_size",
        F.when(drop > 10, "CRITICAL").when(drop > 5, "WARNING").otherwise("OK").alias("status"))


def should_retrain(drift_share: float, auc_drop: float) -> bool:
    return drift_share > 30 or auc_drop > 10
