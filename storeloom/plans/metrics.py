"""Customer scores, cohorts, KPI tables and business analyses."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storeloom.functions import columns as C
from storeloom.operators.aggregates import first_in_group
from storeloom.operators.ordered import ntile, ordered_scan

# Score codes of each customer segment, best first.
SEGMENTS = {
    "Champion": ["555", "554", "544", "545"],
    "Loyal": ["543", "444", "435", "355"],
    "At Risk": ["331", "321", "312", "221"],
}


# --- customers ------------------------------------------------------------------------------

def with_customer_column(orders: DataFrame, customers: DataFrame, col: str) -> DataFrame:
    """Orders with another customer column, such as the one that spans several customer ids."""
    if col in orders.columns:
        return orders
    return orders.join(customers.select("customer_id", col), "customer_id")


def rfm_scores(df: DataFrame, customer_col: str, n: int = 5) -> DataFrame:
    """NTILE scores of recency_days (fewer is better), frequency and monetary.

    Ties go by customer, so every score is one exact global order. The three orders come from one
    distributed scan over a row per customer and measure, of which only one carries the customer's
    columns.
    """
    wide = "decimal(22,2)"
    late = F.coalesce(-F.col("recency_days"), F.lit(10 ** 12)).cast(wide)  # unknown ones come last
    measures = {"r": late, "f": F.col("frequency").cast(wide), "m": F.col("monetary").cast(wide)}
    row = F.struct(*df.columns)
    tall = df.select(F.col(customer_col).alias("_who"), F.inline(F.array(*[
        F.struct(F.lit(m).alias("_measure"), v.alias("_value"),
                 (row if m == "r" else F.when(F.lit(False), row)).alias("_row_of"))
        for m, v in measures.items()])))
    tiles = ntile(tall, ["_value", "_who"], n, "_tile", within=["_measure"])
    scores = tiles.groupBy("_who").agg(
        F.any_value("_row_of", F.lit(True)).alias("_row_of"),
        *[F.max(F.when(F.col("_measure") == m, F.col("_tile"))).alias(f"{m}_score") for m in measures])
    return scores.select("_row_of.*", *[f"{m}_score" for m in measures])


def rfm_base(orders: DataFrame, items: DataFrame, customer_col: str, as_of: str) -> DataFrame:
    """Recency, frequency and monetary value of everyone who bought an item."""
    spent = items.groupBy("order_id").agg(
        F.sum(F.col("price") + F.col("freight_value")).alias("spent"))
    return (orders.select("order_id", customer_col, "order_purchase_timestamp")
            .join(spent, "order_id").groupBy(customer_col)
            .agg(F.max("order_purchase_timestamp").alias("last_purchase"),
                 F.count("*").alias("frequency"),
                 F.sum("spent").cast("decimal(20,2)").alias("monetary"))
            .withColumn("recency_days", C.days_until(as_of, "last_purchase")))


def rfm_segments(orders: DataFrame, items: DataFrame, customer_col: str, as_of: str) -> DataFrame:
    scored = rfm_scores(rfm_base(orders, items, customer_col, as_of), customer_col)
    code = F.concat(*[F.col(c).cast("string") for c in ("r_score", "f_score", "m_score")])
    segment = F.lit("Others")
    for name, codes in reversed(SEGMENTS.items()):
        segment = F.when(F.col("rfm_score").isin(*codes), name).otherwise(segment)
    return (scored.withColumn("rfm_score", code).withColumn("segment", segment)
            .select(customer_col, "recency_days", "frequency", "monetary", "r_score", "f_score",
                    "m_score", "rfm_score", "segment"))


def clv(metrics: DataFrame) -> DataFrame:
    """Mean order value x orders x active years (first to last order, at least one day)."""
    years = (F.datediff("last_order_date", "first_order_date") + 1) / 365
    value = C.ratio(F.col("total_spent"), F.col("total_orders"))
    return metrics.filter(F.col("total_orders") > 0).select(
        "customer_id", "total_orders", value.alias("mean_order_value"),
        F.round(years, 6).alias("active_years"),
        F.round(value * F.col("total_orders") * years, 2).alias("clv"))


def churned(metrics: DataFrame, as_of: str, months: int = 6) -> DataFrame:
    """Customers with orders, the last of them more than ``months`` ago."""
    limit = F.add_months(F.lit(as_of).cast("date"), -months)
    return metrics.filter(F.to_date("last_order_date") < limit).select(
        "customer_id", "last_order_date", "days_since_last_order", "total_spent")


# --- cohorts --------------------------------------------------------------------------------

def _cohort_months(orders: DataFrame, customer_col: str) -> DataFrame:
    """(customer, cohort_month, purchase_month), one row per active month.

    A customer collects distinct months only, so no set outgrows the calendar.
    """
    per_customer = (orders.groupBy(customer_col)
                    .agg(F.collect_set(C.month_start("order_purchase_timestamp")).alias("months")))
    return per_customer.select(customer_col, F.array_min("months").alias("cohort_month"),
                               F.explode("months").alias("purchase_month"))


def cohort_matrix(orders: DataFrame, customer_col: str = "customer_unique_id",
                  months: int = 4) -> DataFrame:
    gap = C.months_apart(F.col("purchase_month"), F.col("cohort_month"))
    return (_cohort_months(orders, customer_col).groupBy("cohort_month")
            .agg(*[F.count_if(gap == m).alias(f"month_{m}") for m in range(months)])
            .orderBy("cohort_month"))


def cohort_retention(orders: DataFrame, customer_col: str = "customer_unique_id") -> DataFrame:
    active = (_cohort_months(orders, customer_col).groupBy("cohort_month", "purchase_month")
              .agg(F.count("*").alias("customers")))
    # The window sees one row per month of a cohort.
    sized = first_in_group(active, "cohort_month", "purchase_month", "customers", "_size")
    return sized.select(
        "cohort_month", "purchase_month",
        C.months_apart(F.col("purchase_month"), F.col("cohort_month")).alias("month_number"),
        "customers", C.ratio(F.col("customers"), F.col("_size")).alias("retention_rate"))


# --- KPI tables -----------------------------------------------------------------------------

def _outcomes() -> list[Column]:
    done = F.col("is_late").isNotNull()
    return [C.ratio(F.sum(F.when(done, F.col("delay_days"))), F.count_if(done)).alias("avg_delay"),
            C.percentage(F.count_if(F.col("is_late")), F.count_if(done)).alias("pct_delayed")]


def agg_seller_performance(seller_orders: DataFrame) -> DataFrame:
    """By seller and purchase month; ``seller_orders`` has one row per (seller, order)."""
    return (seller_orders
            .groupBy("seller_id", C.month_start("order_purchase_timestamp").alias("year_month"))
            .agg(F.count("*").alias("orders"),
                 F.sum("revenue").cast("decimal(20,2)").alias("revenue"), *_outcomes(),
                 C.mean("review_score").alias("review_score"),
                 C.net_promoter("review_score").alias("nps")))


def category_orders(items: DataFrame, products: DataFrame, metrics: DataFrame) -> DataFrame:
    """One row per (category, order), with the order's outcome; NULL category is ``unknown``."""
    per_product = items.groupBy("order_id", "product_id").agg(F.sum("price").alias("money"))
    category = F.coalesce("product_category_name", F.lit("unknown")).alias("category")
    own = (per_product.join(products.select("product_id", category), "product_id")
           .groupBy("category", "order_id").agg(F.sum("money").alias("revenue")))
    return own.join(metrics.select("order_id", "order_purchase_timestamp", "delay_days",
                                   "is_late"), "order_id")


def agg_category_performance(category_orders: DataFrame) -> DataFrame:
    return (category_orders
            .groupBy("category", C.month_start("order_purchase_timestamp").alias("year_month"))
            .agg(F.count("*").alias("orders"),
                 F.sum("revenue").cast("decimal(20,2)").alias("revenue"), *_outcomes()))


def agg_geographic_analysis(routes: DataFrame) -> DataFrame:
    return (routes.groupBy("customer_region", "seller_region", "distance_category")
            .agg(F.count("*").alias("orders"), *_outcomes()))


# Targets named by the plan; other metrics have none.
KPI_TARGETS = {"on_time_pct": 90.0, "nps": 60.0}


def kpi_dashboard(metrics: DataFrame, targets: Mapping[str, float] = KPI_TARGETS) -> DataFrame:
    """One row per metric with its target, status and variance in percent of the target."""
    done = F.count_if(F.col("is_late").isNotNull())
    wide = metrics.agg(
        F.count("*").cast("double").alias("total_orders"),
        C.percentage(F.count_if(~F.col("is_late")), done).alias("on_time_pct"),
        C.mean("review_score").alias("avg_review"),
        F.sum("total_order_value").cast("double").alias("revenue"),
        C.net_promoter("review_score").alias("nps"))
    rows = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value"),
                              F.lit(targets.get(m)).cast("double").alias("target"))
                     for m in wide.columns])
    value, target = F.col("value"), F.col("target")
    return wide.select(F.inline(rows)).select(
        "metric", "value", "target",
        F.when(target.isNull(), "NO_TARGET").when(value >= target, "ON_TARGET")
         .otherwise("BELOW_TARGET").alias("status"),
        F.round(F.try_divide((value - target) * 100, target), 4).alias("variance_pct"))


# --- analyses -------------------------------------------------------------------------------

def delay_score_correlation(metrics: DataFrame) -> DataFrame:
    """Pearson correlation of delay days and review score over delivered, reviewed orders."""
    pairs = metrics.filter(F.col("is_late").isNotNull() & F.col("review_score").isNotNull())
    return pairs.agg(F.count("*").alias("orders"),
                     F.round(F.corr("delay_days", "review_score"), 6).alias("pearson_r"))


def pareto(df: DataFrame, entity: str, measure: str, share: float = 0.8) -> DataFrame:
    """Entities by falling measure with their running share; ``in_head`` marks the fewest that
    reach ``share`` of the total. ``df`` holds one row per entity."""
    scan = ordered_scan(df.select(entity, measure), [F.desc(measure), entity], number="rank",
                        running={"running": measure}, total="entities")
    total = F.col("running_total")
    before = C.ratio(F.col("running") - F.col(measure), total)
    return scan.select(entity, measure, "rank", "running", "entities",
                       C.ratio(F.col("running"), total).alias("running_share"),
                       (before < share).alias("in_head"))


def pareto_summary(ranked: DataFrame) -> DataFrame:
    """How many entities make up the head, and their share of all entities."""
    head = F.count_if(F.col("in_head"))
    return ranked.agg(F.count("*").alias("entities"), head.alias("head_entities"),
                      C.percentage(head, F.count("*")).alias("head_pct"))


def late_by_seller(seller_orders: DataFrame) -> DataFrame:
    return seller_orders.groupBy("seller_id").agg(
        F.count_if(F.col("is_late")).alias("late_orders"))


def seasonality(metrics: DataFrame) -> DataFrame:
    """Delay rate per calendar month and its distance from the overall rate in percent."""
    done = metrics.filter(F.col("is_late").isNotNull())
    late = F.count_if(F.col("is_late"))
    overall = done.agg(C.ratio(late * 100, F.count("*"))).scalar()
    per_month = done.groupBy(F.month("order_purchase_timestamp").alias("month")).agg(
        F.count("*").alias("orders"), late.alias("late_orders"),
        C.ratio(late * 100, F.count("*")).alias("delay_rate"))
    return per_month.withColumn("vs_mean_pct", F.round(F.try_divide(
        (F.col("delay_rate") - overall) * 100, overall), 4)).orderBy("month")


def category_risk(category_orders: DataFrame) -> DataFrame:
    """Delay rate per category over delivered orders, riskiest first."""
    late = F.count_if(F.col("is_late"))
    return (category_orders.filter(F.col("is_late").isNotNull()).groupBy("category")
            .agg(F.count("*").alias("orders"), late.alias("late_orders"),
                 C.percentage(late, F.count("*")).alias("delay_rate"))
            .orderBy(F.desc("delay_rate"), "category"))


def revenue_at_risk(metrics: DataFrame, scenarios: Sequence[float] = (0.1, 0.2, 0.3)) -> DataFrame:
    """Value of late orders per delay class and what each reduction of delays would keep."""
    late = (metrics.filter(F.col("delay_category") != "ON_TIME").groupBy("delay_category")
            .agg(F.count("*").alias("orders"),
                 F.sum("total_order_value").cast("decimal(20,2)").alias("revenue")))
    return (late.withColumn("reduction", F.explode(F.array(*[F.lit(float(s)) for s in scenarios])))
            .withColumn("revenue_kept", F.round(F.col("revenue").cast("double")
                                                * F.col("reduction"), 2)))
