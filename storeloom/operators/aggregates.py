"""Aggregations and the documented reporting queries.

Two habits keep them whole at scale: measures are aggregated on the fact's own keys before any
dimension is joined, and shares of a total divide by a scalar subquery instead of an
unpartitioned window.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storeloom.functions import columns as C


# --- profiles -------------------------------------------------------------------------------

def profile(df: DataFrame, pk: Sequence[str]) -> DataFrame:
    """Rows, distinct keys and NULLs per column in one pass."""
    key = F.struct(*pk) if len(pk) > 1 else F.col(pk[0])
    return df.agg(F.count("*").alias("total_records"), F.countDistinct(key).alias("unique_pks"),
                  *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in df.columns])


def composite_distinct(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct key tuples; a tuple with NULL parts counts too."""
    return df.agg(F.countDistinct(F.struct(*keys)).alias("unique_keys"))


#: A figure of a summary: how a group of rows gives its parts, how parts are merged, and the result.
Figure = tuple[dict[str, Callable[[Column], Column]], Callable[[Column], Column],
               Callable[[dict[str, Column]], Column]]


def _figure(merge, **parts) -> Figure:
    return parts, merge, lambda p: next(iter(p.values()))


def rows_counted() -> Figure:
    return _figure(F.sum, n=F.count_if)


def counted(col: str) -> Figure:
    return _figure(F.sum, n=lambda own: F.count(F.when(own, F.col(col))))


def counted_if(condition: Column) -> Figure:
    return _figure(F.sum, n=lambda own: F.count_if(own & condition))


def nulls(col: str) -> Figure:
    return counted_if(F.col(col).isNull())


def summed(col: str) -> Figure:
    return _figure(F.sum, s=lambda own: F.sum(F.when(own, F.col(col))))


def largest(col: str) -> Figure:
    return _figure(F.max, m=lambda own: F.max(F.when(own, F.col(col))))


def smallest(col: str) -> Figure:
    return _figure(F.min, m=lambda own: F.min(F.when(own, F.col(col))))


def averaged(col: str) -> Figure:
    parts = {"s": lambda own: F.sum(F.when(own, F.col(col))), "n": lambda own: F.count(F.when(own, F.col(col)))}
    return parts, F.sum, lambda p: F.try_divide(p["s"].cast("double"), p["n"])


def summary(df: DataFrame, figures: Mapping[str, Figure | str]) -> DataFrame:
    """One row of figures; a column name stands for the number of its distinct values.

    One scan, whatever the number of distinct counts: each row gives one (column, value) entry
    for each of them, entries are counted by value on the map side first, and the first column's entries
    carry the other figures. Spark's own plan for several DISTINCTs repeats each row, with all its
    columns, once more than there are of them.
    """
    distinct = [f for f in figures.values() if isinstance(f, str)] or [df.columns[0]]
    kinds = {df.schema[c].dataType for c in distinct}
    entries = [F.struct(F.lit(i).alias("which"), (F.col(c) if len(kinds) == 1 else F.col(c).cast("string"))
                        .alias("value")) for i, c in enumerate(distinct)]
    own = F.col("_entry.which") == 0
    parts = {f"{name}_{p}": (of(own), merge) for name, figure in figures.items()
             if not isinstance(figure, str) for (made, merge, _) in [figure] for p, of in made.items()}
    tall = df.select("*", F.explode(F.array(*entries)).alias("_entry"))
    groups = tall.groupBy(F.col("_entry.which").alias("which"), F.col("_entry.value").alias("value")).agg(
        *([c.alias(f"_{n}") for n, (c, _) in parts.items()] or [F.count("*").alias("_any")]))
    merged = groups.agg(
        *[F.count_if((F.col("which") == i) & F.col("value").isNotNull()).alias(f"_distinct_{i}")
          for i in range(len(distinct))],
        *[merge(f"_{n}").alias(f"_{n}") for n, (_, merge) in parts.items()])

    def result(name: str, figure: Figure | str) -> Column:
        if isinstance(figure, str):
            return F.col(f"_distinct_{distinct.index(figure)}")
        made, merge, final = figure
        value = final({p: F.col(f"_{name}_{p}") for p in made})
        counts = merge is F.sum and list(made) == ["n"]
        return F.coalesce(value, F.lit(0)) if counts else value

    return merged.select(*[result(n, f).alias(n) for n, f in figures.items()])


def bronze_summary(table: str, df: DataFrame) -> DataFrame:
    """The post-load summary of one bronze table."""
    figures = {
        "customers": lambda: {
            "total_records": rows_counted(), "unique_customers": "customer_id",
            "unique_customer_unique_ids": "customer_unique_id", "unique_states": "customer_state",
            "null_pks": nulls("customer_id")},
        "sellers": lambda: {
            "total_records": rows_counted(), "unique_sellers": "seller_id",
            "unique_states": "seller_state", "unique_cities": "seller_city",
            "null_pks": nulls("seller_id"), "null_states": nulls("seller_state")},
        "products": lambda: {
            "total_records": rows_counted(), "unique_products": "product_id",
            "unique_categories": "product_category_name", "null_pks": nulls("product_id"),
            "null_categories": nulls("product_category_name"),
            "null_weights": nulls("product_weight_g"), "avg_weight": averaged("product_weight_g"),
            "max_weight": largest("product_weight_g")},
        "orders": lambda: {
            "total_records": rows_counted(), "unique_orders": "order_id",
            "unique_customers": "customer_id", "null_pks": nulls("order_id"),
            "null_fks": nulls("customer_id"),
            "delivered_orders": counted_if(C.clean_lower("order_status") == "delivered"),
            "null_delivery_dates": nulls("order_delivered_customer_date")},
        "order_items": lambda: {
            "total_records": rows_counted(), "unique_orders": "order_id",
            "unique_products": "product_id", "unique_sellers": "seller_id",
            "avg_price": averaged("price"), "avg_freight": averaged("freight_value"),
            "max_price": largest("price"), "min_price": smallest("price")},
        "order_payments": lambda: {
            "total_records": rows_counted(), "unique_orders": "order_id",
            "unique_payment_types": "payment_type", "avg_payment": averaged("payment_value"),
            "total_payment": summed("payment_value"),
            "avg_installments": averaged("payment_installments"),
            "max_installments": largest("payment_installments")},
        "order_reviews": lambda: {
            "total_records": rows_counted(), "unique_reviews": "review_id",
            "unique_orders": "order_id", "avg_score": averaged("review_score"),
            "reviews_with_title": counted("review_comment_title"),
            "reviews_with_message": counted("review_comment_message")},
        "geolocation": lambda: {
            "total_records": rows_counted(), "unique_zips": "geolocation_zip_code_prefix",
            "unique_states": "geolocation_state", "unique_cities": "geolocation_city"},
    }
    return summary(df, figures[table]())


# --- distributions --------------------------------------------------------------------------

def distribution(df: DataFrame, col: str, measures: Mapping[str, Column] | None = None) -> DataFrame:
    """Rows and share per value, with further measures."""
    groups = df.groupBy(col).agg(
        F.count("*").alias("total"),
        *[c.alias(name) for name, c in (measures or {}).items()])
    return groups.withColumn("percentage", C.percentage(
        F.col("total"), groups.agg(F.sum("total")).scalar()))


def top_k(df: DataFrame, col: str, k: int, where: Column | None = None,
          measures: Mapping[str, Column] | None = None) -> DataFrame:
    """The k most frequent values; ties go by value."""
    rows = df if where is None else df.filter(where)
    return (rows.groupBy(col).agg(F.count("*").alias("total"),
                                  *[c.alias(name) for name, c in (measures or {}).items()])
            .orderBy(F.desc("total"), col).limit(k))


def items_per_position(items: DataFrame, k: int = 10) -> DataFrame:
    return (items.groupBy("order_item_id").agg(F.count("*").alias("total_orders"))
            .orderBy("order_item_id").limit(k))


def fk_cardinality(items: DataFrame) -> DataFrame:
    return summary(items, {"unique_orders": "order_id", "unique_products": "product_id",
                           "unique_sellers": "seller_id"})


def flag_rates(df: DataFrame, flags: Sequence[str],
               measures: Mapping[str, Column] | None = None) -> DataFrame:
    """Rows, rows with each flag, the share of each flag, and further measures."""
    out = [F.count("*").alias("total")]
    for flag in flags:
        hit = F.count_if(F.col(flag))
        out += [hit.alias(f"{flag}_count"), C.percentage(hit, F.count("*")).alias(f"{flag}_pct")]
    return df.agg(*out, *[c.alias(name) for name, c in (measures or {}).items()])


def avg_positive(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Average over positive values only."""
    return df.agg(*[C.mean(F.when(F.col(c) > 0, F.col(c))).alias(f"avg_{c}") for c in cols])


def geo_enrichment_summary(df: DataFrame) -> DataFrame:
    found = F.count_if(F.col("has_geolocation"))
    return df.agg(F.count("*").alias("total"), found.alias("with_geo"),
                  F.count_if(~F.col("has_geolocation")).alias("without_geo"),
                  C.percentage(found, F.count("*")).alias("geo_enrichment_pct"),
                  *[f(c).alias(f"{f.__name__}_{c[-3:]}") for c in
                    ("geolocation_lat", "geolocation_lng") for f in (F.min, F.max)])


def csv_statistics(payments: DataFrame) -> DataFrame:
    """Raw-text statistics of one load: per payment type, with the value mean and sum."""
    return payments.groupBy("payment_type").agg(
        F.count("*").alias("total"), C.mean("payment_value").alias("mean_value"),
        F.sum("payment_value").alias("sum_value"))


def item_statistics(items: DataFrame) -> DataFrame:
    """Statistics of one load of items: keys, means and missing values."""
    keys = ["order_id", "product_id", "seller_id"]
    return summary(items, {
        "total": rows_counted(), "mean_price": averaged("price"),
        "mean_freight_value": averaged("freight_value"),
        **{f"null_{c}": nulls(c) for c in (*keys, "price", "freight_value")},
        **{f"unique_{k[:-3]}s": k for k in keys}})


def review_statistics(reviews: DataFrame) -> DataFrame:
    """Statistics of one load of reviews: per score, with a title and with a message."""
    return reviews.groupBy("review_score").agg(
        F.count("*").alias("total"), F.count("review_comment_title").alias("with_title"),
        F.count("review_comment_message").alias("with_message"))


# --- orders, payments, reviews --------------------------------------------------------------

def order_totals(items: DataFrame) -> DataFrame:
    return items.groupBy("order_id").agg(
        F.sum(F.col("price") + F.col("freight_value")).alias("total"))


def average_ticket(items: DataFrame) -> DataFrame:
    return order_totals(items).agg(C.mean("total").alias("avg_ticket"))


def multi_item_orders(items: DataFrame) -> DataFrame:
    return (items.groupBy("order_id")
            .agg(F.count("*").alias("num_items"), F.sum("price").alias("total_price"),
                 F.sum("freight_value").alias("total_freight"))
            .filter(F.col("num_items") > 1).orderBy(F.desc("num_items"), "order_id"))


def multi_payment_summary(payments: DataFrame) -> DataFrame:
    per_order = payments.groupBy("order_id").agg(F.count("*").alias("n"))
    return per_order.agg(F.count("order_id").alias("total_orders"),
                         F.count_if(F.col("n") > 1).alias("orders_multiple_payments"),
                         F.max("n").alias("max_payments_per_order"))


def payment_types_per_order(payments: DataFrame, distinct: bool = False,
                            min_payments: int = 1) -> DataFrame:
    """Sorted payment types per order as text.

    Types are counted per order first; only one (type, count) entry per type is ever collected
    for an order, and the text repeats each type as often as it was counted.
    """
    counted = payments.groupBy("order_id", "payment_type").agg(
        F.count("*").alias("n"), F.sum("payment_value").alias("value"))
    per_order = counted.groupBy("order_id").agg(
        F.sum("n").alias("num_payments"),
        F.sort_array(F.collect_list(F.when(F.col("payment_type").isNotNull(),
                                           F.struct("payment_type", "n")))).alias("runs"),
        F.sum("value").alias("total_value"))
    names = F.transform("runs", lambda r: r["payment_type"]) if distinct else F.flatten(
        F.transform("runs", lambda r: F.array_repeat(r["payment_type"], r["n"].cast("int"))))
    return (per_order.filter(F.col("num_payments") >= min_payments)
            .select("order_id", "num_payments", F.array_join(names, ", ").alias("payment_types"),
                    "total_value"))


def review_answer_rate(reviews: DataFrame) -> DataFrame:
    answered = F.count("review_answer_timestamp")
    return reviews.agg(answered.alias("answered"), F.count("*").alias("total"),
                       C.percentage(answered, F.count("*")).alias("answer_rate"))


def nps(df: DataFrame, score: str = "review_score", by: str | None = None) -> DataFrame:
    """Share of 5s minus share of scores up to 2, in points."""
    groups = df.groupBy(by) if by else df.groupBy()
    return groups.agg(F.count(score).alias("answers"), C.net_promoter(score).alias("nps"))


def delivery_sla_monthly(orders: DataFrame) -> DataFrame:
    """Delivered orders by purchase month: counts, average days, late share."""
    delivered, promised = "order_delivered_customer_date", "order_estimated_delivery_date"
    bought = "order_purchase_timestamp"
    late, done = F.count_if(C.is_late(delivered, promised)), F.count(delivered)
    return (orders.filter(C.clean_lower("order_status") == "delivered")
            .groupBy(C.month_start(bought).alias("month"))
            .agg(F.count("*").alias("total_orders"), done.alias("delivered_orders"),
                 C.mean(C.elapsed_days(delivered, bought)).alias("avg_delivery_days"),
                 C.mean(C.elapsed_days(promised, bought)).alias("avg_estimated_days"),
                 late.alias("late_deliveries"),
                 C.percentage(late, done).alias("late_delivery_rate"))
            .orderBy("month"))


# --- customers, sellers, categories ---------------------------------------------------------

def repeat_customers(customers: DataFrame) -> DataFrame:
    return (customers.groupBy("customer_unique_id")
            .agg(F.countDistinct("customer_id").alias("num_orders"))
            .filter(F.col("num_orders") > 1))


def _per_order_reviews(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("order_id").agg(
        F.sum("review_score").alias("score_sum"), F.count("review_score").alias("scores"),
        F.count_if(F.col("review_score") <= 2).alias("negative"),
        F.count_if(F.col("review_score") == 5).alias("five_star"),
        F.count("*").alias("reviews"))


def top_sellers(sellers: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    sales = items.groupBy("seller_id").agg(F.count("order_id").alias("total_sales"),
                                           F.sum("price").alias("revenue"))
    return (sales.join(sellers.select("seller_id", "seller_city", "seller_state"), "seller_id")
            .select("seller_id", "seller_city", "seller_state", "total_sales", "revenue")
            .orderBy(F.desc("revenue"), "seller_id").limit(k))


def top_categories(products: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """By revenue. Items are summed per product before the category is looked up."""
    sales = items.groupBy("product_id").agg(
        F.count("order_id").alias("sales"), F.sum("price").alias("money"),
        F.count("price").alias("priced"))
    return (sales.join(products.select("product_id", "product_category_name"), "product_id")
            .groupBy("product_category_name")
            .agg(F.sum("sales").alias("total_sales"),
                 F.sum("money").cast("decimal(20,2)").alias("revenue"),
                 C.ratio(F.sum("money"), F.sum("priced")).alias("avg_price"))
            .orderBy(F.desc("revenue"), "product_category_name").limit(k))


def _delivered(orders: DataFrame) -> DataFrame:
    return orders.filter(C.clean_lower("order_status") == "delivered")


def top_categories_delivered(products: DataFrame, items: DataFrame, orders: DataFrame,
                             k: int = 10) -> DataFrame:
    """By revenue over delivered orders, with distinct orders per category.

    Money is summed per (order, product) and then per (category, order), so that one order
    counts once per category without a second pass.
    """
    sales = (items.join(_delivered(orders).select("order_id"), "order_id", "left_semi")
             .groupBy("order_id", "product_id").agg(F.sum("price").alias("money")))
    per_order = (sales.join(products.select("product_id", "product_category_name"), "product_id")
                 .groupBy("product_category_name", "order_id").agg(F.sum("money").alias("money")))
    return (per_order.groupBy("product_category_name")
            .agg(F.count("*").alias("total_orders"),
                 F.sum("money").cast("decimal(20,2)").alias("revenue"))
            .orderBy(F.desc("revenue"), "product_category_name").limit(k))


def sales_by_state(customers: DataFrame, orders: DataFrame, items: DataFrame) -> DataFrame:
    """Delivered orders and revenue per customer state; an order is one row of ``orders``."""
    money = order_totals(items)
    per_customer = (_delivered(orders).select("order_id", "customer_id").join(money, "order_id")
                    .groupBy("customer_id").agg(F.count("*").alias("n"),
                                                F.sum("total").alias("money")))
    return (per_customer.join(customers.select("customer_id", "customer_state"), "customer_id")
            .groupBy("customer_state")
            .agg(F.sum("n").alias("orders"),
                 F.sum("money").cast("decimal(20,2)").alias("revenue"))
            .orderBy(F.desc("revenue"), "customer_state"))


def seller_performance(sellers: DataFrame, items: DataFrame, reviews: DataFrame,
                       min_orders: int = 10) -> DataFrame:
    """Sellers with at least ``min_orders`` orders. As in the published join, an item and its price
    count once for each review of its order, and once without one; no row is multiplied here."""
    per_order = items.groupBy("seller_id", "order_id").agg(
        F.count("order_item_id").alias("items"), F.sum("price").alias("money"),
        F.count("price").alias("priced"))
    scored = per_order.join(_per_order_reviews(reviews), "order_id", "left")
    times = F.coalesce("reviews", F.lit(1))
    money, priced = F.sum(F.col("money") * times), F.sum(F.col("priced") * times)
    per_seller = (scored.groupBy("seller_id")
                  .agg(F.count("*").alias("num_orders"), F.sum(F.col("items") * times).alias("num_items"),
                       money.cast("decimal(20,2)").alias("total_revenue"),
                       C.ratio(money, priced).alias("avg_item_price"),
                       C.ratio(F.sum(F.col("items") * F.col("score_sum")),
                               F.sum(F.col("items") * F.col("scores"))).alias("avg_review_score"),
                       F.coalesce(F.sum(F.col("items") * F.col("negative")), F.lit(0))
                       .alias("negative_reviews"))
                  .filter(F.col("num_orders") >= min_orders))
    return (per_seller.join(sellers.select("seller_id", "seller_city", "seller_state"), "seller_id")
            .select("seller_id", "seller_city", "seller_state", "num_orders", "num_items",
                    "total_revenue", "avg_item_price", "avg_review_score", "negative_reviews")
            .orderBy(F.desc("total_revenue"), "seller_id"))


# --- set operations -------------------------------------------------------------------------

def union_metrics(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def first_in_group(df: DataFrame, by: str, order: str, value: str, name: str) -> DataFrame:
    """FIRST_VALUE over groups that hold one row per ``order`` value."""
    window = Window.partitionBy(by).orderBy(order)
    return df.withColumn(name, F.first(value).over(window))
