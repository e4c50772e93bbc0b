"""Enriched metrics, dimensions and facts.

Every child table is reduced to the grain of its parent before the two meet, so no join
multiplies rows and a hot key is combined on the map side first. Inputs are silver tables.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from storeloom.functions import columns as C
from storeloom.operators.joins import (LAT, LNG, ZIP,
                                       customer_seller_distance, one_coordinate_per_zip)
from storeloom.operators.ordered import ordered_scan, version_at
from storeloom.sources.schemas import BRAZIL_REGIONS
from storeloom.sources.writers import upsert_months

ACTIVE_MONTHS = 6


def is_active(last: str, as_of: str, months: int = ACTIVE_MONTHS) -> Column:
    """The date lies within the last ``months`` before ``as_of``; NULL dates are not active."""
    limit = F.add_months(F.lit(as_of).cast("date"), -months)
    return F.coalesce(F.to_date(last) >= limit, F.lit(False))


def delivered_only(orders: DataFrame) -> DataFrame:
    return orders.filter(C.clean_lower("order_status") == "delivered")


def region_lookup(spark: SparkSession) -> DataFrame:
    """The default (state, region) table: the five Brazilian macro-regions."""
    return spark.createDataFrame([(s, r) for r, states in BRAZIL_REGIONS.items() for s in states],
                                 "state string, region string")


def _latest_review(reviews: DataFrame) -> DataFrame:
    """One review per order: the latest, by creation and then id."""
    newest = F.max(F.struct("review_creation_date", "review_id", "review_score", "has_comment"))
    # The text goes before the rows are sorted and sent.
    return (reviews.withColumn("has_comment", F.col("review_comment_message").isNotNull()).groupBy("order_id").agg(newest.alias("r"))
            .select("order_id", "r.review_score", F.col("r.has_comment").alias("has_review_comment")))


# --- enriched metrics -----------------------------------------------------------------------

def order_metrics(orders: DataFrame, items: DataFrame, reviews: DataFrame,
                  payments: DataFrame) -> DataFrame:
    """One row per order that has items, with values, days, review and payments. An order that is
    not delivered has 0 delay days, as published, and no delay category."""
    price, freight = F.col("price"), F.col("freight_value")
    basket = items.groupBy("order_id").agg(
        F.sum(price).alias("total_items_value"), F.sum(freight).alias("total_freight"),
        F.sum(price + freight).alias("total_order_value"), F.count("*").alias("total_items"))
    # At most one entry per payment type is collected for an order.
    paid = payments.groupBy("order_id").agg(
        F.array_join(F.sort_array(F.collect_set("payment_type")), ", ").alias("payment_types"),
        F.sum("payment_value").alias("total_payment_value"),
        C.mean("payment_installments").alias("avg_installments"))
    delivered, promised = "order_delivered_customer_date", "order_estimated_delivery_date"
    days = C.delay_days(delivered, promised)
    return (orders.join(basket, "order_id")
            .join(_latest_review(reviews), "order_id", "left")
            .join(paid, "order_id", "left")
            .select("order_id", "customer_id", "order_status", "order_purchase_timestamp",
                    "order_approved_at", "order_delivered_carrier_date", delivered, promised,
                    "total_items_value", "total_freight", "total_order_value", "total_items",
                    C.elapsed_days(delivered, "order_purchase_timestamp").alias("delivery_days"),
                    days.alias("delay_days"), C.is_late(delivered, promised).alias("is_late"),
                    (F.col("order_status") == "delivered").alias("is_delivered"),
                    F.when(F.col(delivered).isNotNull(), C.delay_class(days)).alias("delay_category"),
                    "review_score", "has_review_comment", "payment_types",
                    "total_payment_value", "avg_installments"))


def customer_metrics(customers: DataFrame, orders: DataFrame, items: DataFrame,
                     reviews: DataFrame, geo: DataFrame, as_of: str) -> DataFrame:
    """Every customer with the figures of the delivered orders; ``avg_order_value`` averages
    over items, as published."""
    total = F.col("price") + F.col("freight_value")
    basket = items.groupBy("order_id").agg(F.sum(total).alias("spent"), F.count(total).alias("priced"))
    scores = reviews.groupBy("order_id").agg(F.sum("review_score").alias("score_sum"),
                                             F.count("review_score").alias("scores"))
    per_customer = (
        delivered_only(orders).select("order_id", "customer_id", "order_purchase_timestamp")
        .join(basket, "order_id", "left").join(scores, "order_id", "left")
        .groupBy("customer_id")
        .agg(F.count("order_id").alias("total_orders"),
             F.min("order_purchase_timestamp").alias("first_order_date"),
             F.max("order_purchase_timestamp").alias("last_order_date"),
             F.sum("spent").cast("decimal(20,2)").alias("total_spent"),
             C.ratio(F.sum("spent"), F.sum("priced")).alias("avg_order_value"),
             C.ratio(F.sum("score_sum"), F.sum("scores")).alias("avg_review_score")))
    point = one_coordinate_per_zip(geo)
    return (customers.select("customer_id", "customer_unique_id", "customer_zip_code_prefix",
                             "customer_city", "customer_state")
            .join(point, F.col("customer_zip_code_prefix") == F.col(ZIP), "left").drop(ZIP)
            .join(per_customer, "customer_id", "left")
            .withColumn("total_orders", F.coalesce("total_orders", F.lit(0)))
            .withColumn("days_since_last_order", C.days_until(as_of, "last_order_date")))


def product_metrics(products: DataFrame, items: DataFrame, orders: DataFrame,
                    reviews: DataFrame) -> DataFrame:
    """Every product with the sales of its delivered orders; a review counts once per order."""
    done = delivered_only(orders).select("order_id", "order_purchase_timestamp")
    scores = reviews.groupBy("order_id").agg(
        F.sum("review_score").alias("score_sum"), F.count("review_score").alias("scores"),
        F.count("*").alias("reviews"), F.count_if(F.col("review_score") == 5).alias("five"),
        F.count_if(F.col("review_score") <= 2).alias("low"))
    # Items are read once: the sellers of a product in an order travel with its figures, which stay
    # with the first of them when the sellers are told apart.
    first = F.coalesce(F.col("pos"), F.lit(0)) == 0
    once = lambda c: F.when(first, F.col(c))
    tall = (items.groupBy("product_id", "order_id")
            .agg(F.sum("price").alias("money"), F.count("price").alias("priced"),
                 F.min("price").alias("low_price"), F.max("price").alias("high_price"),
                 F.collect_set("seller_id").alias("shops"))
            .join(done, "order_id").join(scores, "order_id", "left")
            .select("*", F.posexplode_outer("shops").alias("pos", "seller_id")))
    sums = {"money": "total_revenue", "priced": "priced", "score_sum": "score_sum", "scores": "scores",
            "reviews": "total_reviews", "five": "five_star_reviews", "low": "negative_reviews"}
    sold = (tall.groupBy("product_id", "seller_id")
            .agg(F.count_if(first).alias("total_sales"), *[F.sum(once(c)).alias(n) for c, n in sums.items()],
                 F.min("low_price").alias("min_price"), F.max("high_price").alias("max_price"),
                 F.max("order_purchase_timestamp").alias("last_sale"))
            .groupBy("product_id")
            .agg(F.sum("total_sales").alias("total_sales"),
                 F.sum("total_revenue").cast("decimal(20,2)").alias("total_revenue"),
                 C.ratio(F.sum("total_revenue"), F.sum("priced")).alias("avg_price"),
                 F.min("min_price").alias("min_price"), F.max("max_price").alias("max_price"),
                 C.ratio(F.sum("score_sum"), F.sum("scores")).alias("avg_review_score"),
                 *[F.sum(n).alias(n) for n in ("total_reviews", "five_star_reviews", "negative_reviews")],
                 F.max("last_sale").alias("last_sale"), F.count("seller_id").alias("unique_sellers")))
    counts = ["total_sales", "total_reviews", "five_star_reviews", "negative_reviews",
              "unique_sellers"]
    return (products.select("product_id", "product_category_name",
                            F.coalesce("product_category_name", F.lit("unknown"))
                            .alias("product_category_clean"),
                            "product_weight_g", "product_length_cm", "product_height_cm",
                            "product_width_cm", "product_volume_cm3")
            .join(sold, "product_id", "left")
            .withColumns({c: F.coalesce(c, F.lit(0)) for c in counts}))


def seller_orders(items: DataFrame, metrics: DataFrame) -> DataFrame:
    """One row per (seller, order): the seller's own value and the order's delivery outcome."""
    own = items.groupBy("seller_id", "order_id").agg(
        F.sum("price").alias("revenue"), F.sum("freight_value").alias("freight"))
    return own.join(metrics.select(*SELLER_OUTCOME), "order_id")


SELLER_OUTCOME = ["order_id", "customer_id", "order_purchase_timestamp", "order_delivered_customer_date",
                  "is_delivered", "delivery_days", "delay_days", "is_late", "review_score"]


def _delivery_figures() -> dict[str, Column]:
    """Delay figures over delivered rows of any grain that carries an order's outcome."""
    done = F.col("is_late").isNotNull()
    return {"avg_delay_days": C.ratio(F.sum(F.when(done, F.col("delay_days"))), F.count_if(done)),
            "pct_delayed": C.percentage(F.count_if(F.col("is_late")), F.count_if(done))}


def seller_metrics(sellers: DataFrame, items: DataFrame, metrics: DataFrame) -> DataFrame:
    """Every seller with orders, revenue, delays, reviews and the tier that follows."""
    figures = _delivery_figures()
    per_seller = seller_orders(items, metrics).groupBy("seller_id").agg(
        F.count("*").alias("total_orders"),
        F.sum("revenue").cast("decimal(20,2)").alias("revenue"),
        *[c.alias(n) for n, c in figures.items()],
        C.mean("review_score").alias("avg_review_score"))
    return (sellers.select("seller_id", "seller_city", "seller_state")
            .join(per_seller, "seller_id", "left")
            .withColumn("total_orders", F.coalesce("total_orders", F.lit(0)))
            .withColumn("seller_tier", C.seller_tier("pct_delayed")))


def order_routes(items: DataFrame, metrics: DataFrame, customers: DataFrame, sellers: DataFrame,
                 regions: DataFrame) -> DataFrame:
    """(seller, order) rows with both states, both regions and the distance class."""
    def placed(df: DataFrame, key: str, state: str, who: str) -> DataFrame:
        return (df.select(key, F.col(state).alias(f"{who}_state"))
                .join(regions.select(F.col("state").alias(f"{who}_state"),
                                     F.col("region").alias(f"{who}_region")),
                      f"{who}_state", "left"))

    buyers = placed(customers, "customer_id", "customer_state", "customer")
    shops = placed(sellers, "seller_id", "seller_state", "seller")
    # The customer is looked up once per order, before the order meets its sellers.
    own = items.groupBy("seller_id", "order_id").agg(
        F.sum("price").alias("revenue"), F.sum("freight_value").alias("freight"))
    return (own.join(metrics.select(*SELLER_OUTCOME).join(buyers, "customer_id"), "order_id")
            .join(shops, "seller_id")
            .withColumn("distance_category", C.distance_category(
                F.col("seller_state"), F.col("customer_state"),
                F.col("seller_region"), F.col("customer_region"))))


def route_analysis(routes: DataFrame) -> DataFrame:
    """Orders, mean days and delays per route from seller state to customer state."""
    return routes.groupBy("seller_state", "customer_state", "distance_category").agg(
        F.count("*").alias("orders"), C.mean("delivery_days").alias("avg_delivery_days"),
        *[c.alias(n) for n, c in _delivery_figures().items()])


# --- keys and dimensions --------------------------------------------------------------------

def surrogate_key(df: DataFrame, cols: Sequence[str], name: str, how: str = "md5") -> DataFrame:
    """MD5 of the natural key, or dense numbers in key order (``sequence``)."""
    if how == "md5":
        return df.withColumn(name, C.md5_key(cols))
    return ordered_scan(df, cols, number=name)


def dim_date(spark: SparkSession, start: str | Column = "2016-01-01",
             end: str | Column = "2030-12-31", holidays: DataFrame | None = None) -> DataFrame:
    """Calendar, one row per day. ISO weekdays: Monday is 1. ``holidays``: a ``date`` column."""
    first = F.lit(start).cast("date") if isinstance(start, str) else start
    last = F.lit(end).cast("date") if isinstance(end, str) else end
    days = spark.range(1).select(F.explode(F.sequence(first, last)).alias("date"))
    day = F.col("date")
    weekday = F.weekday(day) + 1
    out = days.select(
        C.date_sk(day).alias("date_sk"), "date", F.year(day).alias("year"),
        F.quarter(day).alias("quarter"), F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"), F.weekofyear(day).alias("week_of_year"),
        F.dayofmonth(day).alias("day_of_month"), weekday.alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"), (weekday >= 6).alias("is_weekend"))
    if holidays is None:
        return out.withColumn("is_holiday", F.lit(False))
    free = holidays.select(F.col("date").cast("date").alias("date")).distinct()
    return (out.join(free.withColumn("_free", F.lit(True)), "date", "left")
            .withColumn("is_holiday", F.coalesce("_free", F.lit(False)))
            .select(*out.columns, "is_holiday"))


def dim_customers(metrics: DataFrame, rfm: DataFrame, as_of: str, regions: DataFrame,
                  capitals: DataFrame, effective_date: str) -> DataFrame:
    """Customers with region, order metrics, RFM segment and activity, current from a day on.

    ``metrics`` from ``customer_metrics``, ``rfm`` from ``rfm_segments`` by customer_id; ``regions``
    has ``state, region`` and ``capitals`` the ``state, city`` of each capital, one row per state.
    Later days go through ``scd2_merge``.
    """
    places = regions.join(capitals.select("state", F.col("city").alias("_capital")), "state", "left")
    metrics = metrics.join(places, F.col("customer_state") == F.col("state"), "left")
    scores = rfm.select("customer_id", F.col("recency_days").alias("recency"), "frequency",
                        "monetary", "rfm_score", F.col("segment").alias("customer_segment"))
    return metrics.join(scores, "customer_id", "left").select(
        C.md5_key(["customer_id"]).alias("customer_sk"), "customer_id", "customer_unique_id",
        "customer_city", "customer_state", F.col("region").alias("customer_region"),
        F.coalesce(F.col("customer_city") == F.col("_capital"), F.lit(False)).alias("is_capital"),
        F.col(LAT).alias("customer_lat"), F.col(LNG).alias("customer_lng"), "first_order_date", "last_order_date", "total_orders",
        "total_spent", "avg_order_value", "avg_review_score", "recency", "frequency", "monetary",
        "rfm_score", "customer_segment", is_active("last_order_date", as_of).alias("is_active"),
        F.lit(effective_date).cast("date").alias("effective_from"),
        F.lit(None).cast("date").alias("effective_to"), F.lit(True).alias("is_current"))


def dim_products(metrics: DataFrame, as_of: str) -> DataFrame:
    return metrics.select(
        C.md5_key(["product_id"]).alias("product_sk"), "product_id",
        F.col("product_category_clean").alias("product_category"), "product_weight_g",
        "product_volume_cm3", C.size_category("product_volume_cm3").alias("size_category"),
        "total_sales", "total_revenue", "avg_price", "avg_review_score",
        is_active("last_sale", as_of).alias("is_active"))


def dim_sellers(metrics: DataFrame, regions: DataFrame) -> DataFrame:
    return (metrics.join(regions, F.col("seller_state") == F.col("state"), "left")
            .select(C.md5_key(["seller_id"]).alias("seller_sk"), "seller_id", "seller_city",
                    "seller_state", F.col("region").alias("seller_region"), "total_orders",
                    "revenue", "avg_delay_days", "pct_delayed", "avg_review_score", "seller_tier"))


def dim_geolocation(geo: DataFrame) -> DataFrame:
    return geo.select(C.md5_key([ZIP]).alias("geolocation_sk"), ZIP, LAT, LNG,
                      "geolocation_city", "geolocation_state")


def dim_payment_method(payments: DataFrame) -> DataFrame:
    """One row per type; a type allows installments once any payment used more than one."""
    return (payments.groupBy("payment_type")
            .agg((F.max("payment_installments") > 1).alias("allows_installments"))
            .select(C.md5_key(["payment_type"]).alias("payment_method_sk"), "payment_type",
                    "allows_installments"))


def scd2_merge(current: DataFrame, updates: DataFrame, key: str, tracked: Sequence[str],
               effective_date: str) -> DataFrame:
    """Type 2 history after one full batch.

    New keys open a row. A changed key closes its row on the day the next one starts. A key
    missing from the batch closes. Unchanged rows and past versions stay as they are, so the
    same batch twice changes nothing. Dates are half-open: ``effective_to`` is the next start.

    A key that is NULL or twice in the batch, and a day before the start of a row that changes,
    make the query fail.
    """
    day = F.lit(effective_date).cast("date")
    nobody = F.lit(None).cast("date")
    live = current.filter("is_current").select(
        F.col(key), F.struct(*tracked).alias("old"), F.col("effective_from"))
    # The aggregate is on the join's key: it costs no exchange of its own.
    batch = updates.groupBy(key).agg(F.min(F.struct(*tracked)).alias("new"), F.count("*").alias("_n"))
    wrong = F.concat(F.lit(f"{key} is NULL or repeated in the batch: "),
                     F.coalesce(F.col(key).cast("string"), F.lit("NULL")))
    batch = batch.select(key, F.when((F.col("_n") > 1) | F.col(key).isNull(), F.raise_error(wrong))
                         .otherwise(F.col("new")).alias("new"))
    both = live.join(batch, key, "full_outer")
    known, present = F.col("effective_from").isNotNull(), F.col("new").isNotNull()
    same = known & present & F.col("old").eqNullSafe(F.col("new"))

    def version(data: str, start: Column, stop: Column, is_current: bool) -> Column:
        return F.struct(F.col(data).alias("data"), start.alias("effective_from"),
                        stop.alias("effective_to"), F.lit(is_current).alias("is_current"))

    kept = version("old", F.col("effective_from"), nobody, True)
    late = F.lit(f"{effective_date} is before the version that it would close")
    start = F.when(day < F.col("effective_from"), F.raise_error(late).cast("date")).otherwise(
        F.col("effective_from"))
    closed = version("old", start, day, False)
    opened = version("new", day, nobody, True)
    rows = (F.when(same, F.array(kept)).when(known & present, F.array(closed, opened))
            .when(known, F.array(closed)).otherwise(F.array(opened)))
    merged = both.select(key, F.explode(rows).alias("v")).select(
        key, *[F.col(f"v.data.{c}").alias(c) for c in tracked], "v.effective_from",
        "v.effective_to", "v.is_current")
    past = current.filter(~F.col("is_current")).select(*merged.columns)
    return past.unionByName(merged)


def scd2_insert(history: DataFrame, late: DataFrame, key: str, tracked: Sequence[str]) -> DataFrame:
    """Versions that arrive late, each with its own ``effective_from``, put into a type 2 history.

    A late version holds from its day to the next day on which the history knows something else: it
    splits the interval that it falls into, precedes the first version, follows a key's end, or
    replaces the version that starts on the same day. Versions that say the same as the one before them
    merge with it. Keys without late versions stay as they are and are not sorted.

    A late version without a key or a day, and two for one key and day, make the query fail.
    """
    said = F.struct(*tracked)
    start, stop = F.col("effective_from"), F.col("effective_to")
    nothing = F.lit(None).cast(history.select(said.alias("d")).schema["d"].dataType)
    wrong = F.concat(F.lit("late version without key or day, or two of one day: "),
                     F.coalesce(F.col(key).cast("string"), F.lit("NULL")))
    fresh = (late.groupBy(key, "effective_from").agg(F.min(said).alias("data"), F.count("*").alias("_n"))
             .select(key, start.alias("day"), F.when(
                 (F.col("_n") > 1) | F.col(key).isNull() | start.isNull(), F.raise_error(wrong))
                     .otherwise(F.lit(2)).cast("int").alias("rank"), "data"))
    touched = late.select(key).distinct()
    old = history.join(touched, key, "left_semi").select(key, F.explode(F.array(
        F.struct(start.alias("day"), F.lit(1).alias("rank"), said.alias("data")),
        F.struct(stop.alias("day"), F.lit(0).alias("rank"), nothing.alias("data")))).alias("e")).select(
        key, "e.*").filter(F.col("day").isNotNull())
    # What holds from a day on: the late version, else the one that starts, else nothing.
    events = (old.unionByName(fresh).repartition(key).groupBy(key, "day")
              .agg(F.max_by("data", "rank").alias("data")))
    line = Window.partitionBy(key).orderBy("day")
    changes = events.withColumn("_first", F.row_number().over(line) == 1).withColumn(
        "_before", F.lag("data").over(line)).filter(
        F.col("_first") | ~F.col("data").eqNullSafe(F.col("_before")))
    ends = changes.withColumn("effective_to", F.lead("day").over(line)).filter(F.col("data").isNotNull())
    merged = ends.select(key, *[F.col(f"data.{c}").alias(c) for c in tracked],
                         F.col("day").alias("effective_from"), "effective_to",
                         F.col("effective_to").isNull().alias("is_current"))
    return history.join(touched, key, "left_anti").select(*merged.columns).unionByName(merged)


def scd2_start(df: DataFrame, key: str, tracked: Sequence[str], effective_date: str) -> DataFrame:
    """First load: every row current from the given day."""
    return df.select(key, *tracked, F.lit(effective_date).cast("date").alias("effective_from"),
                     F.lit(None).cast("date").alias("effective_to"),
                     F.lit(True).alias("is_current"))


def scd2_validity(versions: DataFrame, key: str) -> DataFrame:
    """Closing dates from the next version of each key (a short list per key)."""
    window = Window.partitionBy(key).orderBy("effective_from")
    stop = F.lead("effective_from").over(window)
    return versions.withColumn("effective_to", stop).withColumn("is_current", stop.isNull())


# --- facts ----------------------------------------------------------------------------------

SALE_OUTCOME = ["order_id", "customer_id", "order_purchase_timestamp", "is_delivered", "is_late",
                "delivery_days", "delay_days", "review_score"]


def fact_sales(items: DataFrame, metrics: DataFrame,
               dims: Mapping[str, DataFrame] | None = None,
               customer_versions: DataFrame | None = None) -> DataFrame:
    """Item grain. MD5 keys are computed in place; pass ``dims`` (customers, products, sellers
    with their ``_sk``) to look the keys up instead, which leaves unknown members NULL.

    With ``customer_versions`` (a type 2 history with its ``customer_sk``), the customer's key is that
    of the version valid on the purchase day, NULL where none is; it is looked up once per order.

    Pass ``metrics`` as a stored table: both sides then meet in exchanges of their own, and an
    order with very many items is split over several tasks at run time. Items that lie by order already,
    as ``order_lines`` do, are not sent again; an order then stays in one task.
    """
    orders = metrics.select(*SALE_OUTCOME)
    if customer_versions is not None:
        day = orders.withColumn("_day", F.to_date("order_purchase_timestamp"))
        orders = version_at(day, customer_versions, "customer_id", "_day", "effective_from",
                            "effective_to", ["customer_sk"]).drop("_day")
    rows = items.select("order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value")
    # Looked up in narrow rows: the customer once per order, the others before the order's columns join.
    if dims is not None:
        if customer_versions is None:
            orders = orders.join(dims["customers"].select("customer_id", "customer_sk"), "customer_id", "left")
        for who in ("product", "seller"):
            rows = rows.join(dims[f"{who}s"].select(f"{who}_id", f"{who}_sk"), f"{who}_id", "left")
    rows = rows.join(orders, "order_id")
    if dims is None:
        for who in ("customer", "product", "seller")[customer_versions is not None:]:
            rows = rows.withColumn(f"{who}_sk", C.md5_key([f"{who}_id"]))
    return rows.select(
        C.md5_key(["order_id", "order_item_id"]).alias("sale_sk"),
        C.date_sk("order_purchase_timestamp").alias("date_sk"), "customer_sk", "product_sk",
        "seller_sk", "order_id", "order_item_id", F.lit(1).alias("quantity"),
        F.col("price").alias("unit_price"), "freight_value",
        C.money(F.col("price") + F.col("freight_value")).alias("total_value"),
        "is_delivered", "is_late", "delivery_days", "delay_days", "review_score")


def fact_deliveries(orders: DataFrame, items: DataFrame, customers: DataFrame,
                    sellers: DataFrame, geo: DataFrame) -> DataFrame:
    """Delivered (order, seller) shipments: time, distance, freight against distance, SLA."""
    km = (customer_seller_distance(delivered_only(orders), items, customers, sellers, geo)
          .groupBy("order_id", "seller_id").agg(F.max("distance_km").alias("distance_km")))
    freight = items.groupBy("order_id", "seller_id").agg(F.sum("freight_value").alias("freight_value"))
    delivered, promised = "order_delivered_customer_date", "order_estimated_delivery_date"
    done = orders.filter(F.col(delivered).isNotNull()).select(
        "order_id", C.elapsed_days(delivered, "order_purchase_timestamp").alias("delivery_days"),
        C.delay_days(delivered, promised).alias("delay_days"),
        (~C.is_late(delivered, promised)).alias("sla_met"))
    return (freight.join(km, ["order_id", "seller_id"]).join(done, "order_id")
            .select("order_id", "seller_id", "delivery_days", "delay_days", "sla_met",
                    "distance_km", "freight_value",
                    F.when(F.col("distance_km") > 0, F.round(
                        F.col("freight_value").cast("double") / F.col("distance_km"), 6))
                    .alias("freight_per_km")))


def fact_orders(metrics: DataFrame) -> DataFrame:
    return metrics.select(
        "order_id", C.md5_key(["order_id"]).alias("order_sk"),
        C.md5_key(["customer_id"]).alias("customer_sk"),
        C.date_sk("order_purchase_timestamp").alias("date_key_purchase"),
        C.date_sk("order_delivered_customer_date").alias("date_key_delivery"),
        F.col("total_order_value").alias("total_value"), "total_items", "delivery_days",
        "delay_days", F.col("is_late").alias("is_delayed"), "delay_category", "review_score",
        C.sentiment("review_score").alias("review_sentiment"))


def upsert_fact_orders(spark: SparkSession, path: str, facts: DataFrame,
                       updated: str = "updated_at") -> list[str]:
    """Order facts with the day of their purchase and the time of their last change, merged into
    the purchase months that they touch. Orders of the same instant are told apart by all columns."""
    dated = facts.withColumn("purchase_date", F.to_date(F.col("date_key_purchase").cast("string"), "yyyyMMdd"))
    return upsert_months(spark, path, dated, ["order_id"], "purchase_date", updated)


def fact_order_items(items: DataFrame) -> DataFrame:
    return items.select(
        C.md5_key(["order_id"]).alias("order_sk"), "order_item_id",
        C.md5_key(["product_id"]).alias("product_sk"), C.md5_key(["seller_id"]).alias("seller_sk"),
        "price", F.col("freight_value").alias("freight"),
        C.money(F.col("price") + F.col("freight_value")).alias("total"))


def fact_reviews(reviews: DataFrame) -> DataFrame:
    """``has_complaint``: a score of 2 or less with a comment."""
    said = F.col("review_comment_message").isNotNull()
    return reviews.select(
        "review_id", C.md5_key(["order_id"]).alias("order_sk"), F.col("review_score").alias("score"),
        F.col("review_comment_message").alias("comment"),
        C.sentiment("review_score").alias("sentiment"),
        (F.coalesce(F.col("review_score") <= 2, F.lit(False)) & said).alias("has_complaint"))
