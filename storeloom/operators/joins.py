"""Joins. Runtime statistics pick the strategy, on measured sizes; nothing is broadcast by hand."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from storeloom.functions import columns as C
from storeloom.operators.clean import drop_null_keys
from storeloom.operators.dedup import distinct_on

ZIP, LAT, LNG = "geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng"


def one_coordinate_per_zip(geo: DataFrame) -> DataFrame:
    """Rows without coordinates go; the smallest (lat, lng, city) stays."""
    return (distinct_on(drop_null_keys(geo, [LAT, LNG]), [ZIP], [LAT, LNG, "geolocation_city"])
            .select(ZIP, LAT, LNG))


def enrich_geolocation(df: DataFrame, zip_col: str, geo: DataFrame) -> DataFrame:
    """Left lookup of coordinates: missing ones become 0.0 and ``has_geolocation`` tells."""
    point = one_coordinate_per_zip(geo)
    found = df.join(point, F.col(zip_col) == F.col(ZIP), "left").drop(ZIP)
    kinds = {f.name: f.dataType for f in point.schema}
    return (found.withColumn("has_geolocation", C.all_present(LAT, LNG))
            .withColumns({c: F.coalesce(F.col(c), F.lit(0.0).cast(kinds[c])) for c in (LAT, LNG)}))


def customer_coordinates(customers: DataFrame, geo: DataFrame) -> DataFrame:
    """Left join without reduction: one row per customer and row of its zip in ``geo``, which is
    one in a consolidated table."""
    return (customers.join(geo, F.col("customer_zip_code_prefix") == F.col(ZIP), "left")
            .select("customer_id", "customer_city", "customer_state", LAT, LNG))


def fk_orphans(child: DataFrame, parent: DataFrame, fk: str, pk: str,
               ignore_null: bool = False) -> DataFrame:
    """One row: child rows whose key has no parent.

    The child is counted per key first, so a frequent key crosses the wire once per map task.
    NULL keys are orphans unless ``ignore_null``.
    """
    keys = child.groupBy(F.col(fk).alias("_fk")).agg(F.count("*").alias("n"))
    if ignore_null:
        keys = keys.filter(F.col("_fk").isNotNull())
    lone = keys.join(parent.select(F.col(pk).alias("_pk")), F.col("_fk") == F.col("_pk"),
                     "left_anti")
    return lone.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("orphans"))


def fk_report(tables: Mapping[str, DataFrame], fks: Sequence[tuple[str, str, str, str]],
              ignore_null: bool = False) -> DataFrame:
    """Orphans of every foreign key with OK or FAIL.

    A table is read once as a child, for all its keys, and once as a parent, for all that point at it:
    child rows are counted per (key name, value), and all keys of one type meet in one anti join.
    """
    names = {fk: f"{fk[0]}.{fk[1]} -> {fk[2]}" for fk in fks}
    kinds = {fk: tables[fk[0]].schema[fk[1]].dataType for fk in fks}
    lone = []
    for kind in dict.fromkeys(kinds.values()):
        mine = [fk for fk in fks if kinds[fk] == kind]

        def named(table: str, keys: list[tuple[str, str]], kind=kind) -> DataFrame:
            entries = [F.struct(F.lit(name).alias("fk"), F.col(c).cast(kind).alias("_key")) for name, c in keys]
            return tables[table].select(F.inline(F.array(*entries)))

        counts = [named(child, [(names[fk], fk[1]) for fk in mine if fk[0] == child])
                  .groupBy("fk", "_key").agg(F.count("*").alias("n"))
                  for child in dict.fromkeys(fk[0] for fk in mine)]
        parents = [named(parent, [(names[fk], fk[3]) for fk in mine if fk[2] == parent])
                   for parent in dict.fromkeys(fk[2] for fk in mine)]
        keys = reduce(DataFrame.unionByName, counts)
        if ignore_null:
            keys = keys.filter(F.col("_key").isNotNull())
        lone.append(keys.join(reduce(DataFrame.unionByName, parents), ["fk", "_key"], "left_anti"))
    found = reduce(DataFrame.unionByName, [x.select("fk", "n") for x in lone]).groupBy("fk").agg(
        F.sum("n").alias("n"))
    listed = tables[fks[0][0]].sparkSession.createDataFrame([(n,) for n in names.values()], "fk string")
    return listed.join(found, "fk", "left").select(
        "fk", F.coalesce("n", F.lit(0)).alias("orphans"),
        F.when(F.col("n").isNull(), "OK").otherwise("FAIL").alias("status"))


def order_item_product_path(customers: DataFrame, orders: DataFrame, items: DataFrame,
                            products: DataFrame) -> DataFrame:
    return (items.select("order_id", "order_item_id", "product_id", "price")
            .join(products.select("product_id", "product_category_name"), "product_id")
            .join(orders.select("order_id", "customer_id", "order_status"), "order_id")
            .join(customers.select("customer_id", "customer_city"), "customer_id")
            .select("customer_id", "customer_city", "order_id", "order_status", "order_item_id",
                    "product_category_name", "price"))


def seller_reviews(sellers: DataFrame, items: DataFrame, reviews: DataFrame) -> DataFrame:
    return (items.select("order_id", "seller_id")
            .join(sellers.select("seller_id", "seller_city"), "seller_id")
            .join(reviews.select("order_id", "review_score", "review_comment_message"), "order_id")
            .select("seller_id", "seller_city", "order_id", "review_score",
                    "review_comment_message"))


def customer_seller_distance(orders: DataFrame, items: DataFrame, customers: DataFrame,
                             sellers: DataFrame, geo: DataFrame) -> DataFrame:
    """Great-circle distance per order item, for items whose two zips are both known.

    ``geo`` holds one row per zip.
    """
    point = geo.select(ZIP, F.col(LAT).cast("double").alias("lat"),
                       F.col(LNG).cast("double").alias("lng"))

    def located(df: DataFrame, key: str, zip_col: str, who: str) -> DataFrame:
        return (df.join(point, F.col(zip_col) == F.col(ZIP))
                .select(key, F.col("lat").alias(f"{who}_lat"), F.col("lng").alias(f"{who}_lng")))

    buyers = located(customers, "customer_id", "customer_zip_code_prefix", "customer")
    shops = located(sellers, "seller_id", "seller_zip_code_prefix", "seller")
    km = C.great_circle_km(F.col("customer_lat"), F.col("customer_lng"),
                           F.col("seller_lat"), F.col("seller_lng"))
    return (items.select("order_id", "order_item_id", "seller_id")
            .join(shops, "seller_id")
            .join(orders.select("order_id", "customer_id").join(buyers, "customer_id"), "order_id")
            .select("order_id", "order_item_id", "seller_id", F.round(km, 3).alias("distance_km")))


def basket_category_pairs(items: DataFrame, products: DataFrame) -> DataFrame:
    """Items ``a < b`` (by product) bought in one order, counted per pair of categories.

    Equal products of an order first collapse to one row with a weight, and the products of an order
    are numbered by it, in base 16. Two different products differ first at exactly one digit, so
    counting category totals per (order, leading digits, digit) and combining the totals of
    different digits counts every pair once. What is gathered per (order, leading digits) is at most
    16 digits times the number of categories, however large the order is, and is paired in place. An
    order of up to 16 products has one digit.

    Numbers and counts are taken where the window has brought the rows of an order together.
    """
    weights = items.groupBy("order_id", "product_id").agg(F.count("*").alias("w"))
    category = products.select("product_id", F.col("product_category_name").alias("category"))
    order = Window.partitionBy("order_id")
    numbered = (weights.join(category, "product_id")
                .withColumn("nr", F.dense_rank().over(order.orderBy("product_id")) - 1)
                .withColumn("products", F.count("*").over(order)).filter(F.col("products") > 1))
    return _pairs_by_digit(numbered).groupBy("category_a", "category_b").agg(
        F.sum("pairs").alias("co_purchase_count"))


def _pairs_by_digit(numbered: DataFrame, base: int = 16) -> DataFrame:
    """``nr`` counts from 0 and is less than ``products``, which is more than 1."""
    top = F.ceil(F.log(float(base), F.col("products").cast("double"))).cast("int") - 1
    scale = F.pow(F.lit(base), F.col("level")).cast("bigint")
    digits = (numbered.withColumn("level", F.explode(F.sequence(F.lit(0), top)))
              .withColumn("head", F.floor(F.col("nr") / (scale * base)))
              .withColumn("digit", F.floor(F.col("nr") / scale) % base))
    cells = (digits.groupBy("order_id", "level", "head", "digit", "category")
             .agg(F.sum("w").alias("w")))
    groups = (cells.groupBy("order_id", "level", "head")
              .agg(F.collect_list(F.struct("digit", "category", "w")).alias("cells"))
              .filter(F.size("cells") > 1))
    others = F.transform(
        F.filter("cells", lambda b: b["digit"] > F.col("a.digit")),
        lambda b: F.struct(F.col("a.category").alias("category_a"), b["category"].alias("category_b"),
                           (F.col("a.w") * b["w"]).alias("pairs")))
    return groups.select("cells", F.explode("cells").alias("a")).select(F.inline(others))


def basket_categories(items: DataFrame, products: DataFrame, min_count: int = 10,
                      k: int = 20) -> DataFrame:
    """Category pairs bought together at least ``min_count`` times, most frequent first."""
    return (basket_category_pairs(items, products)
            .filter(F.col("co_purchase_count") >= min_count)
            .orderBy(F.desc("co_purchase_count"), "category_a", "category_b").limit(k))
