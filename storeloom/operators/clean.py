"""Projections and filters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storeloom.functions import columns as C
from storeloom.sources.schemas import AUDIT_COLUMNS, BRAZIL_BOX


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def fill_defaults(df: DataFrame, defaults: Mapping[str, Any]) -> DataFrame:
    """NULL becomes the given default; the column keeps its type."""
    kinds = {f.name: f.dataType for f in df.schema}
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v).cast(kinds[c]))
                           for c, v in defaults.items()})


def product_volume(df: DataFrame, length: str = "product_length_cm",
                   height: str = "product_height_cm", width: str = "product_width_cm",
                   name: str = "product_volume_cm3") -> DataFrame:
    """L x H x W as bigint; NULL as soon as one side is."""
    return df.withColumn(name, F.col(length).cast("bigint") * F.col(height) * F.col(width))


def item_total_value(df: DataFrame, price: str = "price", freight: str = "freight_value",
                     name: str = "item_total_value") -> DataFrame:
    return df.withColumn(name, C.money(F.col(price) + F.col(freight)))


def presence_flags(df: DataFrame, flags: Mapping[str, str]) -> DataFrame:
    return df.withColumns({flag: F.col(c).isNotNull() for flag, c in flags.items()})


def all_present_flag(df: DataFrame, name: str, cols: Sequence[str]) -> DataFrame:
    return df.withColumn(name, C.all_present(*cols))


def threshold_flag(df: DataFrame, name: str, col: str, op: str, value: Any) -> DataFrame:
    """Three-valued: a NULL input gives a NULL flag."""
    return df.withColumn(name, C.COMPARE[op](F.col(col), F.lit(value)))


def equals_flag(df: DataFrame, name: str, col: str, value: str) -> DataFrame:
    """Two-valued comparison of the normalised text."""
    return df.withColumn(name, F.coalesce(C.clean_lower(col) == value, F.lit(False)))


def with_audit(df: DataFrame, run_ts: str) -> DataFrame:
    """The three audit columns, one literal per run."""
    stamp = F.lit(run_ts).cast("timestamp")
    return df.withColumns({c: stamp for c in AUDIT_COLUMNS})


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.dropna(how="any", subset=list(keys))


def bbox_flag(df: DataFrame, name: str, lat: str, lng: str, box=BRAZIL_BOX) -> DataFrame:
    return df.withColumn(name, C.in_box(lat, lng, box))


def bbox_filter(df: DataFrame, lat: str, lng: str, box=BRAZIL_BOX) -> DataFrame:
    return df.filter(F.col(lat).between(box[0], box[1]) & F.col(lng).between(box[2], box[3]))


def delivery_times(orders: DataFrame) -> DataFrame:
    """Delivered orders with actual and promised days."""
    bought = F.col("order_purchase_timestamp")
    return (orders.filter(F.col("order_delivered_customer_date").isNotNull())
            .select("order_id", "order_purchase_timestamp", "order_delivered_customer_date",
                    C.elapsed_days(F.col("order_delivered_customer_date"), bought)
                    .alias("delivery_days"),
                    C.elapsed_days(F.col("order_estimated_delivery_date"), bought)
                    .alias("estimated_days")))


def late_orders(orders: DataFrame) -> DataFrame:
    delivered, promised = "order_delivered_customer_date", "order_estimated_delivery_date"
    return (orders.filter(C.is_late(delivered, promised))
            .select("order_id", delivered, promised,
                    C.elapsed_days(delivered, promised).alias("delay_days")))


def overweight_products(products: DataFrame, min_g: int = 10_000) -> DataFrame:
    return (products.filter(F.col("product_weight_g") > min_g)
            .orderBy(F.desc("product_weight_g"), "product_id"))


def negative_reviews(reviews: DataFrame, limit: int | None = 10) -> DataFrame:
    """Reviews of 2 or less with a comment; the report shows the lowest ids first."""
    found = (reviews.filter((F.col("review_score") <= 2)
                            & F.col("review_comment_message").isNotNull())
             .select("review_id", "order_id", "review_score", "review_comment_title",
                     "review_comment_message"))
    return found if limit is None else found.orderBy("review_id").limit(limit)


def sort_for_write(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Clusters each file by key (tight min/max statistics) without a global sort."""
    return df.sortWithinPartitions(*keys)


def top_n(df: DataFrame, order: Sequence, n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)
