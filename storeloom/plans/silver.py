"""Bronze to silver: one function per table, columns in their published order.

Each transform ends in DISTINCT. Where the load has already left one row per key, ``keyed``
drops that step: it would change nothing, cost an exchange of whole rows, and keep readers of a
few columns from pruning the others.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storeloom.functions import columns as C
from storeloom.operators import clean
from storeloom.operators.dedup import distinct_on, distinct_rows, original_count
from storeloom.operators.joins import enrich_geolocation
from storeloom.sources.schemas import AUDIT_COLUMNS, BRAZIL_BOX

GEO = ["geolocation_lat", "geolocation_lng", "has_geolocation"]


def _distinct(df: DataFrame, keyed: bool) -> DataFrame:
    return df if keyed else distinct_rows(df)


def silver_customers(customers: DataFrame, geo: DataFrame, run_ts: str,
                     keyed: bool = False) -> DataFrame:
    base = ["customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city",
            "customer_state"]
    unique = _distinct(customers.select(*base), keyed)
    located = enrich_geolocation(unique, "customer_zip_code_prefix", geo)
    return clean.with_audit(located.select(*base, *GEO), run_ts)


def silver_orders(orders: DataFrame, run_ts: str, keyed: bool = False) -> DataFrame:
    stamps = ["order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
              "order_delivered_customer_date", "order_estimated_delivery_date"]
    tidy = _distinct(orders.select(
        "order_id", "customer_id", C.clean_lower("order_status").alias("order_status"),
        *[C.strict_timestamp(c).alias(c) for c in stamps]), keyed)
    flagged = clean.presence_flags(tidy, {
        "is_approved": "order_approved_at", "is_shipped": "order_delivered_carrier_date",
        "is_delivered": "order_delivered_customer_date"})
    return clean.with_audit(flagged, run_ts)


def silver_products(products: DataFrame, run_ts: str, keyed: bool = False) -> DataFrame:
    sides = ["product_length_cm", "product_height_cm", "product_width_cm"]
    # The photo flag reads the raw column, so a missing count gives NULL and not FALSE.
    flagged = clean.threshold_flag(products, "has_photos", "product_photos_qty", ">", 0)
    tidy = clean.rename(flagged, {"product_name_lenght": "product_name_length",
                                  "product_description_lenght": "product_description_length"})
    tidy = clean.fill_defaults(tidy, {"product_name_length": 0, "product_description_length": 0,
                                      "product_photos_qty": 0})
    tidy = clean.product_volume(tidy)
    tidy = clean.presence_flags(tidy, {"has_category": "product_category_name",
                                       "has_weight": "product_weight_g"})
    tidy = clean.all_present_flag(tidy, "has_dimensions", sides)
    ordered = _distinct(tidy.select(
        "product_id", "product_category_name", "product_name_length",
        "product_description_length", "product_photos_qty", "product_weight_g", *sides,
        "product_volume_cm3", "has_category", "has_weight", "has_photos", "has_dimensions"), keyed)
    return clean.with_audit(ordered, run_ts)


def silver_sellers(sellers: DataFrame, geo: DataFrame, run_ts: str,
                   keyed: bool = False) -> DataFrame:
    base = ["seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"]
    unique = _distinct(sellers.select(
        *base[:-1], C.clean_upper("seller_state").alias("seller_state")), keyed)
    located = enrich_geolocation(unique, "seller_zip_code_prefix", geo)
    return clean.with_audit(located.select(*base, *GEO), run_ts)


def silver_order_items(items: DataFrame, run_ts: str, keyed: bool = False) -> DataFrame:
    typed = _distinct(items.select(
        "order_id", "order_item_id", "product_id", "seller_id",
        C.money("price").alias("price"), C.money("freight_value").alias("freight_value"),
        C.strict_timestamp("shipping_limit_date").alias("shipping_limit_date")), keyed)
    out = clean.item_total_value(typed)
    out = clean.threshold_flag(out, "has_price", "price", ">", 0)
    out = clean.threshold_flag(out, "has_freight", "freight_value", ">", 0)
    out = clean.presence_flags(out, {"has_shipping_limit": "shipping_limit_date"})
    return clean.with_audit(out, run_ts)


def silver_order_lines(lines: DataFrame) -> DataFrame:
    """The keys and values of ``silver_order_items`` that ``lines`` has, where they have one row per key."""
    return lines.withColumns({c: C.money(c) for c in ("price", "freight_value") if c in lines.columns})


def silver_order_payments(payments: DataFrame, run_ts: str, keyed: bool = False) -> DataFrame:
    typed = _distinct(payments.select(
        "order_id", "payment_sequential", C.clean_lower("payment_type").alias("payment_type"),
        F.col("payment_installments").cast("int").alias("payment_installments"),
        C.money("payment_value").alias("payment_value")), keyed)
    out = clean.threshold_flag(typed, "has_value", "payment_value", ">", 0)
    out = clean.threshold_flag(out, "is_installment", "payment_installments", ">", 1)
    out = clean.equals_flag(out, "is_credit_card", "payment_type", "credit_card")
    out = clean.equals_flag(out, "is_boleto", "payment_type", "boleto")
    return clean.with_audit(out, run_ts)


def silver_order_reviews(reviews: DataFrame, run_ts: str, keyed: bool = False) -> DataFrame:
    typed = _distinct(reviews.select(
        "review_id", "order_id", F.col("review_score").cast("int").alias("review_score"),
        F.trim("review_comment_title").alias("review_comment_title"),
        F.trim("review_comment_message").alias("review_comment_message"),
        C.strict_timestamp("review_creation_date").alias("review_creation_date"),
        C.strict_timestamp("review_answer_timestamp").alias("review_answer_timestamp")), keyed)
    out = typed.withColumn("comment_length", C.trimmed_length("review_comment_message"))
    out = clean.presence_flags(out, {"has_comment_title": "review_comment_title",
                                     "has_comment_message": "review_comment_message",
                                     "has_answer": "review_answer_timestamp"})
    out = clean.threshold_flag(out, "is_positive_score", "review_score", ">=", 4)
    out = clean.threshold_flag(out, "is_negative_score", "review_score", "<=", 2)
    return clean.with_audit(out, run_ts)


def silver_geolocation(geo_raw: DataFrame, run_ts: str, box=BRAZIL_BOX) -> DataFrame:
    """One valid reading per zip, with the number of raw readings (valid or not) it had."""
    zip_col, lat, lng = "geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng"
    valid = clean.bbox_filter(clean.drop_null_keys(geo_raw, [lat, lng]), lat, lng, box)
    first = distinct_on(valid, [zip_col], [lat, lng, "geolocation_city"])
    flagged = clean.bbox_flag(first, "is_valid_brazil_coords", lat, lng, box)
    counted = flagged.join(original_count(geo_raw, [zip_col]), zip_col)
    out = counted.select(
        zip_col, F.col(lat).cast("decimal(10,6)").alias(lat),
        F.col(lng).cast("decimal(10,6)").alias(lng),
        F.trim("geolocation_city").alias("geolocation_city"),
        C.clean_upper("geolocation_state").alias("geolocation_state"),
        "is_valid_brazil_coords", "original_count")
    return clean.with_audit(out, run_ts)


def silver(bronze: Mapping[str, DataFrame], run_ts: str, keyed: bool = False) -> dict[str, DataFrame]:
    """Every silver table whose bronze input is given."""
    geo = bronze.get("geolocation")
    build = {
        "customers": lambda t: silver_customers(t, geo, run_ts, keyed),
        "sellers": lambda t: silver_sellers(t, geo, run_ts, keyed),
        "products": lambda t: silver_products(t, run_ts, keyed),
        "orders": lambda t: silver_orders(t, run_ts, keyed),
        "order_items": lambda t: silver_order_items(t, run_ts, keyed),
        "order_payments": lambda t: silver_order_payments(t, run_ts, keyed),
        "order_reviews": lambda t: silver_order_reviews(t, run_ts, keyed),
        "geolocation": lambda t: silver_geolocation(t, run_ts),
    }
    return {name: build[name](table) for name, table in bronze.items()}


def without_audit(df: DataFrame) -> DataFrame:
    return df.drop(*AUDIT_COLUMNS)
