"""Deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storeloom.functions import columns as C


def _key(keys: Sequence[str]) -> Column:
    return F.struct(*keys) if len(keys) > 1 else F.col(keys[0])


def dedupe_keep_first(df: DataFrame, keys: Sequence[str],
                      order_by: Sequence[Column | str] | None = None) -> DataFrame:
    """First row per key in the given order; any row where no order is given.

    Spark limits ``row_number() <= 1`` to one row per key already before the exchange, so a
    key that holds a large share of the rows sends one row per map task.
    """
    if order_by is None:
        return df.dropDuplicates(list(keys))
    window = Window.partitionBy(*keys).orderBy(*order_by)
    return (df.withColumn("_nr", F.row_number().over(window))
            .filter(F.col("_nr") <= 1).drop("_nr"))


def distinct_on(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str]) -> DataFrame:
    """``SELECT DISTINCT ON (keys) ... ORDER BY keys, order_by``."""
    return dedupe_keep_first(df, keys, order_by)


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.distinct()


def duplicate_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows, distinct keys and the rows that keep-first removes."""
    per_key = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return per_key.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total_records"),
                       F.count("*").alias("unique_keys"),
                       F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"))


def geo_consolidate(geo: DataFrame, precision: int = 6) -> DataFrame:
    """One coordinate per zip: round, count equal readings, keep the most frequent.

    Readings are counted before duplicates go; ties fall to the smallest latitude, then
    longitude. Counting is a partial aggregate, and what is left per zip are its distinct
    readings.
    """
    lat, lng = "geolocation_lat", "geolocation_lng"
    zip_col = "geolocation_zip_code_prefix"
    rounded = geo.withColumns({lat: F.round(lat, precision), lng: F.round(lng, precision)})
    readings = rounded.groupBy(zip_col, lat, lng).agg(
        F.count("*").alias("_readings"),
        F.min(F.struct("geolocation_city", "geolocation_state")).alias("_place"))
    return (dedupe_keep_first(readings, [zip_col], [F.desc("_readings"), lat, lng])
            .select(zip_col, lat, lng, "_place.geolocation_city", "_place.geolocation_state"))


def original_count(df: DataFrame, keys: Sequence[str], name: str = "original_count") -> DataFrame:
    """Rows per key."""
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def dedup_report(bronze: DataFrame, silver: DataFrame, key: str) -> DataFrame:
    """Records and distinct keys before and after, with the reduction in percent."""
    def per_key(df: DataFrame, layer: str) -> DataFrame:
        return (df.groupBy(key).agg(F.count("*").alias("n"))
                .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("records"),
                     F.count(key).alias("unique_keys"))
                .withColumn("layer", F.lit(layer)))

    both = per_key(bronze, "bronze").unionByName(per_key(silver, "silver"))
    pick = {f"{layer}_{c}": F.max(F.when(F.col("layer") == layer, F.col(c)))
            for layer in ("bronze", "silver") for c in ("records", "unique_keys")}
    wide = both.agg(*[c.alias(name) for name, c in pick.items()])
    return wide.withColumn("reduction_pct", C.percentage(
        F.col("bronze_records") - F.col("silver_records"), F.col("bronze_records")))


def dedup_profile(silver: DataFrame, count_col: str = "original_count") -> DataFrame:
    return silver.agg(C.mean(count_col).alias("avg_duplicates"),
                      F.max(count_col).alias("max_duplicates"),
                      F.count_if(F.col(count_col) > 1).alias("keys_with_duplicates"))
