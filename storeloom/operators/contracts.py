"""Data contracts: a suite is a list of expectation dicts, compiled into one aggregate pass.

Uniqueness needs its values counted and is the only rule that adds a ``groupBy``. NULLs are
evaluated by ``not_null`` alone; ``mostly`` is the least passing share.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storeloom.functions import columns as C

EXIST = "expect_column_to_exist"
NOT_NULL = "expect_column_values_to_not_be_null"
UNIQUE = "expect_column_values_to_be_unique"
IN_SET = "expect_column_values_to_be_in_set"
BETWEEN = "expect_column_values_to_be_between"
LENGTH = "expect_column_value_lengths_to_equal"
ROW_COUNT = "expect_table_row_count_to_be_between"
COLUMN_COUNT = "expect_table_column_count_to_equal"


def _rule(kind: str, **kwargs: Any) -> dict:
    return {"expectation_type": kind, "kwargs": {k: v for k, v in kwargs.items() if v is not None}}


def column_to_exist(column: str) -> dict:
    return _rule(EXIST, column=column)


def not_null(column: str, mostly: float | None = None) -> dict:
    return _rule(NOT_NULL, column=column, mostly=mostly)


def unique(column: str, mostly: float | None = None) -> dict:
    return _rule(UNIQUE, column=column, mostly=mostly)


def in_set(column: str, value_set: Sequence, mostly: float | None = None) -> dict:
    return _rule(IN_SET, column=column, value_set=list(value_set), mostly=mostly)


def between(column: str, min_value, max_value, mostly: float | None = None) -> dict:
    return _rule(BETWEEN, column=column, min_value=min_value, max_value=max_value, mostly=mostly)


def length_equals(column: str, value: int, mostly: float | None = None) -> dict:
    return _rule(LENGTH, column=column, value=value, mostly=mostly)


def row_count_between(min_value: int, max_value: int) -> dict:
    return _rule(ROW_COUNT, min_value=min_value, max_value=max_value)


def column_count_equals(value: int) -> dict:
    return _rule(COLUMN_COUNT, value=value)


# Order statuses, and the rules of every suite in their order.
ORDER_STATUSES = ["delivered", "shipped", "canceled", "unavailable", "invoiced", "processing",
                  "created", "approved"]
TRUE_FALSE = [True, False]

BRONZE_SUITES = {
    "orders": [
        column_to_exist("order_id"), not_null("order_id"), unique("order_id"),
        column_to_exist("customer_id"), not_null("customer_id"),
        column_to_exist("order_status"), in_set("order_status", ORDER_STATUSES),
        column_to_exist("order_purchase_timestamp"), not_null("order_purchase_timestamp"),
        row_count_between(90_000, 110_000), column_count_equals(10)],
    "customers": [
        column_to_exist("customer_id"), not_null("customer_id"), unique("customer_id"),
        column_to_exist("customer_unique_id"), not_null("customer_unique_id"),
        column_to_exist("customer_state"), not_null("customer_state"),
        length_equals("customer_state", 2),
        row_count_between(95_000, 105_000), column_count_equals(7)],
    "order_items": [
        column_to_exist("order_id"), not_null("order_id"),
        column_to_exist("order_item_id"), not_null("order_item_id"),
        column_to_exist("price"), not_null("price"), between("price", 0, 10_000),
        column_to_exist("freight_value"), between("freight_value", 0, 1_000),
        row_count_between(100_000, 120_000)],
}

SILVER_SUITES = {
    "customers": [
        column_to_exist("customer_id"), column_to_exist("geolocation_lat"),
        column_to_exist("geolocation_lng"), column_to_exist("has_geolocation"),
        unique("customer_id"), not_null("customer_id"),
        between("geolocation_lat", -34, 6, 0.99), between("geolocation_lng", -75, -33, 0.99),
        in_set("has_geolocation", TRUE_FALSE), length_equals("customer_state", 2),
        row_count_between(95_000, 105_000), column_count_equals(11)],
    "orders": [
        column_to_exist("order_id"), column_to_exist("order_status"),
        column_to_exist("is_delivered"), unique("order_id"), not_null("order_id"),
        in_set("order_status", ORDER_STATUSES), not_null("order_purchase_timestamp"),
        in_set("is_delivered", TRUE_FALSE), in_set("is_approved", TRUE_FALSE),
        not_null("customer_id"), row_count_between(95_000, 105_000)],
    "products": [
        column_to_exist("product_id"), column_to_exist("product_volume_cm3"),
        column_to_exist("has_dimensions"), unique("product_id"), not_null("product_id"),
        between("product_weight_g", 0, 50_000, 0.99),
        between("product_volume_cm3", 0, 1_000_000, 0.99),
        between("product_photos_qty", 0, 100), in_set("has_category", TRUE_FALSE),
        in_set("has_dimensions", TRUE_FALSE), row_count_between(30_000, 35_000)],
    "order_items": [
        column_to_exist("order_id"), column_to_exist("order_item_id"), column_to_exist("price"),
        column_to_exist("item_total_value"), not_null("order_id"), not_null("order_item_id"),
        not_null("product_id"), not_null("seller_id"), between("price", 0, 10_000, 0.99),
        between("freight_value", 0, 1_000, 0.99), between("item_total_value", 0, 11_000, 0.99),
        in_set("has_price", TRUE_FALSE), row_count_between(100_000, 120_000)],
}


def _unexpected(kind: str, args: dict) -> Column:
    c = F.col(args["column"])
    if kind == NOT_NULL:
        return c.isNull()
    if kind == IN_SET:
        return ~c.isin(*args["value_set"])
    if kind == BETWEEN:
        return ~c.between(args["min_value"], args["max_value"])
    return F.length(c) != args["value"]


def run_suite(df: DataFrame, suite: Sequence[dict]) -> DataFrame:
    """One row per rule: evaluated and unexpected values, observed figure, success."""
    aggregates = [F.count("*").alias("rows")]
    wide, extra = [], []
    for i, rule in enumerate(suite, 1):
        kind, args = rule["expectation_type"], rule["kwargs"]
        column, mostly = args.get("column"), float(args.get("mostly", 1.0))
        known = column is None or column in df.columns

        def row(evaluated=None, unexpected=None, observed=None, success=None,
                i=i, kind=kind, column=column, mostly=mostly) -> list[Column]:
            if success is None:
                passed = (evaluated - unexpected).cast("double")
                success = (evaluated == 0) | (passed >= evaluated.cast("double") * mostly)
            null = F.lit(None)
            return [F.lit(i).alias("position"), F.lit(kind).alias("expectation_type"),
                    F.lit(column).cast("string").alias("column_name"),
                    (null if evaluated is None else evaluated).cast("bigint").alias("evaluated"),
                    (null if unexpected is None else unexpected).cast("bigint").alias("unexpected"),
                    (null if observed is None else observed).cast("bigint").alias("observed"),
                    F.lit(mostly).alias("mostly"), success.alias("success")]

        if kind == EXIST or not known:
            wide.append(F.struct(*row(success=F.lit(known))))
        elif kind == COLUMN_COUNT:
            width = len(df.columns)
            wide.append(F.struct(*row(observed=F.lit(width), success=F.lit(width == args["value"]))))
        elif kind == ROW_COUNT:
            wide.append(F.struct(*row(
                observed=F.col("rows"),
                success=F.col("rows").between(args["min_value"], args["max_value"]))))
        elif kind == UNIQUE:
            counted = (df.filter(F.col(column).isNotNull()).groupBy(column)
                       .agg(F.count("*").alias("n"))
                       .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("evaluated"),
                            F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0))
                            .alias("unexpected")))
            extra.append(counted.select(*row(F.col("evaluated"), F.col("unexpected"))))
        else:
            evaluated = F.count("*") if kind == NOT_NULL else F.count(column)
            aggregates += [evaluated.alias(f"e{i}"),
                           F.count_if(_unexpected(kind, args)).alias(f"u{i}")]
            wide.append(F.struct(*row(F.col(f"e{i}"), F.col(f"u{i}"))))
    one_pass = [df.agg(*aggregates).select(F.inline(F.array(*wide)))] if wide else []
    return reduce(DataFrame.unionByName, one_pass + extra)


def suite_statistics(results: DataFrame, table: str) -> DataFrame:
    """Evaluated, successful and unsuccessful rules of one suite run."""
    good = F.count_if(F.col("success"))
    return results.agg(F.lit(table).alias("table_name"), F.count("*").alias("evaluated"),
                       good.alias("successful"), (F.count("*") - good).alias("unsuccessful"),
                       C.percentage(good, F.count("*")).alias("success_percent"),
                       F.bool_and("success").alias("success"))


def failures(results: DataFrame) -> DataFrame:
    return results.filter(~F.col("success"))


def summarise(statistics: Sequence[DataFrame]) -> DataFrame:
    """Roll-up over the statistics of several tables."""
    rows = reduce(DataFrame.unionByName, statistics)
    good, all_rules = F.sum("successful"), F.sum("evaluated")
    return rows.agg(F.count("*").alias("tables"), all_rules.alias("evaluated"),
                    good.alias("successful"), F.sum("unsuccessful").alias("unsuccessful"),
                    C.percentage(good, all_rules).alias("success_percent"))


def run_checkpoint(df: DataFrame, suite: Sequence[dict], suite_name: str, run_id: str,
                   run_at: str, store: str | None = None) -> DataFrame:
    """Results of one run with its name and time; kept in ``store`` when one is given.

    A repeated run replaces its own files, so a retry does not count twice.
    """
    results = run_suite(df, suite).select(
        F.lit(suite_name).alias("suite"), F.lit(run_id).alias("run_id"),
        F.lit(run_at).cast("timestamp_ntz").alias("run_at"), "*")
    if store is None:
        return results
    # A row per rule: one small file for each run and suite.
    (results.withColumn("run_date", F.to_date("run_at")).coalesce(1)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("run_date", "run_id", "suite").parquet(store))
    return read_store(df.sparkSession, store, since=run_at).filter(
        (F.col("run_id") == run_id) & (F.col("suite") == suite_name))


def read_store(spark: SparkSession, store: str, since: str | None = None) -> DataFrame:
    """Stored results; with ``since`` only the folders of runs from that day on are read."""
    rows = spark.read.schema(
        "run_at timestamp_ntz, position int, expectation_type string, column_name string, "
        "evaluated bigint, unexpected bigint, observed bigint, mostly double, success boolean, "
        "run_date date, run_id string, suite string").parquet(store)
    if since is not None:
        rows = rows.filter(F.col("run_date") >= F.to_date(F.lit(since)))
    return rows.drop("run_date")


def top_failures(store: DataFrame, k: int = 5) -> DataFrame:
    """Rules that failed most often over all stored runs."""
    rule = ["suite", "expectation_type", "column_name"]
    return (store.filter(~F.col("success")).groupBy(*rule).agg(F.count("*").alias("failures"))
            .orderBy(F.desc("failures"), *rule).limit(k))


def success_trend(store: DataFrame) -> DataFrame:
    """Success rate per run, oldest first."""
    good = F.count_if(F.col("success"))
    return (store.groupBy("run_id", "run_at")
            .agg(F.count("*").alias("evaluated"), good.alias("successful"),
                 C.percentage(good, F.count("*")).alias("success_percent"))
            .orderBy("run_at", "run_id"))
