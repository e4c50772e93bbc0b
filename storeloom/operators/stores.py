"""Monitoring tables that grow with each run: schemas, value counts, statistics.

Each store is a folder of Parquet partitions. A capture replaces the partitions of its own key and no
others, so a repeated one leaves a single copy, and readers prune to the captures they ask for.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storeloom.operators import observe
from storeloom.operators.ordered import quantile_values
from storeloom.session import cut_lineage
from storeloom.sources.writers import path_exists, replace_partitions

SCHEMA_LOG = ("captured_at timestamp_ntz, schema_name string, table_name string, column_name string, "
              "change_type string, severity string, previous_value string, current_value string, "
              "capture string")
VALUE_COUNTS = "column_name string, value decimal(20,6), n bigint, table_name string, period date"
STATISTICS = ("captured_at timestamp_ntz, table_name string, column_name string, metric_name string, "
              "metric_value double, row_count bigint, capture string")


def _read(spark: SparkSession, store: str, schema: str) -> DataFrame:
    if not path_exists(spark, store):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(store)


def _moment(at: str | Column) -> Column:
    return (F.lit(at) if isinstance(at, str) else at).cast("timestamp_ntz")


def _capture_id(at: str) -> Column:
    """Partition value of a capture: text that sorts like the moment."""
    return F.date_format(_moment(at), "yyyyMMdd'T'HHmmss")


# --- schemas --------------------------------------------------------------------------------

def read_schema_log(spark: SparkSession, store: str) -> DataFrame:
    return _read(spark, store, SCHEMA_LOG)


def schema_as_of(log: DataFrame, at: str, inclusive: bool = True) -> DataFrame:
    """The columns of each table as its last capture up to a moment found them:
    ``schema_name, table_name, column_name, value``."""
    last = _capture_id(at)
    seen = log.filter(F.col("capture") <= last if inclusive else F.col("capture") < last)
    # One row per table and column: what its newest capture says, if that is the table's newest.
    newest = seen.groupBy("schema_name", "table_name", "column_name").agg(
        F.max("capture").alias("capture"), F.max_by("current_value", "capture").alias("value"))
    tables = seen.groupBy("schema_name", "table_name").agg(F.max("capture").alias("capture"))
    return (newest.join(tables, ["schema_name", "table_name", "capture"])
            .filter(F.col("value").isNotNull()).drop("capture"))


def capture_schema(spark: SparkSession, store: str, listing: DataFrame, schema_name: str,
                   captured_at: str) -> DataFrame:
    """Compare column listings (``describe_columns``) with each table's last capture before this
    moment, keep every column's row in the log, and return the rows.

    ADDED, REMOVED, MODIFIED or UNCHANGED with severity, previous and current value. Without an
    earlier capture all columns are ADDED; a table that is not in the listing is not captured.
    The same moment again replaces what it wrote.
    """
    new = observe.column_values(listing, "current_value")
    old = (schema_as_of(read_schema_log(spark, store), captured_at, inclusive=False)
           .filter(F.col("schema_name") == schema_name)
           .join(new.select("table_name").distinct(), "table_name", "left_semi")
           .select("table_name", "column_name", F.col("value").alias("previous_value")))
    rows = cut_lineage(
        observe.value_changes(old, new)
        .withColumns({"captured_at": _moment(captured_at), "schema_name": F.lit(schema_name),
                      "capture": _capture_id(captured_at)})
        .select(*[f.split()[0] for f in SCHEMA_LOG.split(", ")]))
    replace_partitions(rows, store, ["schema_name", "capture"])
    return rows


def schema_changes(log: DataFrame, since: str) -> DataFrame:
    """Changes from a moment on, the timeline of a schema."""
    return log.filter((F.col("capture") >= _capture_id(since)) & (F.col("change_type") != "UNCHANGED"))


# --- value counts and statistics ------------------------------------------------------------

def save_value_counts(df: DataFrame, store: str, table: str, cols: Sequence[str], at: str,
                      grain: str = "day") -> None:
    """Mergeable state of numeric columns: how often each value occurs in each period of ``at``.

    Adding the counts of periods gives the counts of any span, and all statistics follow from
    counts. Numbers are kept to six decimals. The state is as large as a period's distinct
    values, so round what is finer before. A period comes as a whole: saving it again replaces it.
    """
    entries = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("decimal(20,6)").alias("value"))
                        for c in cols])
    counts = (df.filter(F.col(at).isNotNull())
              .select(F.to_date(F.date_trunc(grain, at)).alias("period"), F.explode(entries).alias("e"))
              .groupBy("period", "e.column_name", "e.value").agg(F.count("*").alias("n"))
              .select("column_name", "value", "n", F.lit(table).alias("table_name"), "period"))
    replace_partitions(counts, store, ["table_name", "period"])


def statistics_of_span(spark: SparkSession, store: str, table: str, start: str, end: str,
                       captured_at: str) -> DataFrame:
    """What ``column_statistics`` gives for the rows of all periods from ``start`` to before ``end``, from
    the stored counts alone; only the span's partitions are read."""
    day = F.col("period")
    span = _read(spark, store, VALUE_COUNTS).filter(
        (F.col("table_name") == table) & (day >= F.lit(start).cast("date")) & (day < F.lit(end).cast("date")))
    counts = cut_lineage(span.filter(F.col("value").isNotNull()).groupBy("column_name", "value")
                         .agg(F.sum("n").alias("n")))
    weighted = F.sum(F.col("value") * F.col("n").cast("decimal(18,0)"))
    basics = counts.groupBy("column_name").agg(
        F.min("value").cast("double").alias("min"), F.max("value").cast("double").alias("max"),
        F.try_divide(weighted.cast("double"), F.sum("n")).alias("mean"), F.sum("n").alias("row_count"))
    gap = F.col("value").cast("double") - F.col("mean")
    spread = counts.join(basics.select("column_name", "mean"), "column_name").groupBy("column_name").agg(
        F.round(F.sqrt(F.try_divide(F.sum(gap * gap * F.col("n")), F.sum("n") - 1)), 4).alias("stddev"))
    wide = basics.join(spread, "column_name")
    simple = wide.select("column_name", F.inline(F.array(*[
        F.struct(F.lit(m).alias("metric_name"), F.col(m).alias("metric_value"))
        for m in ("min", "max", "mean", "stddev")])))
    quantiles = quantile_values(counts, "value", [0.5, 0.95], by=["column_name"], weight="n").select(
        "column_name", F.when(F.col("share") == 0.5, "median").otherwise("p95").alias("metric_name"),
        F.col("quantile").alias("metric_value"))
    return (simple.unionByName(quantiles).join(basics.select("column_name", "row_count"), "column_name")
            .select(_moment(captured_at).alias("captured_at"), F.lit(table).alias("table_name"),
                    "column_name", "metric_name", "metric_value", "row_count"))


def save_statistics(statistics: Sequence[DataFrame], store: str) -> None:
    """Keep the rows of ``column_statistics`` or ``statistics_of_span``, one partition per capture and
    table; the same capture again replaces it."""
    rows = reduce(DataFrame.unionByName, statistics).withColumn(
        "capture", F.date_format("captured_at", "yyyyMMdd'T'HHmmss"))
    replace_partitions(rows, store, ["capture", "table_name"])


def read_statistics(spark: SparkSession, store: str) -> DataFrame:
    return _read(spark, store, STATISTICS)


def statistics_as_of(log: DataFrame, at: Column) -> DataFrame:
    """Each table's last capture up to a moment."""
    seen = log.filter(F.col("capture") <= F.date_format(at, "yyyyMMdd'T'HHmmss"))
    last = seen.groupBy("table_name").agg(F.max("capture").alias("capture"))
    return seen.join(last, ["table_name", "capture"]).drop("capture")


def stored_drift(log: DataFrame, as_of: str, days: int = 7, warn: float = 20, crit: float = 50) -> DataFrame:
    """``statistic_drift`` of the last capture against the last one that was ``days`` old then."""
    now = _moment(as_of)
    return observe.statistic_drift(statistics_as_of(log, now - F.make_dt_interval(F.lit(days))),
                                   statistics_as_of(log, now), warn, crit)
