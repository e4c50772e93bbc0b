"""Scans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FILE_ORDER = "_file_order"


def read_bronze_csv(spark: SparkSession, path: str, schema: str,
                    columns: Sequence[str] | None = None, file_order: bool = False,
                    multi_line: bool = False) -> DataFrame:
    """Headered CSV with a declared schema (DDL).

    ``file_order`` adds an ordinal (file, offset of the split, row within it) that keep-first
    deduplication can sort by. ``multi_line`` is for text with line breaks inside quotes; such
    files cannot be split, so keep it for the tables that need it.
    """
    df = (spark.read.schema(schema).option("header", True).option("enforceSchema", False)
          .option("quote", '"').option("escape", '"').option("multiLine", multi_line)
          .csv(path))
    if file_order:
        df = df.withColumn(FILE_ORDER, F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("offset"),
            F.monotonically_increasing_id().alias("row")))
    if columns is not None:
        df = df.select(*columns, *([FILE_ORDER] if file_order else []))
    return df


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """Parquet table ``{base}/{name}.parquet``; a missing path raises ``PATH_NOT_FOUND``."""
    return spark.read.parquet(f"{base}/{name}.parquet")


def read_partitioned(spark: SparkSession, path: str) -> DataFrame:
    """Export written by year and month, without the two path columns."""
    return spark.read.option("basePath", path).parquet(path).drop("year", "month")


def preview(df: DataFrame, n: int) -> DataFrame:
    return df.limit(n)


def sample_rows(df: DataFrame, n: int) -> DataFrame:
    """Unordered row sample. Contracts never use it by themselves; they read whole tables."""
    return df.limit(n)


def require_path(spark: SparkSession, path: str) -> None:
    """Raise when a source path is missing, on any file system Spark can reach."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(target):
        raise FileNotFoundError(path)


def zip_prefix(col: str | Column) -> Column:
    """Five-digit zip text; leading zeros lost by an integer read come back."""
    return F.lpad((F.col(col) if isinstance(col, str) else col).cast("string"), 5, "0")
