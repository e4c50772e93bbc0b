"""Sinks: bronze landing, full refresh, partitioned export, incremental merge, audits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from storeloom.operators.checks import CheckFailed
from storeloom.operators.dedup import dedupe_keep_first
from storeloom.session import cut_lineage

#: Partition column of tables that are upserted by month.
MONTH = "month"


# --- bronze ---------------------------------------------------------------------------------

def add_load_metadata(df: DataFrame, source: str | Column, loaded_at: str) -> DataFrame:
    """Lineage columns; ``source`` is a file name or a column such as ``input_file_name()``."""
    origin = F.lit(source) if isinstance(source, str) else source
    return df.withColumns({"_loaded_at": F.lit(loaded_at).cast("timestamp_ntz"),
                           "_source_file": origin})


def bronze_path(base: str, table: str, date: str) -> str:
    return f"{base}/bronze/{table}/{date}.parquet"


def write_bronze(df: DataFrame, base: str, table: str, date: str) -> str:
    path = bronze_path(base, table, date)
    df.write.mode("overwrite").parquet(path)
    return path


def full_refresh(df: DataFrame, table: str) -> None:
    """Idempotent load: the table holds exactly the frame afterwards."""
    df.write.mode("overwrite").format("parquet").saveAsTable(table)


def materialize(df: DataFrame, table: str) -> DataFrame:
    """Rebuild a table from a query, which may read the old one. The new rows are complete under a
    name of their own before the old table goes, so a failed build leaves it as it was."""
    spark = df.sparkSession
    building = f"{table}_building"
    spark.sql(f"DROP TABLE IF EXISTS {building}")
    df.write.format("parquet").saveAsTable(building)
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"ALTER TABLE {building} RENAME TO {table}")
    return spark.table(table)


def save_clustered(df: DataFrame, table: str, by: Sequence[str], buckets: int) -> DataFrame:
    """A table in ``buckets`` files by the hash of ``by``, sorted by it. Tables with equal keys and
    buckets meet, and are grouped by the key, without an exchange. Choose the number so that a
    bucket fits a task: it is fixed until the table is written anew."""
    (df.repartition(buckets, *by).write.mode("overwrite").format("parquet")
     .bucketBy(buckets, *by).sortBy(*by).saveAsTable(table))
    return df.sparkSession.table(table)


def write_counted(df: DataFrame, path: str) -> int:
    """Writes the frame and returns the rows that the write itself saw."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
    return seen.get["rows"]


def assert_same_count(source: DataFrame | int, target: DataFrame | int) -> int:
    """Both sides hold the same number of rows, or the load fails. A count that a write has
    returned is taken as it is."""
    expected, actual = (x if isinstance(x, int) else x.count() for x in (source, target))
    if expected != actual:
        raise CheckFailed(f"source has {expected} rows, target {actual}")
    return actual


# --- export ---------------------------------------------------------------------------------

def _with_month(df: DataFrame, ts_col: str) -> DataFrame:
    return df.withColumns({"year": F.year(ts_col), "month": F.date_format(ts_col, "MM")})


def export_partitioned(df: DataFrame, path: str, ts_col: str = "processed_at") -> str:
    """``year=YYYY/month=MM`` folders of snappy parquet; returns ``skipped`` for no rows, for which
    ``skipped_export`` is the record.

    The rebalance hint gathers each month in few files, and splits a month that is larger than
    the advised partition size over several tasks.
    """
    if df.isEmpty():
        return "skipped"
    (_with_month(df, ts_col).hint("rebalance", "year", "month")
     .write.mode("overwrite").partitionBy("year", "month").option("compression", "snappy")
     .parquet(path))
    return "success"


def skipped_export(spark: SparkSession, table: str) -> DataFrame:
    """Status record of a table that had nothing to export."""
    return spark.createDataFrame(
        [(table, "skipped", "empty table", 0, 0)],
        "table_name string, status string, reason string, records bigint, partitions bigint")


def export_manifest(df: DataFrame, ts_col: str, table: str) -> DataFrame:
    """Rows per partition of an export."""
    month = _with_month(df, ts_col).groupBy("year", "month").agg(F.count("*").alias("records"))
    folder = F.format_string("%s/year=%d/month=%s", F.lit(table), "year", "month")
    return month.select(F.lit(table).alias("table_name"), "year", "month",
                        folder.alias("partition"), "records")


def export_summary(manifests: Sequence[DataFrame]) -> DataFrame:
    """Records and partitions per exported table."""
    return (reduce(DataFrame.unionByName, manifests).groupBy("table_name")
            .agg(F.sum("records").alias("records"), F.count("*").alias("partitions")))


# --- incremental ----------------------------------------------------------------------------

def incremental_merge(target: DataFrame, updates: DataFrame, key: Sequence[str],
                      order_col: str, ties: Sequence[str] = ()) -> DataFrame:
    """Upsert: of a key's target row and its updates the newest stays, so a late update changes
    nothing. Rows of the same instant are told apart by ``ties``, the largest first, and then by
    all other columns, so that the result does not depend on the order of arrival."""
    rest = [c for c in target.columns if c not in (*key, order_col, *ties)]
    return dedupe_keep_first(target.unionByName(updates.select(*target.columns)), key,
                             [F.desc_nulls_last(c) for c in (order_col, *ties, *rest)])


def replace_partitions(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Write the frame's partitions in place of those of the same values; all others stay. The same
    frame twice leaves one copy of its rows."""
    (df.hint("rebalance", *by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*by).parquet(path))
    df.sparkSession.catalog.refreshByPath(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)


def read_months(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A table written by ``upsert_months``, with its month; empty before the first batch."""
    full = StructType([f for f in schema if f.name != MONTH]).add(MONTH, "string")
    if not path_exists(spark, path):
        return spark.createDataFrame([], full)
    return spark.read.schema(full).parquet(path)


def upsert_months(spark: SparkSession, path: str, updates: DataFrame, key: Sequence[str],
                  at: str, order_col: str, ties: Sequence[str] = (),
                  moves: bool = False) -> list[str]:
    """Upsert into a table of one folder per month of ``at``; returns the months written.

    The updates' months are read, merged by ``incremental_merge`` and put in place of the old ones;
    the files of all other months are neither read nor written. A batch that comes twice changes
    nothing the second time, and a late row only replaces an older one. Rows without ``at`` have
    a folder of their own.

    ``at`` is taken to be fixed for a key, as the day of a purchase is. With ``moves`` it may change:
    the keys' present months are looked up first, a scan of the key columns only, and belong
    to the batch, so that a key leaves the month that it was in.

    One writer at a time. Spark puts the months in place when the job commits: a job that fails
    before leaves the table as it was. A driver lost during the commit itself, between taking the
    old month away and renaming the new one, leaves that month in the staging folder.
    """
    month = F.coalesce(F.date_format(at, "yyyy-MM"), F.lit("none"))
    new = updates.withColumn(MONTH, month)
    held = read_months(spark, path, updates.schema)
    touched = new.select(MONTH)
    if moves:
        touched = touched.union(held.select(*key, MONTH).join(
            new.select(*key).distinct(), list(key), "left_semi").select(MONTH))
    # One row per month.
    months = sorted(r[0] for r in touched.distinct().collect())
    if not months:
        return []
    merged = incremental_merge(held.filter(F.col(MONTH).isin(months)), new.select(*held.columns),
                               list(key) if moves else [*key, MONTH], order_col, ties)
    if moves:
        merged = cut_lineage(merged)
        for gone in set(months) - {r[0] for r in merged.select(MONTH).distinct().collect()}:
            folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{MONTH}={gone}")
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
    replace_partitions(merged, path, [MONTH])
    return months


# --- audit ----------------------------------------------------------------------------------

def audit_files(spark: SparkSession, base: str, tables: Mapping[str, str],
                min_mb: float = 0.01) -> DataFrame:
    """Bytes and files of each table's path below ``base``: OK, TOO_SMALL or MISSING."""
    wanted = spark.createDataFrame(list(tables.items()), "table_name string, path string")
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    present = []
    for path in tables.values():
        target = jvm.org.apache.hadoop.fs.Path(f"{base}/{path}")
        if target.getFileSystem(conf).exists(target):
            present.append((path, f"{base}/{path}"))
    parts = [spark.read.format("binaryFile").option("recursiveFileLookup", True)
             .option("pathGlobFilter", "*.parquet").load(full)
             .agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))
             .select(F.lit(path).alias("path"), "files", "bytes") for path, full in present]
    empty = spark.createDataFrame([], "path string, files bigint, bytes bigint")
    found = reduce(DataFrame.unionByName, parts, empty)
    size = F.coalesce("bytes", F.lit(0)) / F.lit(1024 * 1024)
    return (wanted.join(found, "path", "left")
            .select("table_name", F.col("files").isNotNull().alias("exists"),
                    F.round(size, 4).alias("size_mb"),
                    F.when(F.col("files").isNull(), "MISSING").when(size < min_mb, "TOO_SMALL")
                    .otherwise("OK").alias("status")))
