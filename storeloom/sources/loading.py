"""Dated loads: text that does not parse becomes NULL and is counted, broken records are kept aside."""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from storeloom.functions import columns as C

RECORD = "_corrupt_record"


class LoadReport(NamedTuple):
    """Records of a file: kept, rejected, and cells per column that had text but became NULL."""

    table: str
    rows: int
    rejected: int
    coerced: Mapping[str, int]


def read_coerced_csv(spark: SparkSession, path: str, schema: str, multi_line: bool = False) -> DataFrame:
    """Every record of a headered CSV as text, under the names of the declared schema, with the raw
    record in ``_corrupt_record`` where its fields do not fit the header."""
    names = spark.createDataFrame([], schema.replace(" NOT NULL", "")).columns
    text = StructType([StructField(c, StringType()) for c in (*names, RECORD)])
    return (spark.read.schema(text).option("header", True).option("enforceSchema", False)
            .option("quote", '"').option("escape", '"').option("multiLine", multi_line)
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", RECORD).csv(path))


def coerced(raw: DataFrame, schema: str) -> DataFrame:
    """The declared types, NULL where a text does not parse, and ``_coerced``: the columns of a
    record in which that happened. Broken records keep their raw text."""
    fields = raw.sparkSession.createDataFrame([], schema.replace(" NOT NULL", "")).schema

    def parsed(f: StructField):
        if isinstance(f.dataType, StringType):
            return F.col(f.name)
        if f.dataType.typeName() == "timestamp_ntz":
            return C.parse_timestamp(F.trim(f.name))
        return F.trim(f.name).try_cast(f.dataType)

    lost = [F.when((F.trim(f.name) != "") & parsed(f).isNull(), F.lit(f.name)) for f in fields
            if not isinstance(f.dataType, StringType)]
    return raw.select(*[parsed(f).alias(f.name) for f in fields],
                      F.array_compact(F.array(*lost) if lost else F.array().cast("array<string>")).alias("_coerced"),
                      RECORD)


def load_csv(spark: SparkSession, path: str, schema: str, table: str, target: str, rejects: str,
             multi_line: bool = False) -> LoadReport:
    """Load a file into ``target`` (overwritten) with coerced cells, and its broken records, as text and
    as far as they could be read, into ``rejects``. The write counts what it sees, so the file is read once, and a second time only
    if there are broken records."""
    rows = coerced(read_coerced_csv(spark, path, schema, multi_line), schema)
    typed = [c for c in rows.columns if c not in ("_coerced", RECORD)]
    seen, good = Observation(), F.col(RECORD).isNull()
    counted = rows.observe(
        seen, F.count_if(good).alias("rows"), F.count_if(~good).alias("rejected"),
        *[F.count_if(good & F.array_contains("_coerced", c)).alias(f"coerced_{c}") for c in typed])
    counted.filter(good).select(*typed).write.mode("overwrite").parquet(target)
    counts = seen.get
    if counts["rejected"]:
        broken = rows.filter(~good).select(F.lit(table).alias("table_name"), F.col(RECORD).alias("record"), *typed)
        broken.write.mode("overwrite").parquet(rejects)
    return LoadReport(table, counts["rows"], counts["rejected"],
                      {c: counts[f"coerced_{c}"] for c in typed if counts[f"coerced_{c}"]})


def load_reports(spark: SparkSession, reports: list[LoadReport]) -> DataFrame:
    """One row per load: ``table_name, loaded, rejected, coerced_cells, coerced_columns``."""
    return spark.createDataFrame(
        [(r.table, r.rows, r.rejected, sum(r.coerced.values()), dict(r.coerced)) for r in reports],
        "table_name string, loaded bigint, rejected bigint, coerced_cells bigint, coerced_columns map<string, bigint>")
