"""Checks: report frames, and raising forms for the gates of a load."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storeloom.functions import columns as C


class CheckFailed(ValueError):
    """A gate did not pass."""


# --- before the load ------------------------------------------------------------------------

def column_diff(df: DataFrame, expected: Sequence[str]) -> tuple[list[str], list[str]]:
    """Missing and extra column names, in declared order."""
    have = set(df.columns)
    return ([c for c in expected if c not in have],
            [c for c in df.columns if c not in set(expected)])


def check_columns(df: DataFrame, expected: Sequence[str]) -> list[str]:
    """Raise on missing columns; return the extra ones for a warning."""
    missing, extra = column_diff(df, expected)
    if missing:
        raise CheckFailed(f"missing columns: {missing}")
    return extra


def null_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in cols])


def check_not_null(df: DataFrame, cols: Sequence[str]) -> None:
    bad = {k: v for k, v in null_counts(df, cols).first().asDict().items() if v}
    if bad:
        raise CheckFailed(f"NULL values: {bad}")


def range_check(df: DataFrame, col: str, lo, hi) -> DataFrame:
    """Rows, and rows whose value lies outside; NULL is not outside."""
    return df.agg(F.count("*").alias("total"),
                  F.count_if(~F.col(col).between(lo, hi)).alias("out_of_range"))


def check_between(df: DataFrame, col: str, lo, hi) -> None:
    bad = range_check(df, col, lo, hi).first()["out_of_range"]
    if bad:
        raise CheckFailed(f"{bad} values of {col} outside {lo}..{hi}")


# --- after the load -------------------------------------------------------------------------

def key_integrity(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows, distinct keys, NULLs per key column, OK or ERROR.

    One column counts its distinct non-NULL values; a composite key counts tuples.
    """
    key = F.struct(*keys) if len(keys) > 1 else F.col(keys[0])
    out = df.agg(F.count("*").alias("total_records"), F.countDistinct(key).alias("unique_pks"),
                 *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in keys])
    return out.withColumn("pk_integrity", F.when(
        F.col("total_records") == F.col("unique_pks"), "OK").otherwise("ERROR"))


def check_unique(df: DataFrame, keys: Sequence[str], level: str = "error") -> dict:
    """Raise (or, at level ``warn``, only report) when keys repeat or are NULL."""
    row = key_integrity(df, keys).first().asDict()
    if level == "error" and (row["pk_integrity"] != "OK"
                             or any(row[f"null_{c}"] for c in keys)):
        raise CheckFailed(f"key {list(keys)}: {row}")
    return row


def check_row_counts(tables: Mapping[str, DataFrame], expected: Mapping[str, int]) -> DataFrame:
    """Actual against expected rows: OK under 1 %, WARNING from 1 %, ERROR over 5 %."""
    counts = [tables[t].agg(F.count("*").alias("actual"))
              .select(F.lit(t).alias("table_name"), F.lit(n).cast("bigint").alias("expected"),
                      "actual") for t, n in expected.items()]
    diff = F.col("actual") - F.col("expected")
    pct = F.when(F.col("expected") > 0, C.ratio(diff * 100, F.col("expected"))).otherwise(0.0)
    return (reduce(DataFrame.unionByName, counts)
            .withColumns({"diff": diff, "diff_pct": pct})
            .withColumn("status", F.when(F.abs("diff_pct") > 5, "ERROR")
                        .when(F.abs("diff_pct") >= 1, "WARNING").otherwise("OK")))


def schema_report(tables: Mapping[str, DataFrame], expected: Mapping[str, Sequence[str]]) -> DataFrame:
    """Required columns per table, OK or FAIL; reads schemas only."""
    spark = next(iter(tables.values())).sparkSession
    rows = []
    for name, cols in expected.items():
        missing, _ = column_diff(tables[name], cols)
        rows.append((name, len(cols), len(tables[name].columns), ", ".join(missing),
                     "FAIL" if missing else "OK"))
    return spark.createDataFrame(
        rows, "table_name string, expected_cols int, actual_cols int, missing string, status string")


def check_tables(spark: SparkSession, names: Sequence[str]) -> None:
    absent = [n for n in names if not spark.catalog.tableExists(n)]
    if absent:
        raise CheckFailed(f"tables not in the catalog: {absent}")


def describe_columns(df: DataFrame, table: str) -> DataFrame:
    """Column listing: name, type, nullability, position."""
    return df.sparkSession.createDataFrame(
        [(table, f.name, f.dataType.simpleString(), f.nullable, i)
         for i, f in enumerate(df.schema, 1)],
        "table_name string, column_name string, data_type string, is_nullable boolean, "
        "ordinal_position int")


def check_timestamp_order(df: DataFrame, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """Rows per ``(earlier, later)`` rule in which the later moment comes first."""
    return df.agg(*[F.count_if(F.col(later) < F.col(earlier)).alias(f"{later}_before_{earlier}")
                    for earlier, later in rules])


def check_sequence(df: DataFrame, group: str, seq: str) -> DataFrame:
    """Groups whose numbering does not start at 1 or has a gap."""
    spans = df.groupBy(group).agg(F.min(seq).alias("first"), F.max(seq).alias("last"),
                                  F.countDistinct(seq).alias("numbers"))
    return spans.agg(F.count("*").alias("groups"),
                     F.count_if(F.col("first") != 1).alias("not_from_one"),
                     F.count_if(F.col("last") - F.col("first") + 1 != F.col("numbers"))
                     .alias("with_gap"))


# --- bronze against silver ------------------------------------------------------------------

def volumetry(bronze: DataFrame, silver: DataFrame) -> DataFrame:
    """Completeness: OK if equal, WARNING from 99 %, else ERROR; NULL percent of nothing."""
    def rows(df: DataFrame, layer: str) -> DataFrame:
        return df.agg(F.count("*").alias("n")).withColumn("layer", F.lit(layer))

    def pick(layer: str):
        return F.max(F.when(F.col("layer") == layer, F.col("n"))).alias(f"{layer}_records")

    both = rows(bronze, "bronze").unionByName(rows(silver, "silver"))
    b, s = F.col("bronze_records"), F.col("silver_records")
    return (both.agg(pick("bronze"), pick("silver"))
            .withColumn("completeness_pct", C.ratio(s * 100, b))
            .withColumn("volumetry_status", F.when(s == b, "OK")
                        .when(s * 100 >= b * 99, "WARNING").otherwise("ERROR")))


def audit_check(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    first = cols[0]
    return df.agg(F.count("*").alias("total"),
                  *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in cols],
                  F.min(first).alias(f"min_{first}"), F.max(first).alias(f"max_{first}"))


def case_check(df: DataFrame, col: str, case: str) -> DataFrame:
    """Rows whose text is all in the wrong case, over the full table."""
    wrong = C.is_all_upper(col) if case == "lower" else C.is_all_lower(col)
    return df.agg(F.count("*").alias("total"), F.count_if(wrong).alias("wrong_case"))


def derived_sum_check(df: DataFrame, total: str, parts: Sequence[str]) -> DataFrame:
    expected = reduce(lambda a, b: a + b, [F.col(p) for p in parts])
    return df.agg(F.count("*").alias("total"),
                  F.count_if(F.col(total) != expected).alias("calc_errors"))


def geo_check(df: DataFrame, flag: str = "is_valid_brazil_coords",
              key: str = "geolocation_zip_code_prefix") -> DataFrame:
    return (df.agg(F.count("*").alias("total"), F.count_if(F.col(flag)).alias("valid_coords"),
                   F.countDistinct(key).alias("unique_zips"))
            .withColumn("status", F.when((F.col("total") == F.col("valid_coords"))
                                         & (F.col("total") == F.col("unique_zips")), "OK")
                        .otherwise("ERROR")))


def not_null_check(df: DataFrame, col: str) -> DataFrame:
    return null_counts(df, [col])


def run_result(table: str, volumes: DataFrame, keys: DataFrame,
               loads: DataFrame | None = None) -> DataFrame:
    """One-row record of a silver run from its volumetry and key reports. With ``loads`` (of
    ``load_reports``), also the broken records and coerced cells of the table's load."""
    left = volumes.withColumn("table_name", F.lit(table))
    right = keys.select("pk_integrity").withColumn("table_name", F.lit(table))
    ok = (F.col("volumetry_status") != "ERROR") & (F.col("pk_integrity") == "OK")
    out = left.join(right, "table_name").select(
        "table_name", F.when(ok, "success").otherwise("failed").alias("status"),
        "bronze_records", "silver_records", "completeness_pct")
    if loads is None:
        return out
    return out.join(loads.select("table_name", "rejected", "coerced_cells"), "table_name", "left")


def require_ok(report: DataFrame, status: str, bad: Sequence[str] = ("ERROR", "FAIL")) -> None:
    """Raise when a report row carries a failing status; the message counts all of them and shows
    the first few."""
    failing = report.filter(F.col(status).isin(*bad))
    shown = failing.take(20)
    if shown:
        total = failing.count()
        text = "; ".join(str(r.asDict()) for r in shown)
        raise CheckFailed(f"{total} failing rows, {len(shown)} shown: {text}")
