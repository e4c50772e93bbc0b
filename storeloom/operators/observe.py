"""Freshness, schema changes and drift."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storeloom.functions import columns as C
from storeloom.operators.ordered import ordered_scan, quantile_values


def freshness(tables: Sequence[tuple[str, str, DataFrame, str]], as_of: str) -> DataFrame:
    """``(layer, table, frame, timestamp column)`` to last update, rows, age and status."""
    now = F.lit(as_of).cast("timestamp_ntz")
    parts = [df.agg(F.max(F.col(ts).cast("timestamp_ntz")).alias("last_update"),
                    F.count("*").alias("row_count"))
             .select(F.lit(layer).alias("layer"), F.lit(name).alias("table_name"),
                     "last_update", "row_count") for layer, name, df, ts in tables]
    seconds = F.timestamp_diff("SECOND", F.col("last_update"), now)
    age = F.col("minutes_ago")
    return (reduce(DataFrame.unionByName, parts)
            .withColumn("minutes_ago", F.round(seconds / 60, 1))
            .withColumn("status", F.when(age < 60, "GREEN").when(age < 1440, "YELLOW")
                        .when(age >= 1440, "RED")))


def stale_tables(report: DataFrame, minutes: int = 1440) -> DataFrame:
    return report.filter(F.col("minutes_ago") > minutes)


def column_values(listing: DataFrame, name: str) -> DataFrame:
    """Each listed column's type and nullability as one text."""
    text = F.concat_ws(" ", "data_type", F.when(F.col("is_nullable"), "NULL").otherwise("NOT NULL"))
    return listing.select("table_name", "column_name", text.alias(name))


def value_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """``previous_value`` against ``current_value``: every column with its change and severity."""
    both = old.join(new, ["table_name", "column_name"], "full_outer")
    was, now = F.col("previous_value"), F.col("current_value")
    return (both.withColumn("change_type", F.when(was.isNull(), "ADDED")
                            .when(now.isNull(), "REMOVED").when(was != now, "MODIFIED")
                            .otherwise("UNCHANGED"))
            .withColumn("severity", F.when(F.col("change_type") == "REMOVED", "CRITICAL")
                        .when(F.col("change_type") == "MODIFIED", "WARNING").otherwise("INFO")))


def schema_diff(previous: DataFrame, current: DataFrame) -> DataFrame:
    """Two column listings compared: every column with its change and severity.

    ``INFO`` for a new column, ``CRITICAL`` for a lost one, ``WARNING`` for another type.
    """
    return value_changes(column_values(previous, "previous_value"), column_values(current, "current_value"))


def column_statistics(df: DataFrame, cols: Sequence[str], table: str, as_of: str) -> DataFrame:
    """min, max, mean, stddev, median and p95 per column, one metric per row.

    The quantiles are exact, from distributed value counts.
    """
    simple = {"min": lambda c: F.min(c).cast("double"), "max": lambda c: F.max(c).cast("double"),
              "mean": C.mean, "stddev": lambda c: F.round(F.stddev_samp(c), 4)}
    wide = df.agg(*[f(c).alias(f"{m}_{c}") for m, f in simple.items() for c in cols],
                  *[F.count(c).alias(f"rows_{c}") for c in cols])

    def entry(c: str, m: str) -> Column:
        return F.struct(F.lit(c).alias("column_name"), F.lit(m).alias("metric_name"),
                        F.col(f"{m}_{c}").alias("metric_value"))

    basics = wide.select(F.inline(F.array(*[entry(c, m) for m in simple for c in cols])))
    counts = wide.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"rows_{c}").alias("row_count"))
        for c in cols])))
    values = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        [], list(cols), "column_name", "value")
    quantiles = quantile_values(values, "value", [0.5, 0.95], by=["column_name"]).select(
        "column_name", F.when(F.col("share") == 0.5, "median").otherwise("p95")
        .alias("metric_name"), F.col("quantile").alias("metric_value"))
    return (basics.unionByName(quantiles).join(counts, "column_name")
            .select(F.lit(as_of).cast("timestamp_ntz").alias("captured_at"),
                    F.lit(table).alias("table_name"), "column_name", "metric_name",
                    "metric_value", "row_count"))


def drift_level(pct: Column, warn: float, crit: float) -> Column:
    return (F.when(F.abs(pct) > crit, "CRITICAL").when(F.abs(pct) > warn, "WARNING")
            .when(pct.isNotNull(), "OK"))


def statistic_drift(base: DataFrame, cur: DataFrame, warn: float = 20, crit: float = 50) -> DataFrame:
    """Change of each statistic in percent of its baseline; NULL for a baseline of 0."""
    key = ["table_name", "column_name", "metric_name"]
    old = base.select(*key, F.col("metric_value").alias("baseline_value"))
    new = cur.select(*key, F.col("metric_value").alias("current_value"))
    b, c = F.col("baseline_value"), F.col("current_value")
    pct = F.try_divide((c - b) * 100, b)
    return old.join(new, key).withColumn("drift_pct", F.round(pct, 4)).withColumn(
        "status", drift_level(pct, warn, crit))


def share_drift(base: DataFrame, cur: DataFrame, col: str) -> DataFrame:
    """Share of each category in both samples, in percent, and the change in points."""
    tagged = (base.select(F.col(col).alias("category"), F.lit(1).alias("b"), F.lit(0).alias("c"))
              .unionByName(cur.select(F.col(col).alias("category"), F.lit(0).alias("b"),
                                      F.lit(1).alias("c"))))
    counts = tagged.groupBy("category").agg(F.sum("b").alias("b"), F.sum("c").alias("c"))
    totals = counts.agg(F.struct(F.sum("b").alias("b"), F.sum("c").alias("c"))).scalar()
    old = C.ratio(F.col("b") * 100, totals["b"])
    new = C.ratio(F.col("c") * 100, totals["c"])
    return counts.select("category", old.alias("baseline_pct"), new.alias("current_pct"),
                         (new - old).alias("drift_points"))


def psi(base: DataFrame, cur: DataFrame, col: str, bins: int = 10, epsilon: float = 1e-4) -> DataFrame:
    """Population Stability Index over the baseline's quantile bins.

    The ``bins - 1`` edges are the exact baseline values at ranks ``ceil(i * rows / bins)``. Both
    samples are read once, for one count per value.
    """
    counts = (base.select(col, F.lit(1).alias("b"), F.lit(0).alias("c"))
              .unionByName(cur.select(col, F.lit(0).alias("b"), F.lit(1).alias("c")))
              .filter(F.col(col).isNotNull()).groupBy(col)
              .agg(F.sum("b").alias("b"), F.sum("c").alias("c")))
    scan = ordered_scan(counts, [col], running={"upto": "b"})
    # An edge is below a value when its rank is among the baseline rows below that value.
    ranks = F.transform(F.sequence(F.lit(1), F.lit(bins - 1)),
                        lambda i: F.ceil(i * F.col("upto_total") / bins))
    below = F.size(F.filter(ranks, lambda r: r <= F.col("upto") - F.col("b")))
    histogram = scan.groupBy(below.alias("bin")).agg(F.sum("b").alias("b"), F.sum("c").alias("c"))
    totals = histogram.agg(F.struct(F.sum("b").alias("b"), F.sum("c").alias("c"))).scalar()
    p = F.greatest(C.ratio(F.col("b"), totals["b"]), F.lit(epsilon))
    q = F.greatest(C.ratio(F.col("c"), totals["c"]), F.lit(epsilon))
    return histogram.agg(F.lit(col).alias("column_name"),
                         F.round(F.sum((q - p) * F.log(q / p)), 6).alias("psi"))


def ks_statistics(base: DataFrame, cur: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov distance per numeric column and its 5 % limit.

    Both samples shrink to counts per distinct value; the cumulative counts come from one
    distributed scan over all columns.
    """
    def tall(df: DataFrame, b: int) -> DataFrame:
        wide = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
        return (wide.unpivot([], list(cols), "feature", "value")
                .filter(F.col("value").isNotNull())
                .select("feature", "value", F.lit(b).alias("b"), F.lit(1 - b).alias("c")))

    counts = (tall(base, 1).unionByName(tall(cur, 0)).groupBy("feature", "value")
              .agg(F.sum("b").alias("b"), F.sum("c").alias("c")))
    scan = ordered_scan(counts, ["value"], running={"b_upto": "b", "c_upto": "c"},
                        within=["feature"])
    n, m = F.col("b_upto_total"), F.col("c_upto_total")
    gap = F.abs(C.ratio(F.col("b_upto"), n) - C.ratio(F.col("c_upto"), m))
    limit = 1.36 * F.sqrt(F.try_divide((n + m).cast("double"), n.cast("double") * m))
    return (scan.groupBy("feature")
            .agg(F.round(F.max(gap), 6).alias("statistic"),
                 F.round(F.max(limit), 6).alias("threshold"))
            .withColumn("test", F.lit("ks")))


def chi_square_statistics(base: DataFrame, cur: DataFrame, cols: Mapping[str, float]) -> DataFrame:
    """Chi-square of the two-sample contingency table per column; ``cols`` maps each column to
    its critical value."""
    names = list(cols)

    def tall(df: DataFrame, b: int) -> DataFrame:
        wide = df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in names])
        return (wide.unpivot([], names, "feature", "category")
                .select("feature", "category", F.lit(b).alias("b"), F.lit(1 - b).alias("c")))

    counts = (tall(base, 1).unionByName(tall(cur, 0)).groupBy("feature", "category")
              .agg(F.sum("b").alias("b"), F.sum("c").alias("c")))
    per = counts.groupBy("feature").agg(F.sum("b").alias("nb"), F.sum("c").alias("nc"),
                                        (F.count("*") - 1).alias("degrees"))
    row = (F.col("b") + F.col("c")).cast("double")
    whole = F.col("nb") + F.col("nc")
    parts = [F.try_divide((F.col(o) - row * F.col(t) / whole) * (F.col(o) - row * F.col(t) / whole),
                          row * F.col(t) / whole) for o, t in (("b", "nb"), ("c", "nc"))]
    limit = reduce(lambda acc, kv: acc.when(F.col("feature") == kv[0], F.lit(float(kv[1]))),
                   cols.items(), F.when(F.lit(False), F.lit(0.0)))
    return (counts.join(per, "feature").groupBy("feature")
            .agg(F.round(F.sum(parts[0] + parts[1]), 4).alias("statistic"),
                 F.max("degrees").alias("degrees"))
            .select("feature", "statistic", "degrees", limit.alias("threshold"),
                    F.lit("chi_square").alias("test")))


def feature_drift(base: DataFrame, cur: DataFrame, numeric: Sequence[str],
                  categorical: Mapping[str, float]) -> DataFrame:
    """One row per feature: test, statistic, limit, drifted or not."""
    cols = ["feature", "test", "statistic", "threshold"]
    tests = ks_statistics(base, cur, numeric).select(*cols).unionByName(
        chi_square_statistics(base, cur, categorical).select(*cols))
    return tests.withColumn("drifted", F.col("statistic") > F.col("threshold"))


def drift_summary(drift: DataFrame, warn: float = 30, crit: float = 50) -> DataFrame:
    share = C.ratio(F.count_if(F.col("drifted")) * 100, F.count("*"))
    out = drift.agg(F.count("*").alias("features"), F.count_if(F.col("drifted")).alias("n_drifted"),
                    share.alias("drift_share"))
    return out.withColumn("status", drift_level(F.col("drift_share"), warn, crit))


def row_count_history(run_log: DataFrame) -> DataFrame:
    """Rows per layer and run, and minutes from the bronze end to the silver end of a run.

    ``run_log``: run_id, table_name, layer, row_count, finished_at.
    """
    def of(layer: str, value: str) -> Column:
        return F.max(F.when(F.col("layer") == layer, F.col(value)))

    wide = run_log.groupBy("table_name", "run_id").agg(
        of("bronze", "row_count").alias("bronze_rows"), of("silver", "row_count").alias("silver_rows"),
        of("bronze", "finished_at").alias("bronze_at"), of("silver", "finished_at").alias("silver_at"))
    return wide.select("table_name", "run_id", "bronze_rows", "silver_rows", F.round(
        F.timestamp_diff("SECOND", F.col("bronze_at"), F.col("silver_at")) / 60, 1)
        .alias("latency_minutes"))


def mttr(incidents: DataFrame, by: str = "severity") -> DataFrame:
    """Resolved and open incidents and the mean minutes to resolution.

    ``incidents``: opened_at, resolved_at (NULL while open) and the grouping column.
    """
    seconds = F.timestamp_diff("SECOND", F.col("opened_at"), F.col("resolved_at"))
    return incidents.groupBy(by).agg(
        F.count("resolved_at").alias("resolved"),
        F.count_if(F.col("resolved_at").isNull()).alias("open"),
        C.ratio(F.sum(seconds), F.count("resolved_at") * 60).alias("mttr_minutes"))
