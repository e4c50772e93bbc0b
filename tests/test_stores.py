"""Monitoring stores: repeated captures, as-of look-ups, spans against a rescan."""

import datetime as dt
import os

from pyspark.sql import functions as F

from storeloom.operators import contracts, observe, stores
from storeloom.operators import checks as K
from tests.conftest import rows


def _captured(spark, store, at, **tables):
    listing = None
    for name, schema in tables.items():
        part = K.describe_columns(spark.createDataFrame([], schema), name)
        listing = part if listing is None else listing.unionByName(part)
    found = rows(stores.capture_schema(spark, store, listing, "silver", at), "table_name", "column_name")
    return {(r["table_name"], r["column_name"]): (
        r["change_type"], r["severity"], r["previous_value"], r["current_value"]) for r in found}


def test_schema_history(spark, tmp_path):
    store = str(tmp_path / "schemas")
    first = _captured(spark, store, "2020-01-01 06:00:00", orders="id bigint, status string, total int", other="x int")
    assert {v[0] for v in first.values()} == {"ADDED"} and len(first) == 4
    # ``other`` is not captured the second time, and comes back unchanged.
    second = _captured(spark, store, "2020-01-02 06:00:00", orders="id bigint, total double, at date")
    assert second == {
        ("orders", "id"): ("UNCHANGED", "INFO", "bigint NULL", "bigint NULL"),
        ("orders", "status"): ("REMOVED", "CRITICAL", "string NULL", None),
        ("orders", "total"): ("MODIFIED", "WARNING", "int NULL", "double NULL"),
        ("orders", "at"): ("ADDED", "INFO", None, "date NULL")}
    third = _captured(spark, store, "2020-01-03 06:00:00", orders="id bigint, total double, at date, status string",
                      other="x int")
    assert third["orders", "status"][0] == "ADDED" and third["other", "x"][0] == "UNCHANGED"
    # The second capture again: the same rows, once.
    assert _captured(spark, store, "2020-01-02 06:00:00", orders="id bigint, total double, at date") == second
    log = stores.read_schema_log(spark, store)
    assert log.count() == 4 + 4 + 5 and log.filter("captured_at = timestamp_ntz'2020-01-02 06:00:00'").count() == 4
    then = rows(stores.schema_as_of(log, "2020-01-02 12:00:00"), "table_name", "column_name")
    assert [(r["table_name"], r["column_name"]) for r in then] == [
        ("orders", "at"), ("orders", "id"), ("orders", "total"), ("other", "x")]
    assert stores.schema_as_of(log, "2019-12-31").count() == 0
    assert {r["column_name"] for r in stores.schema_changes(log, "2020-01-03").collect()} == {"status"}


def _days(spark, n=400):
    return spark.range(n).select(
        F.timestamp_add("HOUR", (F.col("id") * 5).cast("int"), F.lit("2020-01-01").cast("timestamp_ntz")).alias("at"),
        ((F.col("id") * 37) % 101 / 4).cast("decimal(10,2)").alias("price"),
        F.when(F.col("id") % 7 != 0, (F.col("id") * 13) % 17).cast("int").alias("qty"))


def test_statistics_of_a_span_equal_a_rescan(spark, tmp_path):
    df, store = _days(spark), str(tmp_path / "counts")
    stores.save_value_counts(df, store, "sales", ["price", "qty"], "at")
    stores.save_value_counts(df.filter("at >= '2020-02-01'"), store, "sales", ["price", "qty"], "at")  # again
    stores.save_value_counts(df.limit(5), store, "else", ["qty"], "at")
    for start, end in (("2020-01-10", "2020-01-17"), ("2020-01-01", "2021-01-01"), ("2030-01-01", "2031-01-01")):
        got = stores.statistics_of_span(spark, store, "sales", start, end, "2020-03-01")
        part = df.filter((F.col("at") >= start) & (F.col("at") < end))
        want = observe.column_statistics(part, ["price", "qty"], "sales", "2020-03-01")
        plain = lambda f: [(r["column_name"], r["metric_name"], round(r["metric_value"], 4), r["row_count"])
                           for r in rows(f.filter("metric_value IS NOT NULL"), "column_name", "metric_name")]
        assert plain(got) == plain(want)


def test_drift_from_kept_captures(spark, tmp_path):
    log = str(tmp_path / "log")

    def capture(day, value):
        return spark.createDataFrame([(dt.datetime.fromisoformat(day), "t", "x", "mean", value, 9)],
                                     "captured_at timestamp_ntz, table_name string, column_name string, "
                                     "metric_name string, metric_value double, row_count bigint")

    for day, value in (("2020-01-01", 10.0), ("2020-01-03", 20.0), ("2020-01-09", 99.0), ("2020-01-11", 26.0),
                       ("2020-01-09", 24.0)):
        stores.save_statistics([capture(day, value)], log)
    kept = stores.read_statistics(spark, log)
    assert kept.count() == 4
    row = stores.stored_drift(kept, "2020-01-10 12:00:00").first()
    assert (row.baseline_value, row.current_value, row.status) == (20.0, 24.0, "OK")
    row = stores.stored_drift(kept, "2020-01-11").first()
    assert (row.baseline_value, row.current_value, row.status) == (20.0, 26.0, "WARNING")
    assert stores.stored_drift(kept, "2020-01-05").count() == 0


def test_results_are_read_from_the_runs_asked_for(spark, tmp_path):
    store = str(tmp_path / "results")
    df = spark.createDataFrame([(1,), (1,)], "x int")
    for run, at in (("r1", "2020-01-01"), ("r2", "2020-01-02"), ("r2", "2020-01-02")):
        contracts.run_checkpoint(df, [contracts.unique("x"), contracts.not_null("x")], "s", run, at, store)
    assert sorted(os.listdir(store))[-2:] == ["run_date=2020-01-01", "run_date=2020-01-02"]
    recent = contracts.read_store(spark, store, since="2020-01-02")
    assert [r["run_id"] for r in rows(contracts.success_trend(recent))] == ["r2"]
    assert recent.count() == 2 and rows(contracts.top_failures(recent))[0]["failures"] == 1
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run_date" in plan
