"""Loads of files with bad dates, bad numbers and broken records; clustered tables."""

import contextlib
import datetime as dt
import io
import os

from storeloom.operators import checks as K
from storeloom.plans import gold as G
from storeloom.plans.silver import silver, without_audit
from storeloom.sources import loading, writers
from storeloom.sources.retail import bronze
from storeloom.sources.schemas import BRONZE
from tests.conftest import SMALL, one, rows

HEADER = ",".join(f.split()[0] for f in BRONZE["orders"].split(", "))


def _load(spark, folder, body, table="orders", **options):
    path = folder / f"{table}.csv"
    header = ",".join(f.split()[0] for f in BRONZE[table].split(", "))
    path.write_text(header + "\n" + body)
    report = loading.load_csv(spark, str(path), BRONZE[table], table, str(folder / "out"), str(folder / "bad"), **options)
    return report, spark.read.parquet(str(folder / "out"))


def test_bad_dates_become_null_and_are_counted(spark, tmp_path):
    report, out = _load(spark, tmp_path, "\n".join([
        "o1,c1,delivered,2020-01-01 10:00:00,2020-01-02,,2020-01-09 01:02:03,2020-02-30 00:00:00",
        "o2,c2,shipped,not a date,2020-13-01,,,soon",
        "o3,c3,shipped,2020-01-03 00:00:00,,,, 2020-01-20 ",
        "too,few,fields",
        "o4,c4,shipped,2020-01-04 00:00:00,,,,2020-01-20,one too many"]) + "\n")
    assert report == loading.LoadReport("orders", 3, 2, {
        "order_purchase_timestamp": 1, "order_approved_at": 1, "order_estimated_delivery_date": 2})
    a, b, c = rows(out, "order_id")
    assert a["order_purchase_timestamp"] == dt.datetime(2020, 1, 1, 10) and a["order_estimated_delivery_date"] is None
    assert b["order_purchase_timestamp"] is None and b["order_delivered_customer_date"] is None
    assert c["order_estimated_delivery_date"] == dt.datetime(2020, 1, 20)
    assert [f.dataType.typeName() for f in out.schema][3:] == ["timestamp_ntz"] * 5
    assert sorted(r.record for r in spark.read.parquet(str(tmp_path / "bad")).collect()) == [
        "o4,c4,shipped,2020-01-04 00:00:00,,,,2020-01-20,one too many", "too,few,fields"]


def test_numbers_quotes_and_line_breaks(spark, tmp_path):
    report, out = _load(spark, tmp_path, 'r1,o1,5,t,"two\nlines, ""quoted""",2020-01-01,\nr2,o2,five,,x,2020-01-01,never\n',
                        "order_reviews", multi_line=True)
    assert (report.rows, report.rejected, report.coerced) == (2, 0, {"review_score": 1, "review_answer_timestamp": 1})
    a, b = rows(out, "review_id")
    assert a["review_comment_message"] == 'two\nlines, "quoted"' and a["review_score"] == 5 and b["review_score"] is None
    assert not os.path.exists(tmp_path / "bad")


def test_text_only_and_empty_files(spark, tmp_path):
    report, out = _load(spark, tmp_path, "", "sellers")
    assert (report.rows, report.rejected, report.coerced, out.count()) == (0, 0, {}, 0)
    (tmp_path / "two").mkdir()
    report, out = _load(spark, tmp_path / "two", "s1,01234,x,SP\n", "sellers")
    assert report.rows == 1 and one(out)["seller_zip_code_prefix"] == "01234"


def test_counts_reach_the_run_record(spark, tmp_path):
    report, out = _load(spark, tmp_path, "o1,c1,delivered,2020-01-01,x,y,,\nbroken\n")
    clean = silver({"orders": out}, "2020-02-01 00:00:00")["orders"]
    record = one(K.run_result("orders", K.volumetry(out, clean), K.key_integrity(clean, ["order_id"]),
                              loading.load_reports(spark, [report])))
    assert (record["status"], record["rejected"], record["coerced_cells"]) == ("success", 1, 2)


def test_clustered_tables_meet_without_an_exchange(spark):
    tables = bronze(spark, SMALL, "orders", "order_items", "order_reviews", "order_payments")
    plain = {n: without_audit(df) for n, df in silver(tables, "2020-01-01 00:00:00", keyed=True).items()}
    names = {n: f"clustered_{n}" for n in plain}
    held = {n: writers.save_clustered(df, names[n], ["order_id"], 4) for n, df in plain.items()}
    metrics = G.order_metrics(held["orders"], held["order_items"], held["order_reviews"], held["order_payments"])
    text = io.StringIO()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        with contextlib.redirect_stdout(text):
            metrics.explain("formatted")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in text.getvalue() and "SelectedBucketsCount: 4 out of 4" in text.getvalue()
    want = G.order_metrics(*(plain[n] for n in ("orders", "order_items", "order_reviews", "order_payments")))
    assert rows(metrics, "order_id") == rows(want, "order_id")
    for n in names.values():
        spark.sql(f"DROP TABLE {n}")
