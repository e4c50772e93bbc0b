"""Round trips through files and tables."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from storeloom.operators.checks import CheckFailed, check_tables
from storeloom.operators.dedup import dedupe_keep_first
from storeloom.sources import readers, writers
from storeloom.sources.schemas import BRONZE
from storeloom.streaming.incremental import upsert_new_files
from tests.conftest import one, rows


def test_csv_with_quotes_and_line_breaks(spark, tmp_path):
    path = tmp_path / "reviews.csv"
    header = BRONZE["order_reviews"].replace(" NOT NULL", "").split(", ")
    path.write_text(",".join(h.split()[0] for h in header) + "\n"
                    'r1,o1,5,title,"two\nlines ""quoted"", comma",2020-01-01 00:00:00,\n'
                    "r2,o2,1,,ação,2020-01-02 00:00:00,2020-01-03 00:00:00\n")
    df = readers.read_bronze_csv(spark, str(path), BRONZE["order_reviews"], multi_line=True)
    a, b = rows(df, "review_id")
    assert a["review_comment_message"] == 'two\nlines "quoted", comma'
    assert a["review_answer_timestamp"] is None and b["review_comment_title"] is None
    assert b["review_creation_date"] == dt.datetime(2020, 1, 2)


def test_keep_first_in_file_order(spark, tmp_path):
    path = tmp_path / "sellers.csv"
    lines = [f"s{i % 50},{i:05d},city{i},SP" for i in range(500)]
    path.write_text("seller_id,seller_zip_code_prefix,seller_city,seller_state\n" + "\n".join(lines))
    spark.conf.set("spark.sql.files.maxPartitionBytes", 2000)
    try:
        df = readers.read_bronze_csv(spark, str(path), BRONZE["sellers"], file_order=True,
                                     columns=["seller_id", "seller_city"])
        assert df.rdd.getNumPartitions() > 1
        first = dedupe_keep_first(df, ["seller_id"], [readers.FILE_ORDER])
        assert {r["seller_id"]: r["seller_city"] for r in first.collect()} == {
            f"s{i}": f"city{i}" for i in range(50)}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_bronze_landing_and_audit(spark, tmp_path):
    df = writers.add_load_metadata(spark.range(3000), "x.csv", "2020-01-01 00:00:00")
    path = writers.write_bronze(df, str(tmp_path), "orders", "2020-01-01")
    back = spark.read.parquet(path)
    assert writers.assert_same_count(df, back) == 3000
    assert back.columns == ["id", "_loaded_at", "_source_file"]
    with pytest.raises(CheckFailed):
        writers.assert_same_count(df, back.limit(10))
    report = {r["table_name"]: r for r in rows(writers.audit_files(
        spark, str(tmp_path), {"orders": "bronze/orders/2020-01-01.parquet",
                               "none": "bronze/none/2020-01-01.parquet"}, min_mb=0.001))}
    assert (report["orders"]["status"], report["none"]["status"]) == ("OK", "MISSING")
    big = rows(writers.audit_files(spark, str(tmp_path), {"orders": "bronze/orders"}, min_mb=100.0))
    assert big[0]["status"] == "TOO_SMALL"


def test_full_refresh_is_idempotent(spark):
    for _ in range(2):
        writers.full_refresh(spark.range(10), "refresh_test")
    assert spark.table("refresh_test").count() == 10
    assert writers.materialize(spark.range(4), "refresh_test").count() == 4
    check_tables(spark, ["refresh_test"])
    with pytest.raises(CheckFailed):
        check_tables(spark, ["refresh_test", "absent_table"])
    spark.sql("DROP TABLE refresh_test")


def _dated(spark, n=200):
    return spark.range(n).select("id", F.timestamp_add(
        "DAY", F.col("id").cast("int"), F.lit("2020-01-15").cast("timestamp")).alias("processed_at"))


def test_partitioned_export(spark, tmp_path):
    df, path = _dated(spark), str(tmp_path / "silver")
    assert writers.export_partitioned(df, path) == "success"
    assert sorted(os.listdir(f"{path}/year=2020"))[:2] == ["month=01", "month=02"]
    files = [f for f in os.listdir(f"{path}/year=2020/month=02") if f.endswith(".parquet")]
    assert len(files) == 1 and ".snappy." in files[0]
    assert spark.read.parquet(f"{path}/year=2020/month=02/{files[0]}").columns == ["id", "processed_at"]
    back = readers.read_partitioned(spark, path)
    assert rows(back, "id") == rows(df, "id")
    manifest = writers.export_manifest(df, "processed_at", "t")
    assert {r["partition"]: r["records"] for r in rows(manifest)}["t/year=2020/month=02"] == 29
    assert one(writers.export_summary([manifest])) == {
        "table_name": "t", "records": 200, "partitions": 8}


def test_empty_table_is_skipped(spark, tmp_path):
    path = str(tmp_path / "empty")
    assert writers.export_partitioned(_dated(spark, 0), path) == "skipped"
    assert not os.path.exists(path)


def test_incremental_merge_keeps_the_newest(spark):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 1), (4, "z", 9), (5, "m", 3)], "k int, v string, at int")
    updates = spark.createDataFrame([(2, "c", 2), (2, "d", 3), (3, "e", 1), (4, "late", 2), (5, "n", 3), (5, "k", 3)],
                                    "k int, v string, at int")
    out = writers.incremental_merge(target, updates, ["k"], "at", ["v"])
    assert [(r["k"], r["v"]) for r in rows(out, "k")] == [(1, "a"), (2, "d"), (3, "e"), (4, "z"), (5, "n")]


def _batch(spark, *data):
    return spark.createDataFrame(list(data), "k int, v string, at int")


SALE = "k int, v string, sold timestamp_ntz, at int"


def _sales(spark, *data):
    return spark.createDataFrame([(k, v, dt.datetime.fromisoformat(d) if d else None, at)
                                  for k, v, d, at in data], SALE)


def _held(spark, path):
    held = writers.read_months(spark, path, _sales(spark).schema)
    return [(r["k"], r["v"], r["month"]) for r in rows(held, "k")]


def _files(path):
    return {d: {(f, os.stat(f"{path}/{d}/{f}").st_mtime_ns) for f in os.listdir(f"{path}/{d}")}
            for d in os.listdir(path) if d.startswith("month=")}


def _seed(spark, path):
    return writers.upsert_months(spark, path, _sales(spark, *[
        (k, "a", f"2020-{1 + k % 4:02d}-05", 1) for k in range(40)], (99, "a", None, 1)), ["k"], "sold", "at")


def test_a_batch_rewrites_its_months_only(spark, tmp_path):
    path = str(tmp_path / "table")
    assert _held(spark, path) == []
    assert _seed(spark, path) == ["2020-01", "2020-02", "2020-03", "2020-04", "none"]
    before = _files(path)
    assert writers.upsert_months(spark, path, _sales(spark, (2, "b", "2020-03-05", 2), (40, "n", "2020-03-31", 1)),
                                 ["k"], "sold", "at") == ["2020-03"]
    after = _files(path)
    assert {d for d in after if after[d] != before[d]} == {"month=2020-03"}
    held = dict((k, v) for k, v, _ in _held(spark, path))
    assert len(held) == 42 and held[2] == "b" and held[6] == "a" and held[99] == "a"
    assert writers.upsert_months(spark, path, _sales(spark), ["k"], "sold", "at") == []


def test_repeated_late_and_tied_batches(spark, tmp_path):
    path = str(tmp_path / "table")
    _seed(spark, path)
    upsert = lambda *data: writers.upsert_months(spark, path, _sales(spark, *data), ["k"], "sold", "at")
    batches = [[(2, "b", "2020-03-05", 3)], [(2, "late", "2020-03-05", 2), (99, "z", None, 2)],
               [(2, "b", "2020-03-05", 3)], [(3, "A", "2020-04-05", 1), (7, "t", "2020-04-05", 1)]]
    for batch in batches:
        upsert(*batch)
    held = dict((k, v) for k, v, _ in _held(spark, path))
    # Of two states of one instant the larger stays, whichever came first.
    assert (held[2], held[99], held[3], held[7]) == ("b", "z", "a", "t") and len(held) == 41


def test_a_key_may_move_to_another_month(spark, tmp_path):
    path = str(tmp_path / "table")
    writers.upsert_months(spark, path, _sales(spark, (1, "a", "2020-01-05", 1), (2, "a", "2020-02-05", 1),
                                              (3, "a", "2020-02-06", 1)), ["k"], "sold", "at")
    move = lambda *data: writers.upsert_months(spark, path, _sales(spark, *data), ["k"], "sold", "at", moves=True)
    assert move((1, "b", "2020-02-01", 2)) == ["2020-01", "2020-02"]
    assert _held(spark, path) == [(1, "b", "2020-02"), (2, "a", "2020-02"), (3, "a", "2020-02")]
    assert not os.path.exists(f"{path}/month=2020-01")
    move((1, "late", "2020-01-05", 1), (3, "c", "2020-03-01", 2))
    assert _held(spark, path) == [(1, "b", "2020-02"), (2, "a", "2020-02"), (3, "c", "2020-03")]


def test_new_files_are_merged_batch_by_batch(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    _seed(spark, target)

    def run(state):
        query = upsert_new_files(spark, source, SALE, target, ["k"], "sold", "at", str(tmp_path / state),
                                 files_per_batch=1)
        query.awaitTermination(120)
        return sum(1 for p in query.recentProgress if p.numInputRows)

    arrivals = [[(2, "x", "2020-03-05", 2), (41, "n", "2020-05-01", 1)], [(2, "late", "2020-03-05", 1)],
                [(41, "m", "2020-05-01", 2)]]
    for state, data in zip("aab", arrivals, strict=True):
        _sales(spark, *data).coalesce(1).write.mode("append").parquet(source)
        before = _files(target)
        assert run(state) == (1 if state == "a" else 3)
        assert _files(target)["month=2020-01"] == before["month=2020-01"]
    held = dict((k, v) for k, v, _ in _held(spark, target))
    assert len(held) == 42 and (held[2], held[41], held[1]) == ("x", "m", "a")


def test_materialize_swaps(spark):
    writers.materialize(_batch(spark, (1, "a", 1)), "swap_test")
    writers.materialize(spark.table("swap_test").union(_batch(spark, (2, "b", 1))), "swap_test")
    assert spark.table("swap_test").count() == 2
    with pytest.raises(Exception):
        writers.materialize(spark.table("swap_test").selectExpr("raise_error('no') AS k"), "swap_test")
    assert spark.table("swap_test").count() == 2


def test_counted_write_and_skip_record(spark, tmp_path):
    df = _batch(spark, (1, "a", 1), (2, "b", 1))
    assert writers.assert_same_count(writers.write_counted(df, str(tmp_path / "t")), df) == 2
    record = writers.skipped_export(spark, "orders").first()
    assert (record.table_name, record.status, record.records, record.partitions) == ("orders", "skipped", 0, 0)


def test_previews_and_sorted_writes(spark):
    df = _batch(spark, (3, "c", 1), (1, "a", 1), (2, "b", 1))
    assert readers.preview(df, 2).count() == 2 and readers.sample_rows(df, 5).count() == 3


def test_sorted_writes_cluster_each_file(spark, tmp_path):
    from storeloom.operators.clean import sort_for_write

    df = spark.range(1000).selectExpr("(id * 37) % 1000 AS k").repartition(2)
    sort_for_write(df, ["k"]).write.parquet(str(tmp_path / "sorted"))
    for name in (tmp_path / "sorted").glob("*.parquet"):
        found = [r.k for r in spark.read.parquet(str(name)).collect()]
        assert found == sorted(found)
