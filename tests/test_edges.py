"""Hand-made rows for the rules that the generated tables cannot show."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from storeloom.functions import columns as C
from storeloom.operators import aggregates as A
from storeloom.operators import checks as K
from storeloom.operators import clean, contracts, dedup, joins, observe
from storeloom.plans import gold as G
from storeloom.plans import metrics as M
from storeloom.plans import silver as S
from storeloom.sources.schemas import BRAZIL_REGIONS
from tests.conftest import one, rows

NOW = "2020-01-01 00:00:00"


def ts(text):
    return dt.datetime.fromisoformat(text)


# --- functions ------------------------------------------------------------------------------

def test_elapsed_days_cut_toward_zero(spark):
    df = spark.createDataFrame(
        [(ts("2020-01-03 05:00:00"), ts("2020-01-01 06:00:00")),
         (ts("2020-01-01 06:00:00"), ts("2020-01-03 07:00:00"))],
        "a timestamp_ntz, b timestamp_ntz")
    assert [r[0] for r in df.select(C.elapsed_days("a", "b")).collect()] == [1, -2]


def test_delay_days_and_classes(spark):
    due = ts("2020-01-10 00:00:00")
    cases = {None: (0, "ON_TIME"), due: (0, "ON_TIME"), due + dt.timedelta(hours=5): (0, "ON_TIME"),
             due + dt.timedelta(days=3): (3, "1-3d"), due + dt.timedelta(days=4): (4, "4-7d"),
             due + dt.timedelta(days=15): (15, "8-15d"), due + dt.timedelta(days=16): (16, ">15d")}
    for done, want in cases.items():
        df = spark.createDataFrame([(done, due)], "done timestamp_ntz, due timestamp_ntz")
        days = C.delay_days("done", "due")
        assert tuple(df.select(days, C.delay_class(days)).first()) == want


def test_unparseable_dates(spark):
    df = spark.createDataFrame([("2020-02-30",), ("2020-02-28 10:00:00",), (None,)], "d string")
    assert [r[0] for r in df.select(C.parse_timestamp("d")).collect()] == [
        None, ts("2020-02-28 10:00:00"), None]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        df.select(C.strict_timestamp("d")).collect()


def test_same_point_distance_is_zero(spark):
    km = C.great_circle_km(F.lit(-23.5456), F.lit(-46.6393), F.lit(-23.5456), F.lit(-46.6393))
    assert spark.range(1).select(F.round(km, 3)).first()[0] == 0
    far = C.great_circle_km(F.lit(-23.5505), F.lit(-46.6333), F.lit(-22.9068), F.lit(-43.1729))
    assert 355 < spark.range(1).select(far).first()[0] < 365


def test_nps_of_the_published_distribution(spark):
    scores = [(5, 578), (4, 193), (3, 83), (2, 32), (1, 113)]
    df = spark.createDataFrame([(s,) for s, n in scores for _ in range(n)], "review_score int")
    assert one(A.nps(df))["nps"] == pytest.approx(43.3, abs=0.1)
    assert one(A.nps(df.limit(0))) == {"answers": 0, "nps": None}


def test_regions_cover_27_states():
    assert len({s for states in BRAZIL_REGIONS.values() for s in states}) == 27


# --- silver flags ---------------------------------------------------------------------------

def test_product_flags_on_null_zero_and_negative(spark):
    bronze = spark.createDataFrame(
        [("a", None, None, None, None, None, 1, 2, None), ("b", "x", 3, 4, 0, 5, 1, 2, 3),
         ("c", "x", 3, 4, -1, 5, 1, 2, 3), ("d", "x", 3, 4, 2, 5, 2000, 2000, 2000)],
        "product_id string, product_category_name string, product_name_lenght int, "
        "product_description_lenght int, product_photos_qty int, product_weight_g int, "
        "product_length_cm int, product_height_cm int, product_width_cm int")
    out = {r["product_id"]: r for r in rows(S.silver_products(bronze, NOW))}
    assert out["a"]["has_photos"] is None and out["a"]["product_photos_qty"] == 0
    assert out["a"]["has_category"] is False and out["a"]["has_dimensions"] is False
    assert out["a"]["product_volume_cm3"] is None
    assert out["b"]["has_photos"] is False and out["c"]["has_photos"] is False
    assert out["d"]["has_photos"] is True and out["d"]["product_volume_cm3"] == 8_000_000_000
    assert len(S.silver_products(bronze, NOW).columns) == 17


def test_item_flags_are_three_valued(spark):
    items = spark.createDataFrame(
        [(1, 1, 1, 1, None, Decimal("1.00"), None), (1, 2, 1, 1, Decimal("0.00"), Decimal("-1.00"),
                                                     ts(NOW))],
        "order_id int, order_item_id int, product_id int, seller_id int, price decimal(10,2), "
        "freight_value decimal(10,2), shipping_limit_date timestamp_ntz")
    out = rows(S.silver_order_items(items, NOW), "order_item_id")
    assert (out[0]["has_price"], out[0]["has_freight"], out[0]["item_total_value"]) == (None, True, None)
    assert (out[1]["has_price"], out[1]["has_freight"]) == (False, False)
    assert (out[0]["has_shipping_limit"], out[1]["has_shipping_limit"]) == (False, True)
    assert len(out[0]) == 14


def test_payment_flags(spark):
    pay = spark.createDataFrame(
        [(1, 1, " Credit_Card ", None, None), (1, 2, None, 1, Decimal("0.00"))],
        "order_id int, payment_sequential int, payment_type string, payment_installments int, "
        "payment_value decimal(10,2)")
    a, b = rows(S.silver_order_payments(pay, NOW), "payment_sequential")
    assert (a["is_credit_card"], a["is_boleto"], a["is_installment"], a["has_value"]) == (
        True, False, None, None)
    assert (b["is_credit_card"], b["is_boleto"], b["is_installment"], b["has_value"]) == (
        False, False, False, False)
    assert len(a) == 12


def test_review_comments(spark):
    texts = [None, "", "   ", "  padded ", "ação", 'two\nlines "quoted"']
    reviews = spark.createDataFrame(
        [(i, i, None if i == 0 else i, t, t, ts(NOW), None) for i, t in enumerate(texts)],
        "review_id int, order_id int, review_score int, review_comment_title string, "
        "review_comment_message string, review_creation_date timestamp_ntz, "
        "review_answer_timestamp timestamp_ntz")
    out = rows(S.silver_order_reviews(reviews, NOW), "review_id")
    assert [r["comment_length"] for r in out] == [0, 0, 0, 6, 4, 18]
    assert [r["has_comment_message"] for r in out] == [False] + [True] * 5
    assert (out[0]["is_positive_score"], out[0]["is_negative_score"]) == (None, None)
    assert out[3]["review_comment_message"] == "padded" and len(out[0]) == 16


def test_distinct_is_not_one_row_per_key(spark):
    """DISTINCT keeps payload variants of a key; the key check reports them."""
    orders = spark.createDataFrame(
        [(1, 1, "SHIPPED"), (1, 1, " shipped "), (1, 1, "created")],
        "order_id int, customer_id int, order_status string").withColumns(
        {c: F.lit(ts(NOW)) for c in ["order_purchase_timestamp", "order_approved_at",
                                     "order_delivered_carrier_date",
                                     "order_delivered_customer_date",
                                     "order_estimated_delivery_date"]})
    out = S.silver_orders(orders, NOW)
    assert out.count() == 2 and len(out.columns) == 14
    assert one(K.key_integrity(out, ["order_id"]))["pk_integrity"] == "ERROR"


def test_bounding_box_limits(spark):
    points = [(-33.0, -74.0), (5.0, -34.0), (-33.1, -50.0), (0.0, -33.9), (None, -50.0), (0.0, None)]
    df = spark.createDataFrame(points, "lat double, lng double")
    assert [r["f"] for r in rows(clean.bbox_flag(df, "f", "lat", "lng"))] == [
        True, True, False, False, False, False]
    assert clean.bbox_filter(df, "lat", "lng").count() == 2


# --- geolocation ----------------------------------------------------------------------------

GEO = ("geolocation_zip_code_prefix string, geolocation_lat double, geolocation_lng double, "
       "geolocation_city string, geolocation_state string")


def test_most_frequent_coordinate_wins_and_ties_take_the_smallest(spark):
    geo = spark.createDataFrame(
        [("1", -10.0, -50.0, "a", "x")] + [("1", -9.0, -50.0, "a", "x")] * 2
        + [("2", -8.0000001, -50.0, "a", "x"), ("2", -8.0, -50.0, "b", "x"),
           ("2", -9.0, -51.0, "c", "x"), ("2", -9.0, -51.0, "d", "x")], GEO)
    out = rows(dedup.geo_consolidate(geo), "geolocation_zip_code_prefix")
    assert [(r["geolocation_lat"], r["geolocation_city"]) for r in out] == [(-9.0, "a"), (-9.0, "c")]


def test_original_count_includes_invalid_readings(spark):
    geo = spark.createDataFrame(
        [("1", -10.0, -50.0, " b ", "sp"), ("1", -11.0, -50.0, "a", "sp"),
         ("1", 50.0, -50.0, "a", "sp"), ("2", 60.0, 0.0, "a", "sp")], GEO)
    (r,) = rows(S.silver_geolocation(geo, NOW))
    assert (float(r["geolocation_lat"]), r["original_count"], r["geolocation_state"]) == (-11.0, 3, "SP")


def test_missing_coordinates_become_zero(spark):
    geo = spark.createDataFrame([("1", None, -50.0, "a", "x"), ("2", 1.0, 2.0, "a", "x")], GEO)
    df = spark.createDataFrame([("1",), ("2",), ("3",), (None,)], "zip string")
    out = rows(joins.enrich_geolocation(df, "zip", geo), "zip")
    assert [(r["geolocation_lat"], r["has_geolocation"]) for r in out] == [
        (0.0, False), (1.0, True), (0.0, False), (0.0, False)]


# --- keys, checks ---------------------------------------------------------------------------

def test_keep_first_by_known_order(spark):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 1), (2, "c", 3), (None, "d", 4), (None, "e", 5)],
                               "k int, v string, o int")
    assert sorted(r["v"] for r in rows(dedup.dedupe_keep_first(df, ["k"], ["o"]))) == ["a", "c", "d"]
    assert sorted(r["v"] for r in rows(dedup.dedupe_keep_first(df, ["k"], [F.desc("o")]))) == [
        "b", "c", "e"]
    assert one(dedup.duplicate_count(df, ["k"])) == {
        "total_records": 5, "unique_keys": 3, "duplicates": 2}


def test_orphans_with_and_without_null_keys(spark):
    child = spark.createDataFrame([(1,), (1,), (9,), (9,), (None,)], "fk int")
    parent = spark.createDataFrame([(1,), (2,), (None,)], "pk int")
    assert one(joins.fk_orphans(child, parent, "fk", "pk"))["orphans"] == 3
    assert one(joins.fk_orphans(child, parent, "fk", "pk", ignore_null=True))["orphans"] == 2
    report = joins.fk_report({"c": child, "p": parent}, [("c", "fk", "p", "pk")])
    with pytest.raises(K.CheckFailed, match="FAIL"):
        K.require_ok(report, "status")


def test_composite_keys_count_null_parts(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, 2)], "a int, b int")
    assert one(A.composite_distinct(df, ["a", "b"]))["unique_keys"] == 2
    assert one(K.key_integrity(df, ["a", "b"])) == {
        "total_records": 3, "unique_pks": 2, "null_a": 0, "null_b": 2, "pk_integrity": "ERROR"}
    with pytest.raises(K.CheckFailed):
        K.check_unique(df, ["a", "b"])
    assert K.check_unique(df, ["a", "b"], level="warn")["pk_integrity"] == "ERROR"


def test_gates_raise(spark):
    df = spark.createDataFrame([(1, 6), (None, 3)], "k int, score int")
    assert K.check_columns(df, ["k"]) == ["score"]
    with pytest.raises(K.CheckFailed, match="missing"):
        K.check_columns(df, ["k", "other"])
    with pytest.raises(K.CheckFailed, match="'null_k': 1"):
        K.check_not_null(df, ["k", "score"])
    with pytest.raises(K.CheckFailed, match="outside"):
        K.check_between(df, "score", 1, 5)
    K.check_between(df.filter("score < 6"), "score", 1, 5)


@pytest.mark.parametrize("bronze,silver,status", [
    (100, 100, "OK"), (100, 99, "WARNING"), (1000, 989, "ERROR"), (100, 101, "WARNING")])
def test_volumetry_levels(spark, bronze, silver, status):
    assert one(K.volumetry(spark.range(bronze), spark.range(silver)))["volumetry_status"] == status


def test_volumetry_of_empty_bronze(spark):
    r = one(K.volumetry(spark.range(0), spark.range(0)))
    assert r["completeness_pct"] is None and r["volumetry_status"] == "OK"


@pytest.mark.parametrize("actual,status", [
    (1009, "OK"), (1010, "WARNING"), (1050, "WARNING"), (1051, "ERROR"), (949, "ERROR"), (991, "OK")])
def test_row_count_tolerance(spark, actual, status):
    assert one(K.check_row_counts({"t": spark.range(actual)}, {"t": 1000}))["status"] == status


def test_sequence_gaps(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 1), (2, 3), (3, 2)], "g int, s int")
    assert one(K.check_sequence(df, "g", "s")) == {"groups": 3, "not_from_one": 1, "with_gap": 1}


def test_case_check_reads_every_row(spark):
    df = spark.createDataFrame([("ok",), ("BAD",), ("Mixed",), ("12",), (None,)], "s string")
    assert one(K.case_check(df, "s", "lower"))["wrong_case"] == 1
    assert one(K.case_check(df, "s", "upper"))["wrong_case"] == 1


def test_schema_reports(spark):
    df = spark.createDataFrame([(1, "a")], "seller_id int, seller_city string")
    (r,) = rows(K.schema_report({"sellers": df}, {"sellers": ["seller_id", "seller_state"]}))
    assert (r["status"], r["missing"], r["actual_cols"]) == ("FAIL", "seller_state", 2)
    listing = rows(K.describe_columns(df, "sellers"), "ordinal_position")
    assert [(c["column_name"], c["data_type"]) for c in listing] == [
        ("seller_id", "int"), ("seller_city", "string")]


# --- contracts ------------------------------------------------------------------------------

def _run(df, *suite):
    return rows(contracts.run_suite(df, suite), "position")


def test_mostly_met_and_missed(spark):
    df = spark.range(100).select(F.col("id").cast("int").alias("x"))
    met, missed = _run(df, contracts.between("x", 0, 98, 0.99), contracts.between("x", 0, 97, 0.99))
    assert (met["unexpected"], met["success"]) == (1, True)
    assert (missed["unexpected"], missed["success"]) == (2, False)


def test_nulls_and_empty_tables(spark):
    rules = [contracts.not_null("x"), contracts.unique("x"), contracts.in_set("x", [1]),
             contracts.between("x", 0, 1), contracts.length_equals("s", 2),
             contracts.row_count_between(0, 0)]
    nulls = spark.createDataFrame([(None, None)] * 3, "x int, s string")
    assert [r["success"] for r in _run(nulls, *rules)] == [False, True, True, True, True, False]
    assert [r["success"] for r in _run(nulls.limit(0), *rules)] == [True] * 6


def test_every_row_of_a_repeated_value_is_unexpected(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "x int")
    (r,) = _run(df, contracts.unique("x"))
    assert (r["evaluated"], r["unexpected"], r["success"]) == (3, 2, False)


def test_missing_columns_fail_their_rules(spark):
    df = spark.createDataFrame([(1,)], "x int")
    out = _run(df, contracts.column_to_exist("y"), contracts.not_null("y"), contracts.unique("y"),
               contracts.column_count_equals(1))
    assert [r["success"] for r in out] == [False, False, False, True]


def test_suite_sizes():
    assert [len(s) for s in contracts.BRONZE_SUITES.values()] == [11, 10, 10]
    assert [len(s) for s in contracts.SILVER_SUITES.values()] == [12, 11, 11, 13]


def test_checkpoint_store_counts_a_repeated_run_once(spark, tmp_path):
    store = str(tmp_path / "store")
    df = spark.createDataFrame([(1,), (1,)], "x int")
    suite = [contracts.unique("x"), contracts.not_null("x")]
    for run, at in (("r1", "2020-01-01"), ("r2", "2020-01-02"), ("r2", "2020-01-02")):
        contracts.run_checkpoint(df, suite, "s", run, at, store)
    kept = contracts.read_store(spark, store)
    assert kept.count() == 4
    assert [(r["run_id"], r["success_percent"]) for r in rows(contracts.success_trend(kept))] == [
        ("r1", 50.0), ("r2", 50.0)]
    assert rows(contracts.top_failures(kept))[0]["failures"] == 2


# --- observability --------------------------------------------------------------------------

def test_schema_diff(spark):
    cols = "table_name string, column_name string, data_type string, is_nullable boolean"
    before = spark.createDataFrame([("t", "a", "int", True), ("t", "b", "int", True),
                                    ("t", "c", "int", True)], cols)
    after = spark.createDataFrame([("t", "a", "int", True), ("t", "b", "string", True),
                                   ("t", "d", "int", False)], cols)
    out = rows(observe.schema_diff(before, after), "column_name")
    assert [(r["change_type"], r["severity"]) for r in out] == [
        ("UNCHANGED", "INFO"), ("MODIFIED", "WARNING"), ("REMOVED", "CRITICAL"), ("ADDED", "INFO")]


def test_drift_of_a_zero_baseline(spark):
    cols = "table_name string, column_name string, metric_name string, metric_value double"
    base = spark.createDataFrame([("t", "a", "mean", 0.0), ("t", "b", "mean", 10.0),
                                  ("t", "c", "mean", 10.0)], cols)
    cur = spark.createDataFrame([("t", "a", "mean", 5.0), ("t", "b", "mean", 12.1),
                                 ("t", "c", "mean", 4.9)], cols)
    out = rows(observe.statistic_drift(base, cur), "column_name")
    assert [r["status"] for r in out] == [None, "WARNING", "CRITICAL"]


def test_freshness_levels(spark):
    tables = [("Silver", name, spark.createDataFrame([(ts(at),)], "t timestamp_ntz"), "t")
              for name, at in [("a", "2020-01-01 11:30:00"), ("b", "2020-01-01 11:00:00"),
                               ("c", "2019-12-31 12:00:00"), ("d", "2019-12-31 11:59:00")]]
    report = observe.freshness(tables, "2020-01-01 12:00:00")
    assert [r["status"] for r in rows(report, "table_name")] == ["GREEN", "YELLOW", "RED", "RED"]
    assert [r["table_name"] for r in rows(observe.stale_tables(report))] == ["d"]


# --- gold -----------------------------------------------------------------------------------

def test_children_do_not_multiply(spark):
    day = ts("2020-01-01 00:00:00")
    orders = spark.createDataFrame(
        [(1, 1, "delivered", day, day, day, day + dt.timedelta(days=4), day + dt.timedelta(days=2))],
        "order_id int, customer_id int, order_status string, order_purchase_timestamp timestamp_ntz, "
        "order_approved_at timestamp_ntz, order_delivered_carrier_date timestamp_ntz, "
        "order_delivered_customer_date timestamp_ntz, order_estimated_delivery_date timestamp_ntz")
    items = spark.createDataFrame(
        [(1, i, i, 1, Decimal("10.00"), Decimal("1.00")) for i in (1, 2, 3)],
        "order_id int, order_item_id int, product_id int, seller_id int, price decimal(10,2), "
        "freight_value decimal(10,2)")
    reviews = spark.createDataFrame(
        [(1, 1, 5, None, day), (2, 1, 1, "bad", day + dt.timedelta(days=1))],
        "review_id int, order_id int, review_score int, review_comment_message string, "
        "review_creation_date timestamp_ntz")
    payments = spark.createDataFrame(
        [(1, 1, "voucher", 1, Decimal("3.00")), (1, 2, "boleto", 2, Decimal("30.00"))],
        "order_id int, payment_sequential int, payment_type string, payment_installments int, "
        "payment_value decimal(10,2)")
    r = one(G.order_metrics(orders, items, reviews, payments))
    assert (r["total_order_value"], r["total_items"], r["total_payment_value"]) == (
        Decimal("33.00"), 3, Decimal("33.00"))
    assert (r["review_score"], r["has_review_comment"], r["payment_types"]) == (1, True, "boleto, voucher")
    assert (r["delay_days"], r["is_late"], r["delay_category"]) == (2, True, "1-3d")


def test_payment_text_repeats_types(spark):
    pay = spark.createDataFrame(
        [(1, "voucher", Decimal("1.00")), (1, "boleto", Decimal("1.00")), (1, "voucher", Decimal("1.00")),
         (2, "boleto", Decimal("1.00"))], "order_id int, payment_type string, payment_value decimal(10,2)")
    (r,) = rows(A.payment_types_per_order(pay, min_payments=2))
    assert (r["payment_types"], r["num_payments"]) == ("boleto, voucher, voucher", 3)
    assert rows(A.payment_types_per_order(pay, distinct=True), "order_id")[0][
        "payment_types"] == "boleto, voucher"


def test_cohort_with_a_gap_of_13_months(spark):
    orders = spark.createDataFrame(
        [("a", ts("2020-01-05 00:00:00")), ("a", ts("2021-02-05 00:00:00")),
         ("b", ts("2020-01-31 23:59:59"))],
        "customer_unique_id string, order_purchase_timestamp timestamp_ntz")
    out = rows(M.cohort_retention(orders), "month_number")
    assert [(r["month_number"], r["customers"], r["retention_rate"]) for r in out] == [
        (0, 2, 1.0), (13, 1, 0.5)]
    assert one(M.cohort_matrix(orders))["month_1"] == 0


def test_scd2(spark):
    def people(*data):
        return spark.createDataFrame(list(data), "id int, city string")

    def state(df):
        return sorted((r["id"], r["city"], str(r["effective_from"]), str(r["effective_to"]),
                       r["is_current"]) for r in rows(df))

    first = G.scd2_start(people((1, "a"), (2, "b"), (3, "c"), (5, None)), "id", ["city"], "2020-01-01")
    batch = people((1, "a"), (2, "x"), (4, "d"), (5, None))
    second = G.scd2_merge(first, batch, "id", ["city"], "2020-02-01")
    want = [(1, "a", "2020-01-01", "None", True), (2, "b", "2020-01-01", "2020-02-01", False),
            (2, "x", "2020-02-01", "None", True), (3, "c", "2020-01-01", "2020-02-01", False),
            (4, "d", "2020-02-01", "None", True), (5, None, "2020-01-01", "None", True)]
    assert state(second) == sorted(want, key=str) or sorted(state(second), key=str) == sorted(want, key=str)
    again = G.scd2_merge(second, batch, "id", ["city"], "2020-03-01")
    assert sorted(state(again), key=str) == sorted(want, key=str)


def test_rfm_segment_codes(spark):
    codes = {c for codes in M.SEGMENTS.values() for c in codes}
    assert len(codes) == 12 and "555" in M.SEGMENTS["Champion"]


def test_kpi_targets(spark):
    metrics = spark.createDataFrame(
        [(1, True, 5, Decimal("1.00")), (2, False, 5, Decimal("1.00"))],
        "order_id int, is_late boolean, review_score int, total_order_value decimal(10,2)")
    out = {r["metric"]: r for r in rows(M.kpi_dashboard(metrics))}
    assert (out["on_time_pct"]["value"], out["on_time_pct"]["status"]) == (50.0, "BELOW_TARGET")
    assert (out["nps"]["status"], out["revenue"]["status"]) == ("ON_TARGET", "NO_TARGET")


def test_dim_date_holidays_and_iso_weekdays(spark):
    holidays = spark.createDataFrame([(dt.date(2020, 12, 25),)], "date date")
    out = rows(G.dim_date(spark, "2020-12-25", "2020-12-27", holidays), "date")
    assert [(r["day_of_week"], r["is_weekend"], r["is_holiday"]) for r in out] == [
        (5, False, True), (6, True, False), (7, True, False)]
    assert out[0]["date_sk"] == 20201225


def test_missing_path(spark):
    from storeloom.sources.readers import read_table, require_path
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_table(spark, "/nowhere", "t")
    with pytest.raises(FileNotFoundError):
        require_path(spark, "/nowhere/t.parquet")


@pytest.mark.parametrize("batch", [[(1, "a"), (1, "b")], [(None, "a")]])
def test_scd2_refuses_repeated_and_null_keys(spark, batch):
    people = lambda data: spark.createDataFrame(data, "id int, city string")
    first = G.scd2_start(people([(1, "a")]), "id", ["city"], "2020-01-01")
    with pytest.raises(Exception, match="NULL or repeated"):
        G.scd2_merge(first, people(batch), "id", ["city"], "2020-02-01").collect()


def test_scd2_refuses_a_day_before_the_open_version(spark):
    people = lambda data: spark.createDataFrame(data, "id int, city string")
    first = G.scd2_start(people([(1, "a")]), "id", ["city"], "2020-01-01")
    with pytest.raises(Exception, match="before the version"):
        G.scd2_merge(first, people([(1, "b")]), "id", ["city"], "2019-12-31").collect()
    assert G.scd2_merge(first, people([(1, "a")]), "id", ["city"], "2019-12-31").count() == 1


def test_scd2_late_versions(spark):
    cols = "id int, city string, effective_from date, effective_to date, is_current boolean"
    day = dt.date
    history = spark.createDataFrame([
        (1, "a", day(2020, 1, 1), day(2020, 6, 1), False), (1, "b", day(2020, 6, 1), None, True),
        (2, "a", day(2020, 1, 1), day(2020, 3, 1), False), (2, "c", day(2020, 5, 1), day(2020, 9, 1), False),
        (3, "x", day(2020, 1, 1), None, True), (4, None, day(2020, 1, 1), None, True)], cols)
    late = spark.createDataFrame([
        (1, "late", day(2020, 3, 1)), (1, "first", day(2019, 1, 1)), (1, "b", day(2020, 7, 1)),
        (2, "gap", day(2020, 4, 1)), (2, "c", day(2020, 8, 1)), (2, "back", day(2021, 1, 1)),
        (4, "known", day(2020, 1, 1)), (5, "new", day(2020, 2, 2))], "id int, city string, effective_from date")
    out = G.scd2_insert(history, late, "id", ["city"])
    found = [(r["id"], r["city"], str(r["effective_from"]), str(r["effective_to"])) for r in rows(out, "id", "effective_from")]
    assert found == [
        (1, "first", "2019-01-01", "2020-01-01"), (1, "a", "2020-01-01", "2020-03-01"),
        (1, "late", "2020-03-01", "2020-06-01"), (1, "b", "2020-06-01", "None"),
        (2, "a", "2020-01-01", "2020-03-01"), (2, "gap", "2020-04-01", "2020-05-01"),
        (2, "c", "2020-05-01", "2020-09-01"), (2, "back", "2021-01-01", "None"),
        (3, "x", "2020-01-01", "None"), (4, "known", "2020-01-01", "None"), (5, "new", "2020-02-02", "None")]
    assert all(r["is_current"] == (r["effective_to"] is None) for r in out.collect())
    assert rows(G.scd2_insert(out, late, "id", ["city"]), "id", "effective_from") == rows(out, "id", "effective_from")
    for bad in ((1, "q", None), (None, "q", day(2020, 1, 1))):
        with pytest.raises(Exception, match="late version"):
            G.scd2_insert(history, spark.createDataFrame([bad], late.schema), "id", ["city"]).collect()
    with pytest.raises(Exception, match="late version"):
        G.scd2_insert(history, late.union(late), "id", ["city"]).collect()


def test_summary_of_nulls_and_no_rows(spark):
    df = spark.createDataFrame([(1, "a", None), (1, None, 2.5), (None, "b", 3.5), (None, None, None)],
                               "k int, s string, x double")
    figures = {"n": A.rows_counted(), "keys": "k", "texts": "s", "xs": "x", "no_k": A.nulls("k"),
               "mean": A.averaged("x"), "top": A.largest("x"), "least": A.smallest("x"), "all": A.summed("x"),
               "has_s": A.counted("s")}
    assert one(A.summary(df, figures)) == {"n": 4, "keys": 1, "texts": 2, "xs": 2, "no_k": 2, "mean": 3.0,
                                           "top": 3.5, "least": 2.5, "all": 6.0, "has_s": 2}
    assert one(A.summary(df.limit(0), figures)) == {
        "n": 0, "keys": 0, "texts": 0, "xs": 0, "no_k": 0, "mean": None, "top": None, "least": None, "all": None, "has_s": 0}
