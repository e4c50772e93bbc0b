"""Properties of the physical plans that must hold at any scale."""

import contextlib
import io
import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from storeloom.operators.dedup import dedupe_keep_first
from storeloom.operators.ordered import history_before, ntile, ordered_scan
from storeloom.plans import gold as G
from storeloom.sources import retail
from storeloom.sources.readers import read_table
from tests.conftest import SMALL


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_keep_first_is_limited_before_the_exchange(spark):
    df = dedupe_keep_first(read_table(spark, SMALL, "lineitem"), ["l_orderkey", "l_linenumber"],
                           ["l_partkey", "l_suppkey"])
    tree = plan(df).split("(1)")[0]
    partial = tree[tree.index("Exchange"):]
    assert "WindowGroupLimit" in partial


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(driver.queries()["delivery_sla_monthly"](spark, SMALL))
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string,o_orderdate:timestamp_ntz>" in text
    top = plan(driver.queries()["top_orders"](spark, SMALL))
    assert "TakeOrderedAndProject" in top and "Exchange rangepartitioning" not in top


@pytest.mark.parametrize("name", [
    "fk_report", "basket_category_pairs", "seller_performance", "sales_by_state",
    "order_metrics", "customer_metrics", "product_metrics", "fact_sales", "route_analysis",
    "status_distribution", "volumetry_orders", "silver_customers", "delay_features"])
def test_no_cartesian_products(spark, name):
    text = plan(driver.queries()[name](spark, SMALL))
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text


@pytest.mark.parametrize("name", ["order_metrics", "fact_sales", "rfm_segments", "delay_features"])
def test_no_python_in_the_plan(spark, name):
    text = plan(driver.queries()[name](spark, SMALL))
    assert "Python" not in text and "Pandas" not in text


@pytest.mark.parametrize("name, scans", [
    ("bronze_summary_customers", 2), ("bronze_summary_orders", 1), ("bronze_summary_order_items", 1),
    ("bronze_summary_products", 1), ("fk_cardinality", 1), ("item_statistics", 1)])
def test_several_distinct_counts_take_one_scan(spark, name, scans):
    """Customers are a join of two files."""
    text = plan(driver.queries()[name](spark, SMALL))
    assert "Expand" not in text and text.count("\nLocation: ") == scans


def test_keyed_reviews_prune_the_text(spark):
    """A query on scores alone never reads the review texts."""
    text = plan(driver.queries()["nps"](spark, SMALL))
    assert "text:string" not in text


def test_row_numbers_need_no_exchange_after_the_stored_layout(spark):
    df = read_table(spark, SMALL, "orders")
    for scan in (ordered_scan(df, ["o_orderkey"], number="nr", total="n"), ntile(df, ["o_orderkey"], 5, "tile")):
        tree = plan(scan).split("\n\n\n")[0]
        rows, starts = tree.split("BroadcastExchange")
        assert "Exchange" not in rows and "Window" not in rows and "Exchange" in starts


def test_building_a_cohort_matrix_stores_nothing(spark):
    from storeloom import session

    before = list(session._stored)
    driver.queries()["cohort_matrix"](spark, SMALL)
    assert session._stored == before


def test_scratch_removes_what_was_stored(spark):
    from storeloom import session

    folder = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    before = set(os.listdir(folder))
    with session.scratch(spark):
        assert driver.queries()["rfm_segments"](spark, SMALL).count() > 0
        assert set(os.listdir(folder)) != before
    assert set(os.listdir(folder)) == before


def exchanges(df) -> list[tuple[str, str]]:
    """Key and input columns of each exchange by hash."""
    found = []
    for node in plan(df).split("\n\n"):
        lines = node.splitlines()
        keys = [x for x in lines if x.startswith("Arguments: hashpartitioning(")]
        if "Exchange" in (lines or [""])[0] and keys:
            found.append((keys[0].removeprefix("Arguments: hashpartitioning(").split("#")[0],
                          next(x for x in lines if x.startswith("Input"))))
    return found


def test_baskets_meet_once(spark):
    """One exchange of the items by order and one of the counts by categories."""
    keys = [k for k, _ in exchanges(driver.queries()["basket_category_pairs"](spark, SMALL))]
    assert sorted(keys) == ["category_a", "order_id"]


def test_history_sends_no_rows_by_instant(spark):
    moments = spark.createDataFrame([], "k int, at timestamp_ntz, v bigint")
    sent = exchanges(history_before(moments, moments, "k", "at", ["v"], carry=["k"]))
    assert len(sent) <= 4 and all("_slot" in columns for _, columns in sent)


def test_customers_are_looked_up_per_order(spark):
    orders = spark.createDataFrame([], ", ".join(
        f"{c} {'timestamp_ntz' if c.startswith('order_') and c != 'order_id' else 'int'}" for c in G.SELLER_OUTCOME))
    items = spark.createDataFrame([], "order_id int, order_item_id int, product_id int, seller_id int, "
                                      "price decimal(10,2), freight_value decimal(10,2)")
    who = {w: spark.createDataFrame([], f"{w}_id int, {w}_state string, {w}_sk int")
           for w in ("customer", "product", "seller")}
    regions = spark.createDataFrame([], "state string, region string")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for df in (G.order_routes(items, orders, who["customer"], who["seller"], regions),
                   G.fact_sales(items, orders, {f"{w}s": t for w, t in who.items()})):
            sent = [columns for key, columns in exchanges(df) if key == "customer_id"]
            assert sent and all("seller_id" not in c and "price" not in c for c in sent)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_features_do_not_triple_rows_for_distinct_counts(spark):
    assert "Expand" not in plan(driver.queries()["delay_features"](spark, SMALL))


def test_lines_equal_items(spark):
    """Ties, repeated keys and nulls: the first columns of the smallest payload."""
    data = [(1, 1, 5, 2, 9.5, 3.0), (1, 1, 5, 2, 9.5, 1.0), (1, 1, 5, 3, 1.0, 1.0), (1, 2, None, 4, 2.0, 1.0),
            (1, 2, 1, 1, 1.0, 1.0), (2, 1, 7, None, None, 2.0), (2, 1, 7, None, 3.0, 1.0), (None, 1, 8, 1, 1.0, 1.0)]
    table = spark.createDataFrame(data, "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, "
                                        "l_extendedprice double, l_quantity double").withColumn(
        "l_shipdate", F.lit("2020-01-01").cast("timestamp_ntz"))
    items = retail.order_items(lambda name: table)
    for payload in (1, 2, 3):
        lines = retail.order_lines(lambda name: table, payload)
        assert sorted(map(str, lines.collect())) == sorted(map(str, items.select(*lines.columns).collect()))
