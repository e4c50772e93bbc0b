"""Every registered query by name: ``(spark, base) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property, wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storeloom.functions import columns as C
from storeloom.operators import aggregates as A
from storeloom.operators import checks as K
from storeloom.operators import clean, contracts, dedup, joins, observe, ordered, stores
from storeloom.plans import features as ML
from storeloom.plans import gold as G
from storeloom.plans import metrics as M
from storeloom.plans import silver as S
from storeloom.session import apply_settings, cut_lineage, new_folder
from storeloom.sources import retail, writers
from storeloom.sources.schemas import EXPECTED_ROWS, FOREIGN_KEYS, PRIMARY_KEYS

RUN_TS = "2002-01-01 00:00:00"
AS_OF = "2001-12-31"
EVENTS_AS_OF = "2024-02-01 00:00:00"
HALF = "1998-04-01"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


class Lake:
    """Bronze, silver and gold frames over one folder, each planned once."""

    def __init__(self, spark: SparkSession, base: str) -> None:
        self.spark = spark
        self.source = retail.reader(spark, base)
        self._bronze: dict[str, DataFrame] = {}
        self._silver: dict[tuple[str, bool], DataFrame] = {}
        self._lines: dict[int, DataFrame] = {}

    def b(self, name: str) -> DataFrame:
        if name not in self._bronze:
            self._bronze[name] = retail.BRONZE_TABLES[name](self.source)
        return self._bronze[name]

    def full(self, name: str, keyed: bool = False) -> DataFrame:
        """Silver table with its audit columns."""
        if (name, keyed) not in self._silver:
            tables = {name: self.b(name)}
            if name in ("customers", "sellers"):
                tables["geolocation"] = self.b("geolocation")
            self._silver[name, keyed] = S.silver(tables, RUN_TS, keyed)[name]
        return self._silver[name, keyed]

    def s(self, name: str) -> DataFrame:
        """Silver table for readers; bronze holds one row per key."""
        return S.without_audit(self.full(name, keyed=True))

    @cached_property
    def regions(self) -> DataFrame:
        return retail.state_regions(self.source)

    @cached_property
    def holidays(self) -> DataFrame:
        return retail.holidays(self.source)

    @cached_property
    def raw_items(self) -> DataFrame:
        return retail.order_items_raw(self.source)

    def lines(self, payload: int = 3) -> DataFrame:
        """Silver order items for readers of the order, product, seller and, of all three columns, price."""
        if payload not in self._lines:
            self._lines[payload] = S.silver_order_lines(retail.order_lines(self.source, payload))
        return self._lines[payload]

    def line_metrics(self, *columns: str) -> DataFrame:
        """Columns of the order metrics, from lines, which need fewer exchanges than whole items."""
        return G.order_metrics(self.s("orders"), self.lines(), self.s("order_reviews"),
                               self.s("order_payments")).select(*columns)

    @cached_property
    def metrics(self) -> DataFrame:
        return G.order_metrics(self.s("orders"), self.s("order_items"), self.s("order_reviews"),
                               self.s("order_payments"))

    @cached_property
    def customer_metrics(self) -> DataFrame:
        return G.customer_metrics(self.s("customers"), self.s("orders"), self.s("order_items"),
                                  self.s("order_reviews"), self.b("geolocation"), AS_OF)

    @cached_property
    def product_metrics(self) -> DataFrame:
        return G.product_metrics(self.s("products"), self.s("order_items"), self.s("orders"),
                                 self.s("order_reviews"))

    @cached_property
    def seller_orders(self) -> DataFrame:
        return G.seller_orders(self.s("order_items"), self.metrics)

    @cached_property
    def seller_metrics(self) -> DataFrame:
        return G.seller_metrics(self.s("sellers"), self.s("order_items"), self.metrics)

    @cached_property
    def category_orders(self) -> DataFrame:
        return M.category_orders(self.s("order_items"), self.s("products"), self.metrics)

    @cached_property
    def routes(self) -> DataFrame:
        return G.order_routes(self.s("order_items"), self.metrics, self.s("customers"),
                              self.s("sellers"), self.regions)

    @cached_property
    def customer_orders(self) -> DataFrame:
        return M.with_customer_column(self.s("orders"), self.s("customers"), "customer_unique_id")

    # Frames that a query reads more than once are written once, as a gold table would be.

    @cached_property
    def stored_seller_orders(self) -> DataFrame:
        return cut_lineage(G.seller_orders(self.lines(), self.line_metrics(*G.SELLER_OUTCOME)).select(
            "seller_id", "order_id", "order_purchase_timestamp", "order_delivered_customer_date", "delay_days",
            "is_late"))

    @cached_property
    def stored_metrics(self) -> DataFrame:
        return cut_lineage(self.metrics)

    @cached_property
    def stored_outcomes(self) -> DataFrame:
        return cut_lineage(self.line_metrics(*G.SALE_OUTCOME))

    @cached_property
    def features(self) -> DataFrame:
        metrics = cut_lineage(self.line_metrics(
            *G.SELLER_OUTCOME, "order_estimated_delivery_date", "total_order_value", "total_items"))
        routes = G.order_routes(self.lines(), metrics, self.s("customers"), self.s("sellers"), self.regions)
        return ML.delay_features(metrics, self.lines(2), self.s("products"), routes, self.s("order_payments"),
                                 self.s("order_reviews"), self.holidays)

    @cached_property
    def halves(self) -> tuple[DataFrame, DataFrame]:
        """Order metrics before and from the middle of the period on."""
        at, cut = F.col("order_purchase_timestamp"), F.lit(HALF).cast("timestamp_ntz")
        return self.stored_metrics.filter(at < cut), self.stored_metrics.filter(at >= cut)

    @cached_property
    def run_log(self) -> DataFrame:
        """A load per purchase month: bronze ends when the month does, silver later by one
        second per row."""
        month = C.month_start("order_purchase_timestamp")
        runs = (self.b("orders").groupBy(month.alias("at")).agg(F.count("*").alias("row_count"))
                .withColumn("run_id", F.date_format("at", "yyyy-MM")))
        later = F.col("at") + F.make_dt_interval(secs=F.col("row_count").cast("decimal(18,6)"))
        return runs.select("run_id", F.lit("orders").alias("table_name"), "row_count", F.explode(
            F.array(F.struct(F.lit("bronze").alias("layer"), F.col("at").alias("finished_at")),
                    F.struct(F.lit("silver").alias("layer"), later.alias("finished_at"))))
            .alias("r")).select("run_id", "table_name", "row_count", "r.*")

    @cached_property
    def incidents(self) -> DataFrame:
        """Error events as incidents; one in nine is still open."""
        key, opened = F.col("event_id"), F.col("ts")
        return self.source("events").filter(F.col("event_type") == "error").select(
            F.element_at(F.array(F.lit("LOW"), F.lit("MEDIUM"), F.lit("HIGH")),
                         (key % 3 + 1).cast("int")).alias("severity"),
            opened.alias("opened_at"),
            F.when(key % 9 != 0, opened + F.make_dt_interval(mins=(key % 600 + 1).cast("int")))
            .alias("resolved_at"))


def query(function: Callable[[Lake], DataFrame]) -> Callable[[Lake], DataFrame]:
    @wraps(function)
    def run(spark: SparkSession, base: str) -> DataFrame:
        return function(Lake(apply_settings(spark), base))

    QUERIES[function.__name__] = run
    return function


def _moment(df: DataFrame, *cols: str) -> DataFrame:
    """Dates as midnight timestamps, the one form all clients read alike."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


# --- sources and sinks ----------------------------------------------------------------------

@query
def scan_projection(t):
    return t.source("orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")


@query
def load_metadata(t):
    return writers.add_load_metadata(t.b("products"), "part.parquet", RUN_TS)


@query
def export_manifest(t):
    return writers.export_manifest(t.s("orders"), "order_purchase_timestamp", "orders")


@query
def export_summary(t):
    return writers.export_summary([
        writers.export_manifest(t.s("orders"), "order_purchase_timestamp", "orders"),
        writers.export_manifest(t.s("order_reviews"), "review_creation_date", "order_reviews"),
        writers.export_manifest(t.s("order_items"), "shipping_limit_date", "order_items")])


@query
def incremental_merge(t):
    """Orders upserted by themselves: every third order arrives again, cancelled, a day later. Of
    every fourth order a late state comes as well, and of every fifth one of the same instant."""
    base = t.s("orders").select("order_id", "order_status", "order_purchase_timestamp")
    later = lambda df, days: df.withColumn(
        "order_purchase_timestamp", F.col("order_purchase_timestamp") + F.make_dt_interval(F.lit(days)))
    again = later(base.filter("order_id % 3 = 0").withColumn("order_status", F.lit("canceled")), 1)
    late = later(base.filter("order_id % 4 = 0").withColumn("order_status", F.lit("zz late")), -1)
    tied = base.filter("order_id % 5 = 0").withColumn("order_status", F.lit("zz tied"))
    new = again.withColumn("order_id", -1 - F.col("order_id"))
    updates = base.unionByName(again).unionByName(late).unionByName(tied).unionByName(new)
    return writers.incremental_merge(base, updates, ["order_id"], "order_purchase_timestamp")


@query
def fact_orders_upserted(t):
    """Order facts in five loads: all as of the purchase, then a month, the months around it
    with older states of it, the first batch again, and a state of the same instant."""
    facts = cut_lineage(G.fact_orders(t.metrics))
    state = lambda where, change, at: facts.filter(where).withColumns(
        change | {"updated_at": F.lit(at).cast("timestamp_ntz")})
    month, day = F.expr("date_key_purchase div 100"), "1998-0{}-01 00:00:00".format
    bought = {"delivery_days": F.lit(None).cast("int"), "review_score": F.lit(None).cast("int")}
    target = new_folder(t.spark)
    for batch in (state(F.lit(True), bought, day(1)), state(month == 199803, {}, day(4)),
                  state(month.between(199802, 199804), {"delivery_days": F.lit(-1)}, day(3)),
                  state(month == 199803, {}, day(4)),
                  state(month == 199803, {"customer_sk": F.lit("")}, day(4))):
        G.upsert_fact_orders(t.spark, target, batch)
    held = writers.read_months(t.spark, target, batch.withColumn("purchase_date", F.current_date()).schema)
    return _moment(held, "purchase_date")


# --- projections and filters ----------------------------------------------------------------

@query
def fill_defaults(t):
    return clean.fill_defaults(
        t.b("products").select("product_id", "product_description_lenght", "product_photos_qty"),
        {"product_description_lenght": 0, "product_photos_qty": 0})


@query
def product_volume(t):
    return clean.product_volume(t.b("products")).select("product_id", "product_volume_cm3")


@query
def item_total_value(t):
    return clean.item_total_value(t.b("order_items")).select(
        "order_id", "order_item_id", "item_total_value")


@query
def presence_flags(t):
    return clean.all_present_flag(
        clean.presence_flags(t.b("products"), {"has_category": "product_category_name"}),
        "has_dimensions", ["product_length_cm", "product_height_cm", "product_width_cm"],
    ).select("product_id", "has_category", "has_dimensions")


@query
def threshold_flags(t):
    out = clean.threshold_flag(t.b("products"), "has_photos", "product_photos_qty", ">", 0)
    return out.select("product_id", "has_photos")


@query
def equals_flags(t):
    out = clean.equals_flag(t.b("order_payments"), "is_credit_card", "payment_type", "credit_card")
    return out.select("order_id", "payment_sequential", "is_credit_card")


@query
def bbox_flag(t):
    return clean.bbox_flag(t.b("geolocation"), "inside", "geolocation_lat", "geolocation_lng") \
        .groupBy("geolocation_zip_code_prefix", "inside").agg(F.count("*").alias("readings"))


@query
def bbox_filter(t):
    return clean.bbox_filter(t.b("geolocation"), "geolocation_lat", "geolocation_lng")


@query
def delivery_times(t):
    return clean.delivery_times(t.b("orders"))


@query
def late_orders(t):
    return clean.late_orders(t.b("orders"))


@query
def overweight_products(t):
    return clean.overweight_products(t.b("products"), 10_000)


@query
def negative_reviews(t):
    return clean.negative_reviews(t.b("order_reviews"))


@query
def all_negative_reviews(t):
    return clean.negative_reviews(t.b("order_reviews"), limit=None)


# --- deduplication --------------------------------------------------------------------------

@query
def dedupe_keep_first(t):
    return dedup.dedupe_keep_first(
        t.raw_items, ["order_id", "order_item_id"],
        [F.desc("shipping_limit_date"), "product_id", "seller_id", "_price", "_quantity"]) \
        .select("order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date")


@query
def duplicate_count(t):
    return dedup.duplicate_count(t.raw_items, ["order_id", "order_item_id"])


@query
def distinct_rows(t):
    return dedup.distinct_rows(t.raw_items.select("product_id", "seller_id"))


@query
def distinct_on(t):
    return dedup.distinct_on(t.source("events"), ["user_id"], [F.desc("ts"), "event_id"]) \
        .select("user_id", "event_id", "event_type", "ts", "value")


@query
def geo_consolidate(t):
    return dedup.geo_consolidate(t.b("geolocation"))


@query
def original_count(t):
    return dedup.original_count(t.raw_items, ["order_id", "order_item_id"])


@query
def dedup_report(t):
    return dedup.dedup_report(t.b("geolocation"), t.s("geolocation"),
                              "geolocation_zip_code_prefix")


@query
def dedup_report_items(t):
    return dedup.dedup_report(t.raw_items, t.s("order_items"), "order_id")


@query
def dedup_profile(t):
    return dedup.dedup_profile(dedup.original_count(t.raw_items, ["order_id", "order_item_id"]))


# --- joins ----------------------------------------------------------------------------------

@query
def enrich_geolocation(t):
    return joins.enrich_geolocation(t.b("sellers"), "seller_zip_code_prefix", t.b("geolocation"))


@query
def customer_coordinates(t):
    return joins.customer_coordinates(t.b("customers"), t.s("geolocation"))


@query
def fk_orphans(t):
    """Reviews against orders that were delivered: the others are orphans."""
    return joins.fk_orphans(t.b("order_reviews"), G.delivered_only(t.b("orders")),
                            "order_id", "order_id")


@query
def fk_report(t):
    return joins.fk_report({n: t.b(n) for n in PRIMARY_KEYS}, FOREIGN_KEYS)


@query
def order_item_product_path(t):
    return joins.order_item_product_path(t.b("customers"), t.b("orders"), t.b("order_items"),
                                         t.b("products"))


@query
def seller_reviews(t):
    return joins.seller_reviews(t.b("sellers"), t.b("order_items"), t.b("order_reviews"))


@query
def basket_category_pairs(t):
    return joins.basket_category_pairs(t.lines(1), t.b("products"))


@query
def basket_categories(t):
    return joins.basket_categories(t.lines(1), t.b("products"))


@query
def customer_seller_distance(t):
    return joins.customer_seller_distance(t.b("orders"), t.b("order_items"), t.b("customers"),
                                          t.b("sellers"), dedup.geo_consolidate(t.b("geolocation")))


# --- aggregations ---------------------------------------------------------------------------

@query
def profile(t):
    return A.profile(t.b("products"), ["product_id"])


@query
def profile_items(t):
    return A.profile(t.b("order_items"), ["order_id", "order_item_id"])


@query
def composite_distinct(t):
    return A.composite_distinct(t.raw_items, ["order_id", "order_item_id"])


def _bronze_summary(table):
    def run(t):
        return A.bronze_summary(table, t.b(table))
    run.__name__ = f"bronze_summary_{table}"
    query(run)


for _table in retail.BRONZE_TABLES:
    _bronze_summary(_table)


@query
def status_distribution(t):
    return A.distribution(t.s("orders"), "order_status")


@query
def score_distribution(t):
    return A.distribution(t.b("order_reviews"), "review_score")


@query
def payment_distribution(t):
    return A.distribution(t.s("order_payments"), "payment_type", {
        "total_value": F.sum("payment_value"), "avg_value": C.mean("payment_value"),
        "avg_installments": C.mean("payment_installments")})


@query
def top_states(t):
    return A.top_k(t.s("customers"), "customer_state", 5,
                   measures={"with_geo": F.count_if(F.col("has_geolocation"))})


@query
def top_product_categories(t):
    return A.top_k(t.s("products"), "product_category_name", 5, where=F.col("has_category"))


@query
def multi_payment_summary(t):
    return A.multi_payment_summary(t.s("order_payments"))


@query
def geo_enrichment_summary(t):
    return A.geo_enrichment_summary(t.s("customers"))


@query
def order_flag_rates(t):
    return A.flag_rates(t.s("orders"), ["is_approved", "is_shipped", "is_delivered"])


@query
def product_flag_rates(t):
    return A.flag_rates(t.s("products"),
                        ["has_category", "has_weight", "has_dimensions", "has_photos"],
                        {"with_volume": F.count("product_volume_cm3"),
                         "unique_categories": F.countDistinct("product_category_name")})


@query
def item_flag_rates(t):
    return A.flag_rates(t.s("order_items"), ["has_price", "has_freight"], {
        "avg_price": C.mean("price"), "min_price": F.min("price"), "max_price": F.max("price"),
        "avg_freight": C.mean("freight_value"), "avg_item_total": C.mean("item_total_value")})


@query
def payment_flag_rates(t):
    return A.flag_rates(t.s("order_payments"),
                        ["has_value", "is_installment", "is_credit_card", "is_boleto"], {
        "avg_value": C.mean("payment_value"), "min_value": F.min("payment_value"),
        "max_value": F.max("payment_value"), "avg_installments": C.mean("payment_installments"),
        "max_installments": F.max("payment_installments")})


@query
def review_flag_rates(t):
    return A.flag_rates(t.s("order_reviews"),
                        ["has_comment_title", "has_comment_message", "has_answer",
                         "is_positive_score", "is_negative_score"], {
        "neutral": F.count_if(~F.col("is_positive_score") & ~F.col("is_negative_score")),
        "avg_comment_length": C.mean(F.when(F.col("comment_length") > 0, F.col("comment_length"))),
        "max_comment_length": F.max("comment_length")})


@query
def avg_positive(t):
    return A.avg_positive(t.s("products"), ["product_weight_g", "product_volume_cm3"])


@query
def items_per_position(t):
    return A.items_per_position(t.s("order_items"))


@query
def fk_cardinality(t):
    return A.fk_cardinality(t.s("order_items"))


@query
def csv_statistics(t):
    return A.csv_statistics(t.b("order_payments"))


@query
def item_statistics(t):
    return A.item_statistics(t.b("order_items"))


@query
def review_statistics(t):
    return A.review_statistics(t.b("order_reviews"))


@query
def repeat_customers(t):
    return A.repeat_customers(t.b("customers"))


@query
def order_totals(t):
    return A.order_totals(t.b("order_items"))


@query
def average_ticket(t):
    return A.average_ticket(t.b("order_items"))


@query
def multi_item_orders(t):
    return A.multi_item_orders(t.b("order_items"))


@query
def payment_types_per_order(t):
    return A.payment_types_per_order(t.s("order_payments"), min_payments=2)


@query
def distinct_payment_types_per_order(t):
    return A.payment_types_per_order(t.s("order_payments"), distinct=True)


@query
def review_answer_rate(t):
    return A.review_answer_rate(t.b("order_reviews"))


@query
def nps(t):
    return A.nps(t.b("order_reviews"))


@query
def nps_by_month(t):
    dated = t.b("order_reviews").withColumn("month", C.month_start("review_creation_date"))
    return A.nps(dated, by="month")


@query
def delivery_sla_monthly(t):
    return A.delivery_sla_monthly(t.b("orders"))


@query
def top_sellers(t):
    return A.top_sellers(t.b("sellers"), t.b("order_items"))


@query
def top_categories(t):
    return A.top_categories(t.b("products"), t.b("order_items"))


@query
def top_categories_delivered(t):
    return A.top_categories_delivered(t.b("products"), t.b("order_items"), t.b("orders"))


@query
def sales_by_state(t):
    return A.sales_by_state(t.b("customers"), t.b("orders"), t.b("order_items"))


@query
def seller_performance(t):
    return A.seller_performance(t.b("sellers"), t.b("order_items"), t.b("order_reviews"))


# --- windows, order, sets -------------------------------------------------------------------

@query
def rfm_scores(t):
    base = M.rfm_base(t.s("orders"), t.s("order_items"), "customer_id", AS_OF)
    return M.rfm_scores(base, "customer_id").drop("last_purchase")


@query
def global_row_numbers(t):
    return ordered.ordered_scan(
        t.source("lineitem").groupBy("l_partkey", "l_suppkey").agg(F.count("*").alias("lines")),
        ["l_partkey", "l_suppkey"], number="row_number",
        running={"running_lines": "lines"}).drop("running_lines_total")


@query
def quantiles(t):
    out = ordered.quantile_values(t.b("order_items"), "price", [0.1, 0.5, 0.95])
    return out.withColumn("quantile", F.round("quantile", 4))


@query
def seller_history_features(t):
    return ML.seller_history_features(t.stored_seller_orders, t.s("order_reviews"))


@query
def top_orders(t):
    return clean.top_n(t.source("orders").select("o_orderkey", "o_totalprice"),
                       [F.desc("o_totalprice"), "o_orderkey"], 100)


@query
def union_metrics(t):
    return A.union_metrics([
        t.b(n).agg(F.lit(n).alias("table_name"), F.count("*").alias("row_count"))
        for n in retail.BRONZE_TABLES])


# --- checks ---------------------------------------------------------------------------------

@query
def check_row_counts(t):
    return K.check_row_counts({n: t.b(n) for n in EXPECTED_ROWS}, EXPECTED_ROWS)


@query
def null_counts(t):
    return K.null_counts(t.b("orders"), t.b("orders").columns)


@query
def range_check(t):
    return K.range_check(t.s("order_reviews"), "review_score", 1, 5)


@query
def check_timestamp_order(t):
    return K.check_timestamp_order(t.b("orders"), [
        ("order_purchase_timestamp", "order_approved_at"),
        ("order_delivered_carrier_date", "order_delivered_customer_date"),
        ("order_estimated_delivery_date", "order_delivered_customer_date")])


@query
def check_sequence(t):
    return K.check_sequence(t.b("order_items"), "order_id", "order_item_id")


def _silver_queries(table):
    keys = PRIMARY_KEYS[table]

    def transform(t):
        return S.without_audit(t.full(table))

    def volume(t):
        return K.volumetry(t.b(table), t.full(table))

    def integrity(t):
        return K.key_integrity(t.full(table), keys)

    def record(t):
        return K.run_result(table, K.volumetry(t.b(table), t.full(table)),
                            K.key_integrity(t.full(table), keys))

    for name, f in {"silver": transform, "volumetry": volume, "key_integrity": integrity,
                    "run_result": record}.items():
        f.__name__ = f"{name}_{table}"
        query(f)


for _table in retail.BRONZE_TABLES:
    _silver_queries(_table)


@query
def audit_check(t):
    return K.audit_check(t.full("orders", True), ["processed_at", "updated_at", "created_at"]) \
        .withColumns({c: F.col(c).cast("timestamp_ntz")
                      for c in ("min_processed_at", "max_processed_at")})


@query
def case_check(t):
    return K.case_check(t.b("orders"), "order_status", "lower")


@query
def case_check_silver(t):
    return K.case_check(t.s("sellers"), "seller_state", "upper")


@query
def derived_sum_check(t):
    return K.derived_sum_check(t.s("order_items"), "item_total_value", ["price", "freight_value"])


@query
def geo_check(t):
    return K.geo_check(t.s("geolocation"))


@query
def not_null_check(t):
    return K.not_null_check(t.s("orders"), "order_purchase_timestamp")


# --- contracts ------------------------------------------------------------------------------

def _suite_queries(layer, suites):
    for table, suite in suites.items():
        def run(t, table=table, suite=suite):
            return contracts.run_suite(t.b(table) if layer == "bronze" else t.full(table, True), suite)
        run.__name__ = f"{layer}_suite_{table}"
        query(run)


_suite_queries("bronze", contracts.BRONZE_SUITES)
_suite_queries("silver", contracts.SILVER_SUITES)


def _checkpoints(t):
    """A store with a run over bronze and one over silver, of which one suite is run again."""
    store = new_folder(t.spark)
    for n, s in contracts.BRONZE_SUITES.items():
        contracts.run_checkpoint(t.b(n), s, f"bronze_{n}", "run-1", "2002-01-01", store)
    for n, s in [*contracts.SILVER_SUITES.items(), ("products", contracts.SILVER_SUITES["products"])]:
        contracts.run_checkpoint(t.full(n, True), s, f"silver_{n}", "run-2", "2002-01-02", store)
    return contracts.read_store(t.spark, store, since="2002-01-01")


@query
def suite_statistics(t):
    suite = contracts.SILVER_SUITES["customers"]
    return contracts.suite_statistics(contracts.run_suite(t.full("customers", True), suite), "customers")


@query
def suite_failures(t):
    return contracts.failures(_checkpoints(t)).select("suite", "position", "expectation_type",
                                                      "column_name")


@query
def suite_summary(t):
    return contracts.summarise([
        contracts.suite_statistics(contracts.run_suite(t.full(n, True), s), n)
        for n, s in contracts.SILVER_SUITES.items()])


@query
def top_failures(t):
    return contracts.top_failures(_checkpoints(t))


@query
def success_trend(t):
    return contracts.success_trend(_checkpoints(t))


# --- observability --------------------------------------------------------------------------

def _freshness(t):
    orders = t.source("orders").select(F.col("o_orderdate").alias("at"))
    return observe.freshness([
        ("Bronze", "events", t.source("events"), "ts"),
        ("Bronze", "orders", orders, "at"),
        ("Silver", "reviews", t.s("order_reviews"), "review_creation_date")], EVENTS_AS_OF)


@query
def freshness(t):
    return _freshness(t)


@query
def stale_tables(t):
    return observe.stale_tables(_freshness(t))


@query
def column_statistics(t):
    cols = ["price", "freight_value"]
    return observe.column_statistics(cut_lineage(t.s("order_items").select(*cols)), cols,
                                     "order_items", AS_OF)


@query
def statistic_drift(t):
    """Both halves of the period from stored monthly counts, kept as two captures and compared as of
    the later one."""
    counts, log = new_folder(t.spark), new_folder(t.spark)
    stores.save_value_counts(t.metrics, counts, "orders", ["total_items", "delivery_days"],
                             "order_purchase_timestamp", "month")
    stores.save_statistics([
        stores.statistics_of_span(t.spark, counts, "orders", "1900-01-01", HALF, HALF),
        stores.statistics_of_span(t.spark, counts, "orders", HALF, "2100-01-01", AS_OF)], log)
    return stores.stored_drift(stores.read_statistics(t.spark, log), AS_OF)


@query
def share_drift(t):
    return observe.share_drift(*t.halves, "order_status")


@query
def psi(t):
    return observe.psi(*t.halves, "total_items_value")


def _feature_drift(t):
    return observe.feature_drift(
        *t.halves, ["total_items_value", "delivery_days", "total_items"],
        {"order_status": 5.991, "payment_types": 7.815})


@query
def feature_drift(t):
    return _feature_drift(t)


@query
def drift_summary(t):
    return observe.drift_summary(_feature_drift(t))


@query
def row_count_history(t):
    return observe.row_count_history(t.run_log)


@query
def mttr(t):
    return observe.mttr(t.incidents)


# --- gold -----------------------------------------------------------------------------------

@query
def dim_date(t):
    span = t.b("orders").agg(F.struct(
        F.min(F.to_date("order_purchase_timestamp")).alias("a"),
        F.max(F.to_date("order_estimated_delivery_date")).alias("b"))).scalar()
    return _moment(G.dim_date(t.spark, span["a"], span["b"], t.holidays), "date")


@query
def dim_customers(t):
    rfm = M.rfm_segments(t.s("orders"), t.s("order_items"), "customer_id", AS_OF)
    capitals = t.b("customers").groupBy(F.col("customer_state").alias("state")).agg(
        F.min("customer_city").alias("city"))
    return _moment(G.dim_customers(t.customer_metrics, rfm, AS_OF, t.regions, capitals, "2001-01-01"),
                   "effective_from", "effective_to")


TRACKED = ["customer_city", "customer_state"]


def _customer_history(t):
    people, key = t.b("customers").select("customer_id", *TRACKED), F.col("customer_id")
    first = G.scd2_start(people.filter(key % 10 != 3), "customer_id", TRACKED, "1996-01-01")
    batch = people.filter(key % 10 != 7).withColumn("customer_city", F.when(
        key % 4 == 0, F.lower("customer_city")).otherwise(F.col("customer_city")))
    return G.scd2_merge(first, batch, "customer_id", TRACKED, "1998-01-01")


@query
def scd2_merge(t):
    """Customers loaded in 1996; in 1998 some are gone, some moved and some are new."""
    return _moment(_customer_history(t), "effective_from", "effective_to")


def _with_late_versions(t):
    """Late versions inside, before and after a customer's intervals, on the day of a known one, and
    some that say what held already."""
    people, key = t.b("customers").select("customer_id", *TRACKED), F.col("customer_id")
    arrivals = [(5, "1997-03-05", "late"), (6, "1994-02-01", "early"), (11, "1998-01-01", "fixed"),
                (7, "1999-05-01", "after"), (9, "1997-07-01", None)]
    late = [people.filter(key % n == 0).withColumns(
        {"effective_from": F.lit(day).cast("date"),
         "customer_city": F.lit(city) if city else F.col("customer_city")}) for n, day, city in arrivals]
    return G.scd2_insert(_customer_history(t), A.union_metrics(late), "customer_id", TRACKED)


@query
def scd2_late_versions(t):
    return _moment(_with_late_versions(t), "effective_from", "effective_to")


@query
def fact_sales_versioned(t):
    """Sales with the key of the customer's version on the purchase day."""
    versions = _with_late_versions(t).withColumn(
        "customer_sk", C.md5_key(["customer_id", "effective_from"]))
    return G.fact_sales(t.lines(), t.stored_outcomes, customer_versions=versions)


@query
def scd2_validity(t):
    """Order states of a customer's purchase days as versions that follow one another."""
    versions = t.s("orders").groupBy(
        "customer_id", F.to_date("order_purchase_timestamp").alias("effective_from")).agg(
        F.max("order_status").alias("order_status"))
    return _moment(G.scd2_validity(versions, "customer_id"), "effective_from", "effective_to")


@query
def dim_products(t):
    return G.dim_products(t.product_metrics, AS_OF)


@query
def dim_sellers(t):
    return G.dim_sellers(t.seller_metrics, t.regions)


@query
def dim_geolocation(t):
    return G.dim_geolocation(t.s("geolocation"))


@query
def dim_payment_method(t):
    return G.dim_payment_method(t.s("order_payments"))


@query
def surrogate_key_sequence(t):
    return G.surrogate_key(t.s("products").select("product_id"), ["product_id"], "product_sk",
                           how="sequence")


@query
def fact_sales(t):
    return G.fact_sales(t.lines(), t.stored_outcomes)


@query
def fact_sales_lookup(t):
    """Keys looked up in the dimensions; dense numbers instead of hashes."""
    dims = {f"{who}s": G.surrogate_key(t.s(f"{who}s").select(f"{who}_id"), [f"{who}_id"],
                                       f"{who}_sk", how="sequence")
            for who in ("customer", "product", "seller")}
    return G.fact_sales(t.lines(), t.stored_outcomes, dims)


@query
def fact_deliveries(t):
    return G.fact_deliveries(t.s("orders"), t.s("order_items"), t.s("customers"), t.s("sellers"),
                             t.s("geolocation"))


@query
def fact_orders(t):
    return G.fact_orders(t.metrics)


@query
def fact_order_items(t):
    return G.fact_order_items(t.s("order_items"))


@query
def fact_reviews(t):
    return G.fact_reviews(t.s("order_reviews"))


@query
def customer_metrics(t):
    return t.customer_metrics


@query
def order_metrics(t):
    return t.metrics


@query
def product_metrics(t):
    return t.product_metrics


@query
def seller_metrics(t):
    return t.seller_metrics


@query
def delay_classes(t):
    """Orders per delay class, from the delay functions alone."""
    days = C.delay_days("order_delivered_customer_date", "order_estimated_delivery_date")
    return t.s("orders").groupBy(C.delay_class(days).alias("delay_category")).agg(
        F.count("*").alias("orders"), F.max(days).alias("max_days"))


@query
def route_analysis(t):
    return G.route_analysis(t.routes)


# --- KPIs and analyses ----------------------------------------------------------------------

@query
def rfm_segments(t):
    return M.rfm_segments(t.customer_orders, t.s("order_items"), "customer_unique_id", AS_OF)


@query
def cohort_matrix(t):
    return M.cohort_matrix(t.customer_orders)


@query
def cohort_retention(t):
    return M.cohort_retention(t.customer_orders)


@query
def agg_seller_performance(t):
    return M.agg_seller_performance(t.seller_orders)


@query
def agg_category_performance(t):
    return M.agg_category_performance(t.category_orders)


@query
def agg_geographic_analysis(t):
    return M.agg_geographic_analysis(t.routes)


@query
def kpi_dashboard(t):
    return M.kpi_dashboard(t.metrics)


@query
def delay_score_correlation(t):
    return M.delay_score_correlation(t.metrics)


@query
def pareto(t):
    return M.pareto(M.late_by_seller(t.seller_orders), "seller_id", "late_orders")


@query
def pareto_summary(t):
    return M.pareto_summary(M.pareto(M.late_by_seller(t.seller_orders), "seller_id",
                                     "late_orders"))


@query
def seasonality(t):
    return M.seasonality(t.metrics)


@query
def category_risk(t):
    return M.category_risk(t.category_orders)


@query
def clv(t):
    return M.clv(t.customer_metrics)


@query
def churned(t):
    return M.churned(t.customer_metrics, AS_OF)


@query
def revenue_at_risk(t):
    return M.revenue_at_risk(t.metrics)


# --- delay prediction -----------------------------------------------------------------------

@query
def delay_features(t):
    return t.features


TRAIN_END, VAL_END = "1999-07-01", "2000-07-01"


@query
def temporal_split(t):
    return ML.split_counts(ML.temporal_split(t.features, "order_purchase_timestamp",
                                             TRAIN_END, VAL_END))


SCORED_AT = "2001-09-01 06:00:00"


def _trained(t):
    rows = cut_lineage(ML.temporal_split(t.features, "order_purchase_timestamp", TRAIN_END, VAL_END))
    train, val, test = (rows.filter(F.col("split") == p) for p in ("train", "val", "test"))
    return ML.train_delay_model(train, val), test


def _predictions(t):
    """The test period scored by a model that was saved and loaded, without outcomes, which are
    filled in later; and the features."""
    model, test = _trained(t)
    models, store = new_folder(t.spark), new_folder(t.spark)
    ML.save_model(model, models, "v1")
    ML.save_predictions(ML.score_batch(ML.load_model(models, "v1"), test, "v1", SCORED_AT), store)
    ML.fill_outcomes(t.spark, store, test.select("order_id", "is_delayed"))
    return ML.read_predictions(t.spark, store), test


@query
def score_orders(t):
    """Every order of the test period, delivered or not, with what any model must keep: a
    probability, and the level that belongs to it."""
    p, level = F.col("delay_probability"), F.col("risk_level")
    return _predictions(t)[0].select(
        "prediction_id", "order_id", "predicted_at", "actual_outcome",
        p.between(0, 1).alias("probability_valid"),
        (level == F.when(p > 0.7, "HIGH").when(p < 0.4, "LOW").otherwise("MEDIUM")).alias("level_valid"),
        "model_version")


@query
def model_evaluation(t):
    """Known outcomes of the test period, whether the figures follow from the four counts, and what a
    model without skill fails: a better order than the seller's history gives, and more
    delays among the orders that it fears most."""
    scores, test = _predictions(t)
    history = test.select((F.col("delay_rate_history") / 100).alias("rate"), "is_delayed")
    tp, fp, fn = (F.col(f"{c}") for c in ("true_positive", "false_positive", "false_negative"))
    auc = ML.rank_auc(scores, "delay_probability", "actual_outcome").select("auc").scalar()
    tenths = ML.calibration(scores).agg(
        (F.max_by("observed_rate", "tile") > F.min_by("observed_rate", "tile")).alias("rises")).scalar()
    return ML.evaluate(scores).select(
        "orders", (tp + fn).alias("delayed"),
        (F.coalesce(F.abs(F.col("precision") * (tp + fp) - tp) < 1e-6, tp + fp == 0)
         & F.coalesce(F.abs(F.col("recall") * (tp + fn) - tp) < 1e-6, tp + fn == 0)
         & (tp + fp + fn <= F.col("orders"))).alias("figures_valid"),
        (auc > 0.6).alias("has_skill"),
        (auc > ML.rank_auc(history, "rate", "is_delayed").select("auc").scalar()).alias("beats_history"),
        tenths.alias("tenths_rise"))


@query
def feature_importance(t):
    """All features have an importance, and what delays depend on in these tables leads: the day of
    the week, and the order's number modulo 20, of which installments show the last digit."""
    rows = ML.importance_rows(t.spark, _trained(t)[0])
    return rows.agg(F.count("*").alias("features"), (F.abs(F.sum("importance") - 1) < 1e-6).alias("adds_up"),
                    F.min_by("feature", "rank").isin("order_dow", "is_weekend", "max_installments")
                    .alias("cause_leads"))


# The seller's delay rate so far, as a score that any engine computes alike.

def _rated(t, split=None):
    rows = ML.temporal_split(t.features, "order_purchase_timestamp", TRAIN_END, VAL_END)
    return (rows if split is None else rows.filter(F.col("split") == split)).select(
        "order_id", "split", (F.col("delay_rate_history") / 100).alias("delay_probability"),
        F.col("is_delayed").alias("actual_outcome"))


@query
def history_evaluation(t):
    return ML.evaluate(_rated(t), 0.3)


@query
def history_auc(t):
    return ML.rank_auc(_rated(t), "delay_probability", "actual_outcome")


@query
def history_risk_alert(t):
    return ML.risk_alert(_rated(t).withColumn("risk_level", ML.risk_level("delay_probability")))


@query
def performance_drift(t):
    rows = cut_lineage(_rated(t))
    val, test = (ML.rank_auc(rows.filter(F.col("split") == p), "delay_probability", "actual_outcome")
                 for p in ("val", "test"))
    return ML.performance_drift(test, val, "2001-01-01 00:00:00")
