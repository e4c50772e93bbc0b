"""SQL text per registered query."""

from __future__ import annotations

from oracle.base import (DELAYS, DELAYS_LONG, NPS, day_key, hits, md5_of, mean, pct, with_ctes)
from oracle.contracts import failures_sql, statistics_sql, suite_sql, checkpoints_sql
from storeloom.operators.contracts import BRONZE_SUITES, SILVER_SUITES
from storeloom.plans.metrics import SEGMENTS
from storeloom.sources.schemas import EXPECTED_ROWS, FOREIGN_KEYS, PRIMARY_KEYS

ORACLE: dict[str, str] = {}


def sql(name: str, query: str) -> None:
    ORACLE[name] = with_ctes(query)


# --- sources and sinks ----------------------------------------------------------------------

sql("scan_projection", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders")
sql("load_metadata", """SELECT *, TIMESTAMP '2002-01-01 00:00:00' AS _loaded_at,
    'part.parquet' AS _source_file FROM b_products""")


def _manifest(table: str, ts: str) -> str:
    return f"""SELECT '{table}' AS table_name, CAST(year({ts}) AS INT) AS year,
        strftime({ts}, '%m') AS month,
        '{table}/year=' || strftime({ts}, '%Y') || '/month=' || strftime({ts}, '%m') AS partition,
        count(*) AS records FROM s_{table} GROUP BY ALL"""


sql("export_manifest", _manifest("orders", "order_purchase_timestamp"))
sql("export_summary", f"""SELECT table_name, CAST(sum(records) AS BIGINT) AS records,
    count(*) AS partitions FROM ({_manifest("orders", "order_purchase_timestamp")} UNION ALL
    {_manifest("order_reviews", "review_creation_date")} UNION ALL
    {_manifest("order_items", "shipping_limit_date")}) GROUP BY table_name""")
sql("incremental_merge", """SELECT order_id,
    CASE WHEN order_id % 3 = 0 THEN 'canceled' WHEN order_id % 5 = 0 THEN 'zz tied'
         ELSE order_status END AS order_status,
    CASE WHEN order_id % 3 = 0 THEN order_purchase_timestamp + INTERVAL 1 DAY
         ELSE order_purchase_timestamp END AS order_purchase_timestamp FROM s_orders
    UNION ALL
    SELECT -1 - order_id, 'canceled', order_purchase_timestamp + INTERVAL 1 DAY FROM s_orders
    WHERE order_id % 3 = 0""")

# --- projections and filters ----------------------------------------------------------------

sql("fill_defaults", """SELECT product_id,
    coalesce(product_description_lenght, 0) AS product_description_lenght,
    coalesce(product_photos_qty, 0) AS product_photos_qty FROM b_products""")
sql("product_volume", "SELECT product_id, product_volume_cm3 FROM s_products")
sql("item_total_value", "SELECT order_id, order_item_id, item_total_value FROM s_order_items")
sql("presence_flags", "SELECT product_id, has_category, has_dimensions FROM s_products")
sql("threshold_flags", "SELECT product_id, product_photos_qty > 0 AS has_photos FROM b_products")
sql("equals_flags", """SELECT order_id, payment_sequential,
    lower(trim(payment_type)) = 'credit_card' AS is_credit_card FROM b_order_payments""")
IN_BOX = "geolocation_lat BETWEEN -33 AND 5 AND geolocation_lng BETWEEN -74 AND -34"
sql("bbox_flag", f"""SELECT geolocation_zip_code_prefix, {IN_BOX} AS inside, count(*) AS readings
    FROM b_geolocation GROUP BY ALL""")
sql("bbox_filter", f"SELECT * FROM b_geolocation WHERE {IN_BOX}")
DAYS = "CAST(extract(DAY FROM ({} - {})) AS INT)"
BOUGHT, DONE, DUE = ("order_purchase_timestamp", "order_delivered_customer_date",
                     "order_estimated_delivery_date")
sql("delivery_times", f"""SELECT order_id, {BOUGHT}, {DONE},
    {DAYS.format(DONE, BOUGHT)} AS delivery_days, {DAYS.format(DUE, BOUGHT)} AS estimated_days
    FROM b_orders WHERE {DONE} IS NOT NULL""")
sql("late_orders", f"""SELECT order_id, {DONE}, {DUE}, {DAYS.format(DONE, DUE)} AS delay_days
    FROM b_orders WHERE {DONE} > {DUE}""")
sql("overweight_products", "SELECT * FROM b_products WHERE product_weight_g > 10000")
NEGATIVE = """SELECT review_id, order_id, review_score, review_comment_title, review_comment_message
    FROM b_order_reviews WHERE review_score <= 2 AND review_comment_message IS NOT NULL"""
sql("all_negative_reviews", NEGATIVE)
sql("negative_reviews", NEGATIVE + " ORDER BY review_id LIMIT 10")

# --- deduplication --------------------------------------------------------------------------

sql("dedupe_keep_first", """SELECT order_id, order_item_id, product_id, seller_id,
    shipping_limit_date FROM (SELECT *, row_number() OVER (PARTITION BY order_id, order_item_id
        ORDER BY shipping_limit_date DESC, product_id, seller_id, _price, _quantity) AS nr
    FROM b_raw_items) WHERE nr = 1""")
sql("duplicate_count", """SELECT count(*) AS total_records,
    count(DISTINCT (order_id, order_item_id)) AS unique_keys,
    count(*) - count(DISTINCT (order_id, order_item_id)) AS duplicates FROM b_raw_items""")
sql("distinct_rows", "SELECT DISTINCT product_id, seller_id FROM b_raw_items")
sql("distinct_on", """SELECT DISTINCT ON (user_id) user_id, event_id, event_type, ts, value
    FROM events ORDER BY user_id, ts DESC, event_id""")
sql("geo_consolidate", """WITH readings AS (
        SELECT geolocation_zip_code_prefix, round(geolocation_lat, 6) AS geolocation_lat,
               round(geolocation_lng, 6) AS geolocation_lng, count(*) AS n,
               min(geolocation_city) AS geolocation_city, min(geolocation_state) AS geolocation_state
        FROM b_geolocation GROUP BY 1, 2, 3)
    SELECT * EXCLUDE (n) FROM readings QUALIFY row_number() OVER (
        PARTITION BY geolocation_zip_code_prefix
        ORDER BY n DESC, geolocation_lat, geolocation_lng) = 1""")
sql("original_count", """SELECT order_id, order_item_id, count(*) AS original_count
    FROM b_raw_items GROUP BY ALL""")


def _reduction(bronze: str, silver: str, key: str) -> str:
    return f"""SELECT *, {pct('bronze_records - silver_records', 'bronze_records')} AS reduction_pct
    FROM (SELECT count(*) AS bronze_records, count(DISTINCT {key}) AS bronze_unique_keys FROM {bronze}),
         (SELECT count(*) AS silver_records, count(DISTINCT {key}) AS silver_unique_keys FROM {silver})"""


sql("dedup_report", _reduction("b_geolocation", "s_geolocation", "geolocation_zip_code_prefix"))
sql("dedup_report_items", _reduction("b_raw_items", "s_order_items", "order_id"))
sql("dedup_profile", f"""WITH counted AS (SELECT count(*) AS n FROM b_raw_items
        GROUP BY order_id, order_item_id)
    SELECT {mean('n')} AS avg_duplicates, max(n) AS max_duplicates,
           {hits('n > 1')} AS keys_with_duplicates FROM counted""")

# --- joins ----------------------------------------------------------------------------------

sql("enrich_geolocation", """SELECT b_sellers.*, coalesce(lat, 0) AS geolocation_lat,
    coalesce(lng, 0) AS geolocation_lng, lat IS NOT NULL AS has_geolocation
    FROM b_sellers LEFT JOIN geo_point ON seller_zip_code_prefix = zip""")
sql("customer_coordinates", """SELECT customer_id, customer_city, customer_state, geolocation_lat,
    geolocation_lng FROM b_customers
    LEFT JOIN s_geolocation ON customer_zip_code_prefix = geolocation_zip_code_prefix""")
sql("fk_orphans", """SELECT count(*) AS orphans FROM b_order_reviews r
    LEFT JOIN (SELECT order_id FROM b_orders WHERE lower(trim(order_status)) = 'delivered') o
    ON r.order_id = o.order_id WHERE o.order_id IS NULL""")
sql("fk_report", " UNION ALL ".join(f"""SELECT '{c}.{fk} -> {p}' AS fk, count(*) AS orphans,
    CASE WHEN count(*) = 0 THEN 'OK' ELSE 'FAIL' END AS status
    FROM b_{c} c LEFT JOIN b_{p} p ON c.{fk} = p.{pk} WHERE p.{pk} IS NULL"""
                                for c, fk, p, pk in FOREIGN_KEYS))
sql("order_item_product_path", """SELECT c.customer_id, customer_city, o.order_id, order_status,
    order_item_id, product_category_name, price FROM b_customers c
    JOIN b_orders o ON c.customer_id = o.customer_id
    JOIN b_order_items i ON o.order_id = i.order_id
    JOIN b_products p ON i.product_id = p.product_id""")
sql("seller_reviews", """SELECT s.seller_id, seller_city, i.order_id, review_score,
    review_comment_message FROM b_sellers s JOIN b_order_items i ON s.seller_id = i.seller_id
    JOIN b_order_reviews r ON i.order_id = r.order_id""")
BASKET = """SELECT p1.product_category_name AS category_a, p2.product_category_name AS category_b,
    count(*) AS co_purchase_count FROM b_order_items i1
    JOIN b_order_items i2 ON i1.order_id = i2.order_id AND i1.product_id < i2.product_id
    JOIN b_products p1 ON i1.product_id = p1.product_id
    JOIN b_products p2 ON i2.product_id = p2.product_id GROUP BY 1, 2"""
sql("basket_category_pairs", BASKET)
sql("basket_categories", BASKET + """ HAVING count(*) >= 10
    ORDER BY co_purchase_count DESC, category_a NULLS FIRST, category_b NULLS FIRST LIMIT 20""")
CONSOLIDATED = """SELECT geolocation_zip_code_prefix AS zip, CAST(geolocation_lat AS DOUBLE) AS lat,
    CAST(geolocation_lng AS DOUBLE) AS lng FROM (SELECT *, row_number() OVER (
        PARTITION BY geolocation_zip_code_prefix
        ORDER BY n DESC, geolocation_lat, geolocation_lng) AS nr
    FROM (SELECT geolocation_zip_code_prefix, geolocation_lat, geolocation_lng, count(*) AS n
          FROM b_geolocation GROUP BY 1, 2, 3)) WHERE nr = 1"""
SILVER_POINTS = """SELECT geolocation_zip_code_prefix AS zip, CAST(geolocation_lat AS DOUBLE) AS lat,
    CAST(geolocation_lng AS DOUBLE) AS lng FROM s_geolocation"""


def _distance(points: str, layer: str, where: str = "TRUE") -> str:
    return f"""SELECT o.order_id, i.order_item_id, i.seller_id, round(6371 * acos(greatest(-1.0,
        least(1.0, cos(radians(cg.lat)) * cos(radians(sg.lat))
        * cos(radians(sg.lng) - radians(cg.lng)) + sin(radians(cg.lat)) * sin(radians(sg.lat))))),
        3) AS distance_km FROM {layer}_orders o
    JOIN {layer}_customers c ON o.customer_id = c.customer_id
    JOIN ({points}) cg ON cg.zip = c.customer_zip_code_prefix
    JOIN {layer}_order_items i ON i.order_id = o.order_id
    JOIN {layer}_sellers s ON s.seller_id = i.seller_id
    JOIN ({points}) sg ON sg.zip = s.seller_zip_code_prefix WHERE {where}"""


sql("customer_seller_distance", _distance(CONSOLIDATED, "b"))

# --- aggregations ---------------------------------------------------------------------------

PRODUCT_COLS = ["product_id", "product_category_name", "product_name_lenght",
                "product_description_lenght", "product_photos_qty", "product_weight_g",
                "product_length_cm", "product_height_cm", "product_width_cm"]
ITEM_COLS = ["order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date",
             "price", "freight_value"]
ORDER_COLS = ["order_id", "customer_id", "order_status", BOUGHT, "order_approved_at",
              "order_delivered_carrier_date", DONE, DUE]


def _nulls(cols: list[str]) -> str:
    return ", ".join(f"{hits(f'{c} IS NULL')} AS null_{c}" for c in cols)


sql("profile", f"""SELECT count(*) AS total_records, count(DISTINCT product_id) AS unique_pks,
    {_nulls(PRODUCT_COLS)} FROM b_products""")
sql("profile_items", f"""SELECT count(*) AS total_records,
    count(DISTINCT (order_id, order_item_id)) AS unique_pks, {_nulls(ITEM_COLS)}
    FROM b_order_items""")
sql("composite_distinct", """SELECT count(*) AS unique_keys FROM (
    SELECT DISTINCT order_id, order_item_id FROM b_raw_items)""")


def _distinct(**cols: str) -> str:
    return ", ".join(f"count(DISTINCT {c}) AS {a}" for a, c in cols.items())


SUMMARIES = {
    "customers": _distinct(unique_customers="customer_id",
                           unique_customer_unique_ids="customer_unique_id",
                           unique_states="customer_state")
    + f", {hits('customer_id IS NULL')} AS null_pks",
    "sellers": _distinct(unique_sellers="seller_id", unique_states="seller_state",
                         unique_cities="seller_city")
    + f""", {hits('seller_id IS NULL')} AS null_pks, {hits('seller_state IS NULL')} AS null_states""",
    "products": _distinct(unique_products="product_id", unique_categories="product_category_name")
    + f""", {hits('product_id IS NULL')} AS null_pks,
        {hits('product_category_name IS NULL')} AS null_categories,
        {hits('product_weight_g IS NULL')} AS null_weights,
        {mean('product_weight_g')} AS avg_weight, max(product_weight_g) AS max_weight""",
    "orders": _distinct(unique_orders="order_id", unique_customers="customer_id")
    + f""", {hits('order_id IS NULL')} AS null_pks, {hits('customer_id IS NULL')} AS null_fks,
        {hits("lower(trim(order_status)) = 'delivered'")} AS delivered_orders,
        {hits(f'{DONE} IS NULL')} AS null_delivery_dates""",
    "order_items": _distinct(unique_orders="order_id", unique_products="product_id",
                             unique_sellers="seller_id")
    + f""", {mean('price')} AS avg_price, {mean('freight_value')} AS avg_freight,
        max(price) AS max_price, min(price) AS min_price""",
    "order_payments": _distinct(unique_orders="order_id", unique_payment_types="payment_type")
    + f""", {mean('payment_value')} AS avg_payment, sum(payment_value) AS total_payment,
        {mean('payment_installments')} AS avg_installments,
        max(payment_installments) AS max_installments""",
    "order_reviews": _distinct(unique_reviews="review_id", unique_orders="order_id")
    + f""", {mean('review_score')} AS avg_score,
        count(review_comment_title) AS reviews_with_title,
        count(review_comment_message) AS reviews_with_message""",
    "geolocation": _distinct(unique_zips="geolocation_zip_code_prefix",
                             unique_states="geolocation_state", unique_cities="geolocation_city"),
}
for _t, _m in SUMMARIES.items():
    sql(f"bronze_summary_{_t}", f"SELECT count(*) AS total_records, {_m} FROM b_{_t}")


def _distribution(table: str, col: str, more: str = "") -> str:
    return f"""SELECT *, {pct('total', 'whole')} AS percentage FROM (
        SELECT {col}, count(*) AS total {more} FROM {table} GROUP BY {col}),
        (SELECT count(*) AS whole FROM {table})""".replace("SELECT *,", "SELECT * EXCLUDE (whole),")


sql("status_distribution", _distribution("s_orders", "order_status"))
sql("score_distribution", _distribution("b_order_reviews", "review_score"))
sql("payment_distribution", _distribution("s_order_payments", "payment_type", f""",
    sum(payment_value) AS total_value, {mean('payment_value')} AS avg_value,
    {mean('payment_installments')} AS avg_installments"""))
sql("top_states", f"""SELECT customer_state, count(*) AS total, {hits('has_geolocation')} AS with_geo
    FROM s_customers GROUP BY 1 ORDER BY total DESC, customer_state LIMIT 5""")
sql("top_product_categories", """SELECT product_category_name, count(*) AS total FROM s_products
    WHERE has_category GROUP BY 1 ORDER BY total DESC, 1 LIMIT 5""")
sql("multi_payment_summary", f"""SELECT count(*) AS total_orders,
    {hits('n > 1')} AS orders_multiple_payments, max(n) AS max_payments_per_order
    FROM (SELECT order_id, count(*) AS n FROM s_order_payments GROUP BY 1)""")
sql("geo_enrichment_summary", f"""SELECT count(*) AS total, {hits('has_geolocation')} AS with_geo,
    {hits('NOT has_geolocation')} AS without_geo,
    {pct(hits('has_geolocation'), 'count(*)')} AS geo_enrichment_pct,
    min(geolocation_lat) AS min_lat, max(geolocation_lat) AS max_lat,
    min(geolocation_lng) AS min_lng, max(geolocation_lng) AS max_lng FROM s_customers""")


def _rates(table: str, flags: list[str], more: str = "") -> str:
    cols = ", ".join(f"{hits(f)} AS {f}_count, {pct(hits(f), 'count(*)')} AS {f}_pct" for f in flags)
    return f"SELECT count(*) AS total, {cols} {more} FROM {table}"


sql("order_flag_rates", _rates("s_orders", ["is_approved", "is_shipped", "is_delivered"]))
sql("product_flag_rates", _rates(
    "s_products", ["has_category", "has_weight", "has_dimensions", "has_photos"],
    """, count(product_volume_cm3) AS with_volume,
    count(DISTINCT product_category_name) AS unique_categories"""))
sql("item_flag_rates", _rates("s_order_items", ["has_price", "has_freight"], f""",
    {mean('price')} AS avg_price, min(price) AS min_price, max(price) AS max_price,
    {mean('freight_value')} AS avg_freight, {mean('item_total_value')} AS avg_item_total"""))
sql("payment_flag_rates", _rates(
    "s_order_payments", ["has_value", "is_installment", "is_credit_card", "is_boleto"], f""",
    {mean('payment_value')} AS avg_value, min(payment_value) AS min_value,
    max(payment_value) AS max_value, {mean('payment_installments')} AS avg_installments,
    max(payment_installments) AS max_installments"""))
sql("review_flag_rates", _rates(
    "s_order_reviews", ["has_comment_title", "has_comment_message", "has_answer",
                        "is_positive_score", "is_negative_score"], f""",
    {hits('NOT is_positive_score AND NOT is_negative_score')} AS neutral,
    {mean('comment_length', 'comment_length > 0')} AS avg_comment_length,
    max(comment_length) AS max_comment_length"""))
sql("avg_positive", f"""SELECT {mean('product_weight_g', 'product_weight_g > 0')}
    AS avg_product_weight_g, {mean('product_volume_cm3', 'product_volume_cm3 > 0')}
    AS avg_product_volume_cm3 FROM s_products""")
sql("items_per_position", """SELECT order_item_id, count(*) AS total_orders FROM s_order_items
    GROUP BY 1 ORDER BY 1 LIMIT 10""")
sql("fk_cardinality", "SELECT " + _distinct(
    unique_orders="order_id", unique_products="product_id", unique_sellers="seller_id")
    + " FROM s_order_items")
sql("csv_statistics", f"""SELECT payment_type, count(*) AS total,
    {mean('payment_value')} AS mean_value, sum(payment_value) AS sum_value
    FROM b_order_payments GROUP BY 1""")
sql("item_statistics", f"""SELECT count(*) AS total, {mean('price')} AS mean_price,
    {mean('freight_value')} AS mean_freight_value, count(*) - count(order_id) AS null_order_id,
    count(*) - count(product_id) AS null_product_id, count(*) - count(seller_id) AS null_seller_id,
    count(*) - count(price) AS null_price, count(*) - count(freight_value) AS null_freight_value,
    count(DISTINCT order_id) AS unique_orders, count(DISTINCT product_id) AS unique_products,
    count(DISTINCT seller_id) AS unique_sellers FROM b_order_items""")
sql("review_statistics", """SELECT review_score, count(*) AS total,
    count(review_comment_title) AS with_title, count(review_comment_message) AS with_message
    FROM b_order_reviews GROUP BY 1""")
sql("repeat_customers", """SELECT customer_unique_id, count(DISTINCT customer_id) AS num_orders
    FROM b_customers GROUP BY 1 HAVING count(DISTINCT customer_id) > 1""")
TOTALS = "SELECT order_id, sum(price + freight_value) AS total FROM b_order_items GROUP BY 1"
sql("order_totals", TOTALS)
sql("average_ticket", f"SELECT {mean('total')} AS avg_ticket FROM ({TOTALS})")
sql("multi_item_orders", """SELECT order_id, count(*) AS num_items, sum(price) AS total_price,
    sum(freight_value) AS total_freight FROM b_order_items GROUP BY 1 HAVING count(*) > 1""")
sql("payment_types_per_order", """SELECT order_id, count(*) AS num_payments,
    string_agg(payment_type, ', ' ORDER BY payment_type) AS payment_types,
    sum(payment_value) AS total_value FROM s_order_payments GROUP BY 1 HAVING count(*) > 1""")
sql("distinct_payment_types_per_order", """SELECT order_id, count(*) AS num_payments,
    string_agg(DISTINCT payment_type, ', ' ORDER BY payment_type) AS payment_types,
    sum(payment_value) AS total_value FROM s_order_payments GROUP BY 1""")
ANSWERED = "count(review_answer_timestamp)"
sql("review_answer_rate", f"""SELECT {ANSWERED} AS answered, count(*) AS total,
    {pct(ANSWERED, 'count(*)')} AS answer_rate FROM b_order_reviews""")
sql("nps", f"SELECT count(review_score) AS answers, {NPS} AS nps FROM b_order_reviews")
MONTH = "CAST(date_trunc('month', {}) AS TIMESTAMP)"
sql("nps_by_month", f"""SELECT {MONTH.format('review_creation_date')} AS month,
    count(review_score) AS answers, {NPS} AS nps FROM b_order_reviews GROUP BY 1""")
sql("delivery_sla_monthly", f"""SELECT {MONTH.format(BOUGHT)} AS month, count(*) AS total_orders,
    count({DONE}) AS delivered_orders, {mean(DAYS.format(DONE, BOUGHT))} AS avg_delivery_days,
    {mean(DAYS.format(DUE, BOUGHT))} AS avg_estimated_days,
    {hits(f'{DONE} > {DUE}')} AS late_deliveries,
    {pct(hits(f'{DONE} > {DUE}'), f'count({DONE})')} AS late_delivery_rate
    FROM b_orders WHERE lower(trim(order_status)) = 'delivered' GROUP BY 1""")
sql("top_sellers", """SELECT s.seller_id, seller_city, seller_state, count(order_id) AS total_sales,
    sum(price) AS revenue FROM b_sellers s JOIN b_order_items i ON s.seller_id = i.seller_id
    GROUP BY ALL ORDER BY revenue DESC, s.seller_id LIMIT 10""")
sql("top_categories", f"""SELECT product_category_name, count(order_id) AS total_sales,
    sum(price) AS revenue, {mean('price')} AS avg_price
    FROM b_products p JOIN b_order_items i ON p.product_id = i.product_id GROUP BY 1
    ORDER BY revenue DESC, 1 LIMIT 10""")
sql("top_categories_delivered", """SELECT product_category_name,
    count(DISTINCT i.order_id) AS total_orders, sum(price) AS revenue
    FROM b_products p JOIN b_order_items i ON p.product_id = i.product_id
    JOIN b_orders o ON i.order_id = o.order_id WHERE lower(trim(order_status)) = 'delivered'
    GROUP BY 1 ORDER BY revenue DESC, 1 LIMIT 10""")
sql("sales_by_state", """SELECT customer_state, count(DISTINCT o.order_id) AS orders,
    sum(price + freight_value) AS revenue FROM b_customers c
    JOIN b_orders o ON c.customer_id = o.customer_id JOIN b_order_items i ON o.order_id = i.order_id
    WHERE lower(trim(order_status)) = 'delivered' GROUP BY 1""")
sql("seller_performance", f"""SELECT s.seller_id, seller_city, seller_state,
    count(DISTINCT i.order_id) AS num_orders, count(i.order_item_id) AS num_items,
    sum(price) AS total_revenue, {mean('price')} AS avg_item_price,
    {mean('review_score')} AS avg_review_score, {hits('review_score <= 2')} AS negative_reviews
    FROM b_sellers s JOIN b_order_items i ON s.seller_id = i.seller_id
    LEFT JOIN b_order_reviews r ON i.order_id = r.order_id
    GROUP BY ALL HAVING count(DISTINCT i.order_id) >= 10""")

# --- windows, order, sets -------------------------------------------------------------------


def _rfm(orders: str, customer: str) -> str:
    return f"""WITH base AS (SELECT {customer}, max({BOUGHT}) AS last_purchase,
            count(DISTINCT o.order_id) AS frequency, sum(price + freight_value) AS monetary
        FROM {orders} o JOIN s_order_items i ON o.order_id = i.order_id GROUP BY 1),
    days AS (SELECT *, CAST(DATE '2001-12-31' - CAST(last_purchase AS DATE) AS INT)
             AS recency_days FROM base),
    scored AS (SELECT {customer}, recency_days, frequency, monetary,
        CAST(ntile(5) OVER (ORDER BY recency_days DESC, {customer}) AS INT) AS r_score,
        CAST(ntile(5) OVER (ORDER BY frequency, {customer}) AS INT) AS f_score,
        CAST(ntile(5) OVER (ORDER BY monetary, {customer}) AS INT) AS m_score FROM days),
    coded AS (SELECT *, concat(r_score, f_score, m_score) AS rfm_score FROM scored)
    """


SEGMENT = "CASE " + " ".join(
    f"WHEN rfm_score IN ({', '.join(repr(c) for c in codes)}) THEN '{name}'"
    for name, codes in SEGMENTS.items()) + " ELSE 'Others' END"
UNIQUE_ORDERS = """(SELECT o.*, customer_unique_id FROM s_orders o JOIN s_customers c
    ON o.customer_id = c.customer_id)"""
sql("rfm_scores", _rfm("s_orders", "customer_id") + "SELECT * FROM scored")
sql("rfm_segments", _rfm(UNIQUE_ORDERS, "customer_unique_id")
    + f"SELECT *, {SEGMENT} AS segment FROM coded")
sql("global_row_numbers", """SELECT *, row_number() OVER (ORDER BY l_partkey, l_suppkey) AS row_number,
    CAST(sum(lines) OVER (ORDER BY l_partkey, l_suppkey) AS BIGINT) AS running_lines
    FROM (SELECT l_partkey, l_suppkey, count(*) AS lines FROM lineitem GROUP BY ALL)""")
sql("quantiles", """SELECT share, round(quantile, 4) AS quantile FROM (SELECT
    unnest([0.1, 0.5, 0.95])::DOUBLE AS share,
    unnest(quantile_cont(price::DOUBLE, [0.1, 0.5, 0.95])) AS quantile FROM b_order_items)""")
HISTORY = f"""WITH asked AS (SELECT DISTINCT seller_id, {BOUGHT} FROM g_seller_orders),
    delivered AS (SELECT seller_id, {DONE} AS seen, delay_days, is_late FROM g_seller_orders
                  WHERE {DONE} IS NOT NULL),
    past AS (SELECT a.seller_id, a.{BOUGHT}, count(seen) AS deliveries_before,
        CAST(sum(delay_days) AS DOUBLE) / nullif(count(seen), 0) AS avg_delay_history,
        CAST({hits('is_late')} * 100 AS DOUBLE) / nullif(count(seen), 0) AS delay_rate_history
        FROM asked a LEFT JOIN delivered d ON d.seller_id = a.seller_id AND d.seen < a.{BOUGHT}
        GROUP BY 1, 2),
    scored AS (SELECT s.seller_id, review_creation_date AS seen, r.review_score
               FROM g_seller_orders s JOIN s_order_reviews r ON r.order_id = s.order_id),
    rated AS (SELECT a.seller_id, a.{BOUGHT}, {mean('review_score')} AS avg_review_history
        FROM asked a LEFT JOIN scored s ON s.seller_id = a.seller_id AND s.seen < a.{BOUGHT}
        GROUP BY 1, 2),
    history AS (SELECT p.*, avg_review_history,
        CASE WHEN delay_rate_history < 10 THEN 'GOLD' WHEN delay_rate_history < 30 THEN 'SILVER'
             WHEN delay_rate_history >= 30 THEN 'BRONZE' END AS seller_tier
        FROM past p JOIN rated r ON p.seller_id = r.seller_id AND p.{BOUGHT} = r.{BOUGHT})
    """
sql("seller_history_features", HISTORY + "SELECT * FROM history")
sql("top_orders", """SELECT o_orderkey, o_totalprice FROM orders
    ORDER BY o_totalprice DESC, o_orderkey LIMIT 100""")
sql("union_metrics", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM b_{t}" for t in PRIMARY_KEYS))

# --- checks ---------------------------------------------------------------------------------

sql("check_row_counts", "SELECT *, CASE WHEN abs(diff_pct) > 5 THEN 'ERROR' "
    "WHEN abs(diff_pct) >= 1 THEN 'WARNING' ELSE 'OK' END AS status FROM (SELECT *, "
    "CAST(diff * 100 AS DOUBLE) / expected AS diff_pct FROM ("
    + " UNION ALL ".join(f"""SELECT '{t}' AS table_name, CAST({n} AS BIGINT) AS expected,
    count(*) AS actual, count(*) - {n} AS diff FROM b_{t}""" for t, n in EXPECTED_ROWS.items()) + "))")
sql("null_counts", f"SELECT {_nulls(ORDER_COLS)} FROM b_orders")
sql("range_check", f"""SELECT count(*) AS total,
    {hits('review_score NOT BETWEEN 1 AND 5')} AS out_of_range FROM s_order_reviews""")
sql("check_timestamp_order", "SELECT " + ", ".join(
    f"{hits(f'{b} < {a}')} AS {b}_before_{a}" for a, b in
    [(BOUGHT, "order_approved_at"), ("order_delivered_carrier_date", DONE), (DUE, DONE)])
    + " FROM b_orders")
sql("check_sequence", f"""SELECT count(*) AS groups, {hits('a <> 1')} AS not_from_one,
    {hits('b - a + 1 <> n')} AS with_gap FROM (SELECT order_id, min(order_item_id) AS a,
    max(order_item_id) AS b, count(DISTINCT order_item_id) AS n FROM b_order_items GROUP BY 1)""")

VOLUMES = """SELECT *, CAST(silver_records * 100 AS DOUBLE) / nullif(bronze_records, 0)
        AS completeness_pct, CASE WHEN silver_records = bronze_records THEN 'OK'
        WHEN silver_records >= bronze_records * 0.99 THEN 'WARNING' ELSE 'ERROR' END
        AS volumetry_status
    FROM (SELECT count(*) AS bronze_records FROM b_{0}), (SELECT count(*) AS silver_records FROM s_{0})"""
for _t, _keys in PRIMARY_KEYS.items():
    key = _keys[0] if len(_keys) == 1 else f"({', '.join(_keys)})"
    state = f"CASE WHEN count(*) = count(DISTINCT {key}) THEN 'OK' ELSE 'ERROR' END AS pk_integrity"
    sql(f"silver_{_t}", f"SELECT * FROM s_{_t}")
    sql(f"volumetry_{_t}", VOLUMES.format(_t))
    sql(f"key_integrity_{_t}", f"""SELECT count(*) AS total_records,
        count(DISTINCT {key}) AS unique_pks, {_nulls(_keys)}, {state} FROM s_{_t}""")
    sql(f"run_result_{_t}", f"""SELECT '{_t}' AS table_name, CASE WHEN volumetry_status <> 'ERROR'
        AND pk_integrity = 'OK' THEN 'success' ELSE 'failed' END AS status, bronze_records,
        silver_records, completeness_pct FROM ({VOLUMES.format(_t)}),
        (SELECT {state} FROM s_{_t})""")
sql("audit_check", """SELECT count(*) AS total, CAST(0 AS BIGINT) AS null_processed_at,
    CAST(0 AS BIGINT) AS null_updated_at, CAST(0 AS BIGINT) AS null_created_at,
    TIMESTAMP '2002-01-01 00:00:00' AS min_processed_at,
    TIMESTAMP '2002-01-01 00:00:00' AS max_processed_at FROM s_orders""")
sql("case_check", f"""SELECT count(*) AS total, {hits('''order_status = upper(order_status)
    AND order_status <> lower(order_status)''')} AS wrong_case FROM b_orders""")
sql("case_check_silver", f"""SELECT count(*) AS total, {hits('''seller_state = lower(seller_state)
    AND seller_state <> upper(seller_state)''')} AS wrong_case FROM s_sellers""")
sql("derived_sum_check", f"""SELECT count(*) AS total,
    {hits('item_total_value <> price + freight_value')} AS calc_errors FROM s_order_items""")
sql("geo_check", f"""SELECT *, CASE WHEN total = valid_coords AND total = unique_zips THEN 'OK'
    ELSE 'ERROR' END AS status FROM (SELECT count(*) AS total,
    {hits('is_valid_brazil_coords')} AS valid_coords,
    count(DISTINCT geolocation_zip_code_prefix) AS unique_zips FROM s_geolocation)""")
sql("not_null_check", f"SELECT {_nulls([BOUGHT])} FROM s_orders")

# --- contracts ------------------------------------------------------------------------------

for _t, _suite in BRONZE_SUITES.items():
    sql(f"bronze_suite_{_t}", suite_sql("bronze", _t, _suite))
for _t, _suite in SILVER_SUITES.items():
    sql(f"silver_suite_{_t}", suite_sql("silver", _t, _suite))
sql("suite_statistics", statistics_sql("silver", "customers", SILVER_SUITES["customers"]))
sql("suite_failures", failures_sql())
sql("suite_summary", f"""SELECT count(*) AS tables, CAST(sum(evaluated) AS BIGINT) AS evaluated,
    CAST(sum(successful) AS BIGINT) AS successful, CAST(sum(unsuccessful) AS BIGINT) AS unsuccessful,
    {pct('sum(successful)', 'sum(evaluated)')} AS success_percent FROM ("""
    + " UNION ALL ".join(statistics_sql("silver", t, s) for t, s in SILVER_SUITES.items()) + ")")
sql("top_failures", f"""SELECT suite, expectation_type, column_name, count(*) AS failures
    FROM ({checkpoints_sql()}) WHERE NOT success GROUP BY ALL
    ORDER BY failures DESC, suite, expectation_type, column_name NULLS FIRST LIMIT 5""")
sql("success_trend", f"""SELECT run_id, run_at, count(*) AS evaluated, {hits('success')} AS successful,
    {pct(hits('success'), 'count(*)')} AS success_percent FROM ({checkpoints_sql()}) GROUP BY 1, 2""")

# --- observability --------------------------------------------------------------------------

FRESH = """SELECT *, CASE WHEN minutes_ago < 60 THEN 'GREEN' WHEN minutes_ago < 1440 THEN 'YELLOW'
        WHEN minutes_ago >= 1440 THEN 'RED' END AS status
    FROM (SELECT *, CAST((date_sub('second', last_update, TIMESTAMP '2024-02-01') * 20 + 60) // 120
                         AS DOUBLE) / 10 AS minutes_ago
    FROM (SELECT 'Bronze' AS layer, 'events' AS table_name, max(ts) AS last_update,
                 count(*) AS row_count FROM events
          UNION ALL SELECT 'Bronze', 'orders', max(o_orderdate), count(*) FROM orders
          UNION ALL SELECT 'Silver', 'reviews', max(review_creation_date), count(*)
          FROM s_order_reviews))"""
sql("freshness", FRESH)
sql("stale_tables", FRESH + " WHERE minutes_ago > 1440")


def _statistics(table: str, source: str, cols: list[str]) -> str:
    parts = []
    for c in cols:
        for metric, value in {
                "min": f"CAST(min({c}) AS DOUBLE)", "max": f"CAST(max({c}) AS DOUBLE)",
                "mean": mean(c), "stddev": f"round(stddev_samp({c}), 4)",
                "median": f"quantile_cont(CAST({c} AS DOUBLE), 0.5)",
                "p95": f"quantile_cont(CAST({c} AS DOUBLE), 0.95)"}.items():
            parts.append(f"""SELECT TIMESTAMP '2001-12-31' AS captured_at, '{table}' AS table_name,
                '{c}' AS column_name, '{metric}' AS metric_name, {value} AS metric_value,
                count({c}) AS row_count FROM {source}""")
    return " UNION ALL ".join(parts)


BASE, CUR = (f"(SELECT * FROM g_metrics WHERE {BOUGHT} {op} TIMESTAMP '1998-04-01')"
             for op in ("<", ">="))
sql("column_statistics", _statistics("order_items", "s_order_items", ["price", "freight_value"]))
sql("statistic_drift", f"""SELECT *, CASE WHEN abs(raw) > 50 THEN 'CRITICAL'
        WHEN abs(raw) > 20 THEN 'WARNING' WHEN raw IS NOT NULL THEN 'OK' END AS status
    FROM (SELECT b.table_name, b.column_name, b.metric_name, b.metric_value AS baseline_value,
        c.metric_value AS current_value,
        (c.metric_value - b.metric_value) * 100 / nullif(b.metric_value, 0) AS raw,
        round((c.metric_value - b.metric_value) * 100 / nullif(b.metric_value, 0), 4) AS drift_pct
    FROM ({_statistics('orders', BASE, ['total_items', 'delivery_days'])}) b
    JOIN ({_statistics('orders', CUR, ['total_items', 'delivery_days'])}) c
    USING (table_name, column_name, metric_name))""".replace("SELECT *, CASE WHEN abs(raw)",
                                                            "SELECT * EXCLUDE (raw), CASE WHEN abs(raw)"))
sql("share_drift", f"""WITH b AS (SELECT order_status AS category, count(*) AS n FROM {BASE} GROUP BY 1),
    c AS (SELECT order_status AS category, count(*) AS n FROM {CUR} GROUP BY 1),
    shares AS (SELECT coalesce(b.category, c.category) AS category,
        CAST(coalesce(b.n, 0) * 100 AS DOUBLE) / CAST((SELECT sum(n) FROM b) AS DOUBLE) AS baseline_pct,
        CAST(coalesce(c.n, 0) * 100 AS DOUBLE) / CAST((SELECT sum(n) FROM c) AS DOUBLE) AS current_pct
        FROM b FULL JOIN c ON b.category = c.category)
    SELECT *, current_pct - baseline_pct AS drift_points FROM shares""")
sql("psi", f"""WITH base AS (SELECT total_items_value AS x FROM {BASE}),
    cur AS (SELECT total_items_value AS x FROM {CUR}),
    ranked AS (SELECT x, row_number() OVER (ORDER BY x) AS nr, count(*) OVER () AS n FROM base),
    edges AS (SELECT x FROM ranked JOIN range(1, 10) AS r(i)
              ON nr = CAST(ceil(i * n / 10.0) AS BIGINT)),
    tagged AS (SELECT (SELECT count(*) FROM edges e WHERE e.x < t.x) AS bin, side FROM
        (SELECT x, 'b' AS side FROM base UNION ALL SELECT x, 'c' FROM cur) t),
    bins AS (SELECT bin, {hits("side = 'b'")} AS b, {hits("side = 'c'")} AS c FROM tagged GROUP BY 1),
    shares AS (SELECT greatest(b / CAST((SELECT sum(b) FROM bins) AS DOUBLE), 0.0001) AS p,
                      greatest(c / CAST((SELECT sum(c) FROM bins) AS DOUBLE), 0.0001) AS q FROM bins)
    SELECT 'total_items_value' AS column_name, round(sum((q - p) * ln(q / p)), 6) AS psi FROM shares""")


def _ks(col: str) -> str:
    return f"""SELECT '{col}' AS feature, 'ks' AS test,
        round(max(abs(cb / CAST(nb AS DOUBLE) - cc / CAST(nc AS DOUBLE))), 6) AS statistic,
        round(max(1.36 * sqrt((nb + nc) / (CAST(nb AS DOUBLE) * nc))), 6) AS threshold
    FROM (SELECT sum(b) OVER (ORDER BY x) AS cb, sum(c) OVER (ORDER BY x) AS cc,
                 sum(b) OVER () AS nb, sum(c) OVER () AS nc
          FROM (SELECT x, sum(b) AS b, sum(c) AS c FROM (
                SELECT {col} AS x, 1 AS b, 0 AS c FROM {BASE} UNION ALL
                SELECT {col}, 0, 1 FROM {CUR}) WHERE x IS NOT NULL GROUP BY 1))"""


def _chi(col: str, limit: float) -> str:
    expected = "(b + c) * {0} / CAST(nb + nc AS DOUBLE)"
    terms = " + ".join(f"power({o} - {expected.format(t)}, 2) / ({expected.format(t)})"
                       for o, t in (("b", "nb"), ("c", "nc")))
    return f"""SELECT '{col}' AS feature, 'chi_square' AS test, round(sum({terms}), 4) AS statistic,
        CAST({limit} AS DOUBLE) AS threshold
    FROM (SELECT *, sum(b) OVER () AS nb, sum(c) OVER () AS nc FROM (
          SELECT x, sum(b) AS b, sum(c) AS c FROM (
          SELECT coalesce({col}, '') AS x, 1 AS b, 0 AS c FROM {BASE} UNION ALL
          SELECT coalesce({col}, ''), 0, 1 FROM {CUR}) GROUP BY 1))"""


DRIFT = "SELECT *, statistic > threshold AS drifted FROM (" + " UNION ALL ".join(
    [_ks(c) for c in ("total_items_value", "delivery_days", "total_items")]
    + [_chi("order_status", 5.991), _chi("payment_types", 7.815)]) + ")"
sql("feature_drift", DRIFT)
sql("drift_summary", f"""SELECT *, CASE WHEN drift_share > 50 THEN 'CRITICAL'
    WHEN drift_share > 30 THEN 'WARNING' ELSE 'OK' END AS status FROM (
    SELECT count(*) AS features, {hits('drifted')} AS n_drifted,
    CAST({hits('drifted')} * 100 AS DOUBLE) / count(*) AS drift_share FROM ({DRIFT}))""")
sql("row_count_history", f"""SELECT 'orders' AS table_name, strftime({BOUGHT}, '%Y-%m') AS run_id,
    count(*) AS bronze_rows, count(*) AS silver_rows,
    CAST((count(*) * 20 + 60) // 120 AS DOUBLE) / 10 AS latency_minutes FROM b_orders GROUP BY 2""")
sql("mttr", f"""SELECT ['LOW', 'MEDIUM', 'HIGH'][event_id % 3 + 1] AS severity,
    {hits('event_id % 9 <> 0')} AS resolved, {hits('event_id % 9 = 0')} AS open,
    CAST(sum(event_id % 600 + 1) FILTER (WHERE event_id % 9 <> 0) * 60 AS DOUBLE)
    / CAST(nullif({hits('event_id % 9 <> 0')}, 0) * 60 AS DOUBLE) AS mttr_minutes
    FROM events WHERE event_type = 'error' GROUP BY 1""")

# --- gold -----------------------------------------------------------------------------------

sql("dim_date", f"""SELECT {day_key('d')} AS date_sk, CAST(d AS TIMESTAMP) AS date,
    CAST(year(d) AS INT) AS year, CAST(quarter(d) AS INT) AS quarter, CAST(month(d) AS INT) AS month,
    monthname(d) AS month_name, CAST(weekofyear(d) AS INT) AS week_of_year,
    CAST(day(d) AS INT) AS day_of_month, CAST(isodow(d) AS INT) AS day_of_week,
    dayname(d) AS day_name, isodow(d) >= 6 AS is_weekend,
    CAST(d AS DATE) IN (SELECT day FROM b_holidays) AS is_holiday
    FROM (SELECT unnest(generate_series(min({BOUGHT}), max({DUE}), INTERVAL 1 DAY)) AS d
          FROM b_orders)""")
ACTIVE = "coalesce(CAST({} AS DATE) >= DATE '2001-12-31' - INTERVAL 6 MONTH, FALSE)"
sql("dim_customers", _rfm("s_orders", "customer_id") + f"""SELECT
    {md5_of('g.customer_id')} AS customer_sk, g.customer_id, customer_unique_id, customer_city,
    customer_state, region AS customer_region, customer_city = (SELECT min(c.customer_city)
        FROM b_customers c WHERE c.customer_state = g.customer_state) AS is_capital,
    geolocation_lat AS customer_lat, geolocation_lng AS customer_lng, first_order_date, last_order_date, total_orders, total_spent, avg_order_value,
    avg_review_score, recency_days AS recency, frequency, monetary, rfm_score,
    CASE WHEN rfm_score IS NOT NULL THEN {SEGMENT} END AS customer_segment,
    {ACTIVE.format('last_order_date')} AS is_active, TIMESTAMP '2001-01-01' AS effective_from,
    CAST(NULL AS TIMESTAMP) AS effective_to, TRUE AS is_current
    FROM g_customers g LEFT JOIN coded ON coded.customer_id = g.customer_id
    LEFT JOIN state_regions ON state = customer_state""")
CUSTOMER_HISTORY = """WITH now AS (SELECT customer_id, CASE WHEN customer_id % 4 = 0
            THEN lower(customer_city) ELSE customer_city END AS customer_city, customer_state
        FROM b_customers WHERE customer_id % 10 <> 7),
    old AS (SELECT customer_id, customer_city, customer_state FROM b_customers
            WHERE customer_id % 10 <> 3),
    both_sides AS (SELECT old.*, now.customer_id AS new_id, now.customer_city AS new_city,
            now.customer_state AS new_state FROM old
        LEFT JOIN now ON now.customer_id = old.customer_id)
    SELECT customer_id, customer_city, customer_state,
        TIMESTAMP '1996-01-01' AS effective_from,
        CASE WHEN new_id IS NULL OR new_city <> customer_city THEN TIMESTAMP '1998-01-01' END
            AS effective_to,
        NOT (new_id IS NULL OR new_city <> customer_city) AS is_current FROM both_sides
    UNION ALL
    SELECT customer_id, new_city, new_state, TIMESTAMP '1998-01-01', NULL, TRUE FROM both_sides
    WHERE new_city <> customer_city
    UNION ALL
    SELECT customer_id, customer_city, customer_state, TIMESTAMP '1998-01-01', NULL, TRUE
    FROM now WHERE customer_id % 10 = 3"""
sql("scd2_merge", CUSTOMER_HISTORY)
# What each day of a customer says, by whom it says most; then days that say nothing new go.
LATE = f"""WITH history AS ({CUSTOMER_HISTORY}),
    late AS (
        SELECT customer_id, TIMESTAMP '1997-03-05' AS day, 2 AS rank, 'late' AS city, customer_state
        FROM b_customers WHERE customer_id % 5 = 0
        UNION ALL SELECT customer_id, TIMESTAMP '1994-02-01', 2, 'early', customer_state
        FROM b_customers WHERE customer_id % 6 = 0
        UNION ALL SELECT customer_id, TIMESTAMP '1998-01-01', 2, 'fixed', customer_state
        FROM b_customers WHERE customer_id % 11 = 0
        UNION ALL SELECT customer_id, TIMESTAMP '1999-05-01', 2, 'after', customer_state
        FROM b_customers WHERE customer_id % 7 = 0
        UNION ALL SELECT customer_id, TIMESTAMP '1997-07-01', 2, customer_city, customer_state
        FROM b_customers WHERE customer_id % 9 = 0),
    told AS (
        SELECT * FROM late
        UNION ALL SELECT customer_id, effective_from, 1, customer_city, customer_state FROM history
        UNION ALL SELECT customer_id, effective_to, 0, NULL, NULL FROM history
        WHERE effective_to IS NOT NULL),
    days AS (SELECT * FROM told
             QUALIFY row_number() OVER (PARTITION BY customer_id, day ORDER BY rank DESC) = 1),
    changes AS (SELECT * FROM days WINDOW w AS (PARTITION BY customer_id ORDER BY day)
                QUALIFY lag(day) OVER w IS NULL OR lag(city) OVER w IS DISTINCT FROM city
                OR lag(customer_state) OVER w IS DISTINCT FROM customer_state)
    SELECT customer_id, city AS customer_city, customer_state, day AS effective_from, until AS effective_to,
           until IS NULL AS is_current
    FROM (SELECT *, lead(day) OVER (PARTITION BY customer_id ORDER BY day) AS until FROM changes)
    WHERE customer_state IS NOT NULL"""
sql("scd2_late_versions", LATE)
sql("scd2_validity", f"""SELECT customer_id, order_status, effective_from,
    lead(effective_from) OVER w AS effective_to, lead(effective_from) OVER w IS NULL AS is_current
    FROM (SELECT customer_id, CAST(CAST({BOUGHT} AS DATE) AS TIMESTAMP) AS effective_from,
          max(order_status) AS order_status FROM s_orders GROUP BY 1, 2)
    WINDOW w AS (PARTITION BY customer_id ORDER BY effective_from)""")
sql("dim_products", f"""SELECT {md5_of('product_id')} AS product_sk, product_id,
    product_category_clean AS product_category, product_weight_g, product_volume_cm3,
    CASE WHEN product_volume_cm3 < 5000 THEN 'SMALL' WHEN product_volume_cm3 < 50000 THEN 'MEDIUM'
         WHEN product_volume_cm3 >= 50000 THEN 'LARGE' END AS size_category,
    total_sales, total_revenue, avg_price, avg_review_score,
    {ACTIVE.format('last_sale')} AS is_active FROM g_products""")
SELLERS = f"""SELECT s.seller_id, seller_city, seller_state, coalesce(total_orders, 0) AS total_orders,
    revenue, avg_delay_days, pct_delayed, avg_review_score,
    CASE WHEN pct_delayed < 10 THEN 'GOLD' WHEN pct_delayed < 30 THEN 'SILVER'
         WHEN pct_delayed >= 30 THEN 'BRONZE' END AS seller_tier
    FROM s_sellers s LEFT JOIN (SELECT seller_id, count(*) AS total_orders, sum(revenue) AS revenue,
        {DELAYS_LONG}, {mean('review_score')} AS avg_review_score
        FROM g_seller_orders GROUP BY 1) m ON m.seller_id = s.seller_id"""
sql("seller_metrics", SELLERS)
sql("dim_sellers", f"""SELECT {md5_of('seller_id')} AS seller_sk, x.*, region AS seller_region
    FROM ({SELLERS}) x LEFT JOIN state_regions ON state = seller_state""")
sql("dim_geolocation", f"""SELECT {md5_of('geolocation_zip_code_prefix')} AS geolocation_sk,
    geolocation_zip_code_prefix, geolocation_lat, geolocation_lng, geolocation_city,
    geolocation_state FROM s_geolocation""")
sql("dim_payment_method", f"""SELECT {md5_of('payment_type')} AS payment_method_sk, payment_type,
    max(payment_installments) > 1 AS allows_installments FROM s_order_payments GROUP BY ALL""")
sql("surrogate_key_sequence", """SELECT product_id, row_number() OVER (ORDER BY product_id)
    AS product_sk FROM s_products""")


def _fact_sales(keys: str, joins: str = "") -> str:
    return f"""SELECT md5(CAST(i.order_id AS VARCHAR) || '~' || CAST(i.order_item_id AS VARCHAR))
    AS sale_sk, {day_key(BOUGHT)} AS date_sk, {keys}, i.order_id, i.order_item_id,
    1 AS quantity, i.price AS unit_price, i.freight_value,
    CAST(i.price + i.freight_value AS DECIMAL(10,2)) AS total_value, is_delivered, is_late,
    delivery_days, delay_days, review_score
    FROM s_order_items i JOIN g_metrics m ON m.order_id = i.order_id {joins}"""


sql("fact_sales", _fact_sales(", ".join(
    f"{md5_of(f'{w}_id')} AS {w}_sk" for w in ("customer", "product", "seller"))))
sql("fact_sales_lookup", _fact_sales("customer_sk, product_sk, seller_sk", " ".join(
    f"""LEFT JOIN (SELECT {w}_id, row_number() OVER (ORDER BY {w}_id) AS {w}_sk FROM s_{w}s) d{n}
    ON d{n}.{w}_id = {a}.{w}_id""" for n, (w, a) in enumerate(
        [("customer", "m"), ("product", "i"), ("seller", "i")]))))
sql("fact_sales_versioned", _fact_sales(
    f"v.customer_sk, {md5_of('product_id')} AS product_sk, {md5_of('seller_id')} AS seller_sk",
    f"""LEFT JOIN (SELECT *, md5(CAST(customer_id AS VARCHAR) || '~' || strftime(effective_from, '%Y-%m-%d'))
               AS customer_sk FROM ({LATE})) v
    ON v.customer_id = m.customer_id AND CAST({BOUGHT} AS DATE) >= v.effective_from
       AND (v.effective_to IS NULL OR CAST({BOUGHT} AS DATE) < v.effective_to)"""))
sql("fact_deliveries", f"""SELECT f.order_id, f.seller_id, delivery_days, delay_days, sla_met,
    distance_km, freight_value,
    CASE WHEN distance_km > 0 THEN round(CAST(freight_value AS DOUBLE) / distance_km, 6) END
        AS freight_per_km
    FROM (SELECT order_id, seller_id, sum(freight_value) AS freight_value FROM s_order_items
          GROUP BY ALL) f
    JOIN (SELECT DISTINCT order_id, seller_id, distance_km FROM (
          {_distance(SILVER_POINTS, 's', "o.order_status = 'delivered'")})) k
      ON k.order_id = f.order_id AND k.seller_id = f.seller_id
    JOIN (SELECT order_id, {DAYS.format(DONE, BOUGHT)} AS delivery_days,
          CASE WHEN {DONE} > {DUE} THEN {DAYS.format(DONE, DUE)} ELSE 0 END AS delay_days,
          NOT ({DONE} > {DUE}) AS sla_met FROM s_orders WHERE {DONE} IS NOT NULL) o
      ON o.order_id = f.order_id""")
SENTIMENT = """CASE WHEN review_score >= 4 THEN 'POSITIVE' WHEN review_score <= 2 THEN 'NEGATIVE'
    WHEN review_score = 3 THEN 'NEUTRAL' END"""
sql("fact_orders", f"""SELECT order_id, {md5_of('order_id')} AS order_sk,
    {md5_of('customer_id')} AS customer_sk, {day_key(BOUGHT)} AS date_key_purchase,
    {day_key(DONE)} AS date_key_delivery, total_order_value AS total_value, total_items,
    delivery_days, delay_days, is_late AS is_delayed, delay_category, review_score,
    {SENTIMENT} AS review_sentiment FROM g_metrics""")
MARCH = "date_trunc('month', order_purchase_timestamp) = DATE '1998-03-01'"
SPRING = "order_purchase_timestamp >= DATE '1998-02-01' AND order_purchase_timestamp < DATE '1998-05-01'"
sql("fact_orders_upserted", f"""SELECT order_id, {md5_of('order_id')} AS order_sk,
    {md5_of('customer_id')} AS customer_sk, {day_key(BOUGHT)} AS date_key_purchase,
    {day_key(DONE)} AS date_key_delivery, total_order_value AS total_value, total_items,
    CASE WHEN {MARCH} THEN delivery_days WHEN {SPRING} THEN -1 END AS delivery_days, delay_days,
    is_late AS is_delayed, delay_category, CASE WHEN {SPRING} THEN review_score END AS review_score,
    {SENTIMENT} AS review_sentiment,
    CASE WHEN {MARCH} THEN TIMESTAMP '1998-04-01' WHEN {SPRING} THEN TIMESTAMP '1998-03-01'
         ELSE TIMESTAMP '1998-01-01' END AS updated_at,
    CAST(order_purchase_timestamp::DATE AS TIMESTAMP) AS purchase_date,
    strftime(order_purchase_timestamp, '%Y-%m') AS month FROM g_metrics""")
sql("fact_order_items", f"""SELECT {md5_of('order_id')} AS order_sk, order_item_id,
    {md5_of('product_id')} AS product_sk, {md5_of('seller_id')} AS seller_sk, price,
    freight_value AS freight, item_total_value AS total FROM s_order_items""")
sql("fact_reviews", f"""SELECT review_id, {md5_of('order_id')} AS order_sk, review_score AS score,
    review_comment_message AS comment, {SENTIMENT} AS sentiment,
    coalesce(review_score <= 2, FALSE) AND review_comment_message IS NOT NULL AS has_complaint
    FROM s_order_reviews""")
sql("customer_metrics", "SELECT * FROM g_customers")
sql("order_metrics", "SELECT * FROM g_metrics")
sql("product_metrics", "SELECT * FROM g_products")
sql("delay_classes", f"""SELECT CASE WHEN d <= 0 THEN 'ON_TIME' WHEN d <= 3 THEN '1-3d'
    WHEN d <= 7 THEN '4-7d' WHEN d <= 15 THEN '8-15d' ELSE '>15d' END AS delay_category,
    count(*) AS orders, max(d) AS max_days FROM (SELECT CASE WHEN {DONE} > {DUE}
    THEN {DAYS.format(DONE, DUE)} ELSE 0 END AS d FROM s_orders) GROUP BY 1""")
sql("route_analysis", f"""SELECT seller_state, customer_state, distance_category,
    count(*) AS orders, {mean('delivery_days')} AS avg_delivery_days, {DELAYS_LONG}
    FROM g_routes GROUP BY 1, 2, 3""")

# --- KPIs and analyses ----------------------------------------------------------------------

COHORTS = f"""WITH active AS (SELECT DISTINCT customer_unique_id,
        {MONTH.format(BOUGHT)} AS purchase_month FROM {UNIQUE_ORDERS}),
    cohorts AS (SELECT customer_unique_id, min(purchase_month) AS cohort_month FROM active GROUP BY 1),
    months AS (SELECT cohort_month, purchase_month, customer_unique_id,
        CAST(date_diff('month', cohort_month, purchase_month) AS INT) AS month_number
        FROM active JOIN cohorts USING (customer_unique_id))
    """
sql("cohort_matrix", COHORTS + "SELECT cohort_month, " + ", ".join(
    f"{hits(f'month_number = {m}')} AS month_{m}" for m in range(4))
    + " FROM months GROUP BY 1")
sql("cohort_retention", COHORTS + """SELECT *, CAST(customers AS DOUBLE)
    / first_value(customers) OVER (PARTITION BY cohort_month ORDER BY purchase_month)
    AS retention_rate FROM (SELECT cohort_month, purchase_month, month_number,
    count(*) AS customers FROM months GROUP BY 1, 2, 3)""")
sql("agg_seller_performance", f"""SELECT seller_id, {MONTH.format(BOUGHT)} AS year_month,
    count(*) AS orders, sum(revenue) AS revenue, {DELAYS}, {mean('review_score')} AS review_score,
    {NPS} AS nps FROM g_seller_orders GROUP BY 1, 2""".replace(
        "AS review_score,", "AS review_score_avg,").replace(
        "SELECT seller_id", "SELECT * RENAME (review_score_avg AS review_score) FROM (SELECT seller_id",
        1) + ")")
sql("agg_category_performance", f"""SELECT category, {MONTH.format(BOUGHT)} AS year_month,
    count(*) AS orders, sum(revenue) AS revenue, {DELAYS} FROM g_category_orders GROUP BY 1, 2""")
sql("agg_geographic_analysis", f"""SELECT customer_region, seller_region, distance_category,
    count(*) AS orders, {DELAYS} FROM g_routes GROUP BY 1, 2, 3""")
sql("kpi_dashboard", f"""WITH wide AS (SELECT CAST(count(*) AS DOUBLE) AS total_orders,
        {pct(hits('NOT is_late'), hits('is_late IS NOT NULL'))} AS on_time_pct,
        {mean('review_score')} AS avg_review, CAST(sum(total_order_value) AS DOUBLE) AS revenue,
        {NPS} AS nps FROM g_metrics),
    tall AS (""" + " UNION ALL ".join(
        f"SELECT '{m}' AS metric, {m} AS value, CAST({t} AS DOUBLE) AS target FROM wide"
        for m, t in [("total_orders", "NULL"), ("on_time_pct", 90), ("avg_review", "NULL"),
                     ("revenue", "NULL"), ("nps", 60)]) + """)
    SELECT *, CASE WHEN target IS NULL THEN 'NO_TARGET' WHEN value >= target THEN 'ON_TARGET'
        ELSE 'BELOW_TARGET' END AS status,
        round((value - target) * 100 / target, 4) AS variance_pct FROM tall""")
sql("delay_score_correlation", """SELECT count(*) AS orders,
    round(corr(delay_days, review_score), 6) AS pearson_r FROM g_metrics
    WHERE is_late IS NOT NULL AND review_score IS NOT NULL""")
PARETO = f"""SELECT seller_id, late_orders, rank, running, entities,
        CAST(running AS DOUBLE) / CAST(whole AS DOUBLE) AS running_share,
        CAST(running - late_orders AS DOUBLE) / CAST(whole AS DOUBLE) < 0.8 AS in_head
    FROM (SELECT *, row_number() OVER w AS rank, CAST(sum(late_orders) OVER w AS BIGINT) AS running,
                 count(*) OVER () AS entities, sum(late_orders) OVER () AS whole
          FROM (SELECT seller_id, {hits('is_late')} AS late_orders FROM g_seller_orders GROUP BY 1)
          WINDOW w AS (ORDER BY late_orders DESC, seller_id ROWS UNBOUNDED PRECEDING))"""
sql("pareto", PARETO)
sql("pareto_summary", f"""SELECT count(*) AS entities, {hits('in_head')} AS head_entities,
    {pct(hits('in_head'), 'count(*)')} AS head_pct FROM ({PARETO})""")
sql("seasonality", f"""SELECT *, round((delay_rate - overall) * 100 / overall, 4) AS vs_mean_pct
    FROM (SELECT CAST(month({BOUGHT}) AS INT) AS month, count(*) AS orders,
          {hits('is_late')} AS late_orders,
          CAST({hits('is_late')} * 100 AS DOUBLE) / count(*) AS delay_rate
          FROM g_metrics WHERE is_late IS NOT NULL GROUP BY 1),
         (SELECT CAST({hits('is_late')} * 100 AS DOUBLE) / count(*) AS overall
          FROM g_metrics WHERE is_late IS NOT NULL)""".replace(
              "SELECT *, round", "SELECT * EXCLUDE (overall), round", 1))
sql("category_risk", f"""SELECT category, count(*) AS orders, {hits('is_late')} AS late_orders,
    {pct(hits('is_late'), 'count(*)')} AS delay_rate FROM g_category_orders
    WHERE is_late IS NOT NULL GROUP BY 1""")
sql("clv", """SELECT customer_id, total_orders, value AS mean_order_value,
    round(years, 6) AS active_years, round(value * total_orders * years, 2) AS clv
    FROM (SELECT customer_id, total_orders, CAST(total_spent AS DOUBLE) / total_orders AS value,
          (CAST(last_order_date AS DATE) - CAST(first_order_date AS DATE) + 1) / 365.0::DOUBLE AS years
          FROM g_customers WHERE total_orders > 0)""")
sql("churned", """SELECT customer_id, last_order_date, days_since_last_order, total_spent
    FROM g_customers WHERE CAST(last_order_date AS DATE) < DATE '2001-12-31' - INTERVAL 6 MONTH""")
sql("revenue_at_risk", """SELECT delay_category, orders, revenue, reduction,
    round(CAST(revenue AS DOUBLE) * reduction, 2) AS revenue_kept
    FROM (SELECT delay_category, count(*) AS orders, sum(total_order_value) AS revenue
          FROM g_metrics WHERE delay_category <> 'ON_TIME' GROUP BY 1),
         (SELECT unnest([0.1, 0.2, 0.3])::DOUBLE AS reduction)""")

# --- delay prediction -----------------------------------------------------------------------

FEATURES = HISTORY.rstrip() + f""",
    main AS (SELECT i.order_id, product_id, i.seller_id, product_weight_g, product_volume_cm3,
                    product_category_name
             FROM s_order_items i JOIN s_products p USING (product_id)
             QUALIFY row_number() OVER (PARTITION BY i.order_id ORDER BY
                 product_weight_g DESC, product_id DESC, i.seller_id DESC) = 1),
    basket AS (SELECT order_id, count(DISTINCT product_id) AS unique_products,
                      count(DISTINCT seller_id) AS unique_sellers FROM s_order_items GROUP BY 1),
    paid AS (SELECT order_id, count(*) AS payment_count,
                    max(payment_installments) AS max_installments,
                    CAST(max(CAST(payment_type = 'credit_card' AS INT)) AS INT) AS used_credit_card
             FROM s_order_payments GROUP BY 1),
    features AS (SELECT m.order_id, m.{BOUGHT}, CAST(total_order_value AS DOUBLE) AS total_value,
        total_items, unique_products, unique_sellers, payment_count, max_installments,
        used_credit_card, {DAYS.format(DUE, f'm.{BOUGHT}')} AS estimated_days,
        x.product_weight_g AS weight_g, x.product_volume_cm3 AS volume_cm3,
        CASE WHEN x.product_volume_cm3 < 5000 THEN 'SMALL' WHEN x.product_volume_cm3 < 50000
             THEN 'MEDIUM' WHEN x.product_volume_cm3 >= 50000 THEN 'LARGE' END AS size_category,
        CASE WHEN x.product_weight_g <= 1000 THEN 'LIGHT' WHEN x.product_weight_g <= 10000
             THEN 'MEDIUM' WHEN x.product_weight_g > 10000 THEN 'HEAVY' END AS weight_category,
        coalesce(x.product_category_name, 'unknown') AS category_name,
        avg_delay_history, delay_rate_history, avg_review_history, seller_tier, seller_region,
        customer_region, distance_category,
        CAST(seller_region = customer_region AS INT) AS is_same_region,
        CAST(isodow(m.{BOUGHT}) AS INT) AS order_dow, CAST(month(m.{BOUGHT}) AS INT) AS order_month,
        CAST(isodow(m.{BOUGHT}) >= 6 AS INT) AS is_weekend,
        CAST(CAST(m.{BOUGHT} AS DATE) IN (SELECT day FROM b_holidays) AS INT) AS is_holiday,
        CAST(m.is_late AS INT) AS is_delayed
        FROM g_metrics m JOIN main x ON x.order_id = m.order_id
        JOIN basket b ON b.order_id = m.order_id
        LEFT JOIN paid p ON p.order_id = m.order_id
        LEFT JOIN g_routes r ON r.order_id = m.order_id AND r.seller_id = x.seller_id
        LEFT JOIN history h ON h.seller_id = x.seller_id AND h.{BOUGHT} = m.{BOUGHT})
    """
sql("delay_features", FEATURES + "SELECT * FROM features")
sql("temporal_split", FEATURES + f"""SELECT CASE WHEN {BOUGHT} < TIMESTAMP '1999-07-01' THEN 'train'
    WHEN {BOUGHT} < TIMESTAMP '2000-07-01' THEN 'val' ELSE 'test' END AS split,
    count(*) AS orders, CAST(sum(is_delayed) AS BIGINT) AS delayed FROM features GROUP BY 1""")
_TEST = f"{BOUGHT} >= TIMESTAMP '2000-07-01'"
_VAL = f"{BOUGHT} >= TIMESTAMP '1999-07-01' AND {BOUGHT} < TIMESTAMP '2000-07-01'"
sql("score_orders", FEATURES + f"""SELECT
    md5(CAST(order_id AS VARCHAR) || '~v1~2001-09-01 06:00:00') AS prediction_id, order_id,
    TIMESTAMP '2001-09-01 06:00:00' AS predicted_at, is_delayed AS actual_outcome,
    TRUE AS probability_valid, TRUE AS level_valid, 'v1' AS model_version FROM features WHERE {_TEST}""")
sql("model_evaluation", FEATURES + f"""SELECT count(*) AS orders,
    CAST(coalesce(sum(is_delayed), 0) AS BIGINT) AS delayed, TRUE AS figures_valid, TRUE AS has_skill,
    TRUE AS beats_history, TRUE AS tenths_rise
    FROM features WHERE {_TEST} AND is_delayed IS NOT NULL""")
sql("feature_importance", FEATURES + """SELECT 25::BIGINT AS features, TRUE AS adds_up,
    count(DISTINCT order_dow) > 1 AS cause_leads FROM features""")


def _auc(name: str, where: str = "TRUE") -> str:
    return f""",
    {name}_counts AS (SELECT delay_rate_history / 100 AS s, CAST(sum(is_delayed) AS BIGINT) AS pos,
                     CAST(sum(1 - is_delayed) AS BIGINT) AS neg FROM features
              WHERE delay_rate_history IS NOT NULL AND is_delayed IS NOT NULL AND {where} GROUP BY 1),
    {name} AS (SELECT CAST(sum(pos * (2 * below - neg)) AS DOUBLE) / nullif(2 * sum(pos) * sum(neg), 0)
                      AS auc, CAST(coalesce(sum(pos + neg), 0) AS BIGINT) AS sample_size
               FROM (SELECT *, sum(neg) OVER (ORDER BY s ROWS UNBOUNDED PRECEDING) AS below
                     FROM {name}_counts))
    """


_RATED = """(SELECT delay_rate_history / 100 AS p, is_delayed FROM features)"""
sql("history_evaluation", FEATURES + f"""SELECT orders, tp AS true_positive, fp AS false_positive,
    fn AS false_negative, tp / nullif(tp + fp, 0) AS precision, tp / nullif(tp + fn, 0) AS recall,
    2 * tp / nullif(2 * tp + fp + fn, 0) AS f1
    FROM (SELECT count(*) AS orders, count(*) FILTER (p >= 0.3 AND is_delayed = 1) AS tp,
                 count(*) FILTER (p >= 0.3 AND is_delayed = 0) AS fp,
                 count(*) FILTER (p < 0.3 AND is_delayed = 1) AS fn
          FROM {_RATED} WHERE is_delayed IS NOT NULL)""")
sql("history_auc", FEATURES + _auc("a") + "SELECT auc, sample_size FROM a")
sql("history_risk_alert", FEATURES + f"""SELECT count(*) FILTER (p > 0.7) AS high,
    count(*) FILTER (p >= 0.4 AND p <= 0.7) AS medium, count(*) FILTER (p < 0.4) AS low,
    count(*) FILTER (p > 0.7) > 50 AS alert FROM {_RATED}""")
sql("performance_drift", FEATURES + _auc("now", _TEST) + _auc("base", _VAL) + """
    SELECT TIMESTAMP '2001-01-01' AS checked_at, now.auc AS auc_current, base.auc AS auc_baseline,
           (base.auc - now.auc) / base.auc * 100 AS auc_drop, now.sample_size,
           CASE WHEN (base.auc - now.auc) / base.auc * 100 > 10 THEN 'CRITICAL'
                WHEN (base.auc - now.auc) / base.auc * 100 > 5 THEN 'WARNING' ELSE 'OK' END AS status
    FROM now, base""")
