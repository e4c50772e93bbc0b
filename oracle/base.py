"""Shared common table expressions, and the helper that prepends the ones a query names."""

from __future__ import annotations

import re

CTES = {
    # --- bronze -----------------------------------------------------------------------------
    "b_customers": """
        SELECT c_custkey AS customer_id, c_custkey // 3 AS customer_unique_id,
               lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0') AS customer_zip_code_prefix,
               c_mktsegment AS customer_city, n_name AS customer_state
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "b_sellers": """
        SELECT s_suppkey AS seller_id,
               lpad(CAST(s_suppkey % 100000 AS VARCHAR), 5, '0') AS seller_zip_code_prefix,
               s_name AS seller_city, ' ' || lower(n_name) || ' ' AS seller_state
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "b_products": """
        SELECT p_partkey AS product_id,
               CASE WHEN p_partkey % 50 <> 0 THEN p_type END AS product_category_name,
               CAST(length(p_name) AS INT) AS product_name_lenght,
               CASE WHEN p_partkey % 50 <> 0 THEN CAST(p_partkey % 1000 AS INT) END
                   AS product_description_lenght,
               CASE WHEN p_partkey % 50 <> 0 THEN CAST(p_partkey % 6 AS INT) END
                   AS product_photos_qty,
               p_size * 300 AS product_weight_g,
               CAST(10 + p_partkey % 20 AS INT) AS product_length_cm,
               CASE WHEN p_partkey % 40 <> 0 THEN CAST(5 + p_partkey % 10 AS INT) END
                   AS product_height_cm,
               CAST(8 + p_partkey % 15 AS INT) AS product_width_cm
        FROM part""",
    "b_orders": """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id,
               CASE o_orderstatus WHEN 'F' THEN ' Delivered ' WHEN 'O' THEN 'SHIPPED'
                    WHEN 'P' THEN 'canceled' END AS order_status,
               o_orderdate AS order_purchase_timestamp,
               CASE WHEN o_orderstatus <> 'P' THEN o_orderdate + INTERVAL 1 DAY END
                   AS order_approved_at,
               CASE WHEN o_orderstatus <> 'P' THEN o_orderdate + INTERVAL 2 DAY END
                   AS order_delivered_carrier_date,
               CASE WHEN o_orderstatus = 'F' THEN o_orderdate + to_days(CAST(3 + o_orderkey % 20
                        + CASE WHEN isodow(o_orderdate) >= 6 THEN 10 ELSE 0 END AS INT))
                    + to_hours(CAST(o_orderkey % 24 AS INT)) END AS order_delivered_customer_date,
               o_orderdate + INTERVAL 20 DAY AS order_estimated_delivery_date
        FROM orders""",
    "b_raw_items": """
        SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id,
               l_suppkey AS seller_id, l_extendedprice AS _price,
               l_shipdate AS shipping_limit_date, l_quantity AS _quantity
        FROM lineitem""",
    "b_order_items": """
        SELECT order_id, order_item_id, product_id, seller_id, shipping_limit_date,
               CAST(_price AS DECIMAL(10,2)) AS price,
               CAST(product_id % 40 AS DECIMAL(10,2)) AS freight_value
        FROM (SELECT *, row_number() OVER (PARTITION BY order_id, order_item_id
                     ORDER BY product_id, seller_id, _price, shipping_limit_date, _quantity) AS nr
              FROM b_raw_items) WHERE nr = 1""",
    "b_order_payments": """
        SELECT order_id, seq AS payment_sequential, payment_type, payment_installments,
               CAST(CASE WHEN order_id % 7 <> 0 THEN total
                         WHEN seq = 1 THEN first ELSE total - first END AS DECIMAL(10,2))
                   AS payment_value
        FROM (SELECT o_orderkey AS order_id, CAST(o_totalprice AS DECIMAL(10,2)) AS total,
                     CAST(((CAST(CAST(o_totalprice AS DECIMAL(10,2)) * 100 AS BIGINT) + 1) // 2)
                          AS DECIMAL(18,0)) * 0.01 AS first,
                     CASE left(o_orderpriority, 1) WHEN '1' THEN 'credit_card'
                          WHEN '2' THEN 'boleto' WHEN '3' THEN 'voucher'
                          WHEN '4' THEN 'debit_card' WHEN '5' THEN ' Credit_Card ' END
                         AS payment_type,
                     CAST(1 + o_orderkey % 10 AS INT) AS payment_installments
              FROM orders)
        JOIN (SELECT 1 AS seq UNION ALL SELECT 2) ON seq = 1 OR order_id % 7 = 0""",
    "b_order_reviews": """
        WITH first_reviews AS (
            SELECT o.order_id,
                   CAST(5 - CASE WHEN order_delivered_customer_date > order_estimated_delivery_date
                                 THEN 2 ELSE 0 END - o.order_id % 3 AS INT) AS score,
                   CASE WHEN o.order_id % 4 = 0 THEN ' Review ' || CAST(o.order_id AS VARCHAR) || ' ' END
                       AS review_comment_title,
                   d.text AS review_comment_message,
                   coalesce(order_delivered_customer_date, order_estimated_delivery_date) AS created
            FROM b_orders o
            LEFT JOIN documents d ON o.order_id % 5 = 0
                 AND d.doc_id = (o.order_id // 5) % (SELECT count(*) FROM documents)
            WHERE o.order_id % 10 <> 9)
        SELECT CASE WHEN nr = 1 THEN order_id ELSE -1 - order_id END AS review_id, order_id,
               CASE WHEN nr = 1 THEN score ELSE 6 - score END AS review_score,
               review_comment_title, review_comment_message,
               CASE WHEN nr = 1 OR order_id % 16 = 0 THEN created ELSE created + INTERVAL 1 DAY END
                   AS review_creation_date,
               CASE WHEN order_id % 6 <> 0 THEN created + INTERVAL 1 DAY END AS review_answer_timestamp
        FROM first_reviews JOIN (SELECT 1 AS nr UNION ALL SELECT 2) ON nr = 1 OR order_id % 8 = 0""",
    "b_geolocation": """
        SELECT lpad(CAST(c_custkey AS VARCHAR), 5, '0') AS geolocation_zip_code_prefix,
               CAST(-30 + (c_custkey * 7) % 33 + CASE WHEN copy = 4 THEN 0.5 ELSE 0 END
                    + CASE WHEN c_custkey % 12 = 5 THEN 40 ELSE 0 END AS DECIMAL(10,8))
                   AS geolocation_lat,
               CAST(-70 + (c_custkey * 11) % 33 + CASE WHEN copy = 4 THEN 0.5 ELSE 0 END
                    AS DECIMAL(11,8)) AS geolocation_lng,
               ' ' || lower(n_name) || ' ' AS geolocation_city, lower(n_name) AS geolocation_state
        FROM customer JOIN nation ON c_nationkey = n_nationkey, range(5) AS copies(copy)
        WHERE c_custkey < 100000 AND c_custkey % 25 <> 24""",
    "b_holidays": """
        SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS day FROM orders""",
    "state_regions": """
        SELECT n_name AS state, r_name AS region FROM nation JOIN region ON n_regionkey = r_regionkey""",
    # --- silver -----------------------------------------------------------------------------
    "geo_point": """
        SELECT geolocation_zip_code_prefix AS zip, geolocation_lat AS lat, geolocation_lng AS lng
        FROM (SELECT *, row_number() OVER (PARTITION BY geolocation_zip_code_prefix
                     ORDER BY geolocation_lat, geolocation_lng, geolocation_city) AS nr
              FROM b_geolocation
              WHERE geolocation_lat IS NOT NULL AND geolocation_lng IS NOT NULL) WHERE nr = 1""",
    "s_customers": """
        SELECT DISTINCT customer_id, customer_unique_id, customer_zip_code_prefix, customer_city,
               customer_state, coalesce(lat, 0) AS geolocation_lat, coalesce(lng, 0) AS geolocation_lng,
               lat IS NOT NULL AND lng IS NOT NULL AS has_geolocation
        FROM b_customers LEFT JOIN geo_point ON customer_zip_code_prefix = zip""",
    "s_sellers": """
        SELECT DISTINCT seller_id, seller_zip_code_prefix, seller_city,
               upper(trim(seller_state)) AS seller_state,
               coalesce(lat, 0) AS geolocation_lat, coalesce(lng, 0) AS geolocation_lng,
               lat IS NOT NULL AND lng IS NOT NULL AS has_geolocation
        FROM b_sellers LEFT JOIN geo_point ON seller_zip_code_prefix = zip""",
    "s_products": """
        SELECT DISTINCT product_id, product_category_name,
               coalesce(product_name_lenght, 0) AS product_name_length,
               coalesce(product_description_lenght, 0) AS product_description_length,
               coalesce(product_photos_qty, 0) AS product_photos_qty,
               product_weight_g, product_length_cm, product_height_cm, product_width_cm,
               CAST(product_length_cm AS BIGINT) * product_height_cm * product_width_cm
                   AS product_volume_cm3,
               product_category_name IS NOT NULL AS has_category,
               product_weight_g IS NOT NULL AS has_weight, product_photos_qty > 0 AS has_photos,
               product_length_cm IS NOT NULL AND product_height_cm IS NOT NULL
                   AND product_width_cm IS NOT NULL AS has_dimensions
        FROM b_products""",
    "s_orders": """
        SELECT DISTINCT order_id, customer_id, lower(trim(order_status)) AS order_status,
               order_purchase_timestamp, order_approved_at, order_delivered_carrier_date,
               order_delivered_customer_date, order_estimated_delivery_date,
               order_approved_at IS NOT NULL AS is_approved,
               order_delivered_carrier_date IS NOT NULL AS is_shipped,
               order_delivered_customer_date IS NOT NULL AS is_delivered
        FROM b_orders""",
    "s_order_items": """
        SELECT DISTINCT order_id, order_item_id, product_id, seller_id, price, freight_value,
               shipping_limit_date,
               CAST(price + freight_value AS DECIMAL(10,2)) AS item_total_value,
               price > 0 AS has_price, freight_value > 0 AS has_freight,
               shipping_limit_date IS NOT NULL AS has_shipping_limit
        FROM b_order_items""",
    "s_order_payments": """
        SELECT DISTINCT order_id, payment_sequential, lower(trim(payment_type)) AS payment_type,
               payment_installments, payment_value, payment_value > 0 AS has_value,
               payment_installments > 1 AS is_installment,
               coalesce(lower(trim(payment_type)) = 'credit_card', FALSE) AS is_credit_card,
               coalesce(lower(trim(payment_type)) = 'boleto', FALSE) AS is_boleto
        FROM b_order_payments""",
    "s_order_reviews": """
        SELECT DISTINCT review_id, order_id, review_score,
               trim(review_comment_title, ' ') AS review_comment_title,
               trim(review_comment_message, ' ') AS review_comment_message,
               review_creation_date, review_answer_timestamp,
               CAST(coalesce(length(trim(review_comment_message, ' ')), 0) AS INT) AS comment_length,
               review_comment_title IS NOT NULL AS has_comment_title,
               review_comment_message IS NOT NULL AS has_comment_message,
               review_answer_timestamp IS NOT NULL AS has_answer,
               review_score >= 4 AS is_positive_score, review_score <= 2 AS is_negative_score
        FROM b_order_reviews""",
    "s_geolocation": """
        SELECT geolocation_zip_code_prefix, CAST(geolocation_lat AS DECIMAL(10,6)) AS geolocation_lat,
               CAST(geolocation_lng AS DECIMAL(10,6)) AS geolocation_lng,
               trim(geolocation_city) AS geolocation_city,
               upper(trim(geolocation_state)) AS geolocation_state,
               TRUE AS is_valid_brazil_coords,
               (SELECT count(*) FROM b_geolocation g
                WHERE g.geolocation_zip_code_prefix = v.geolocation_zip_code_prefix) AS original_count
        FROM (SELECT *, row_number() OVER (PARTITION BY geolocation_zip_code_prefix
                     ORDER BY geolocation_lat, geolocation_lng, geolocation_city) AS nr
              FROM b_geolocation WHERE geolocation_lat BETWEEN -33 AND 5
                                   AND geolocation_lng BETWEEN -74 AND -34) v WHERE nr = 1""",
    # --- gold -------------------------------------------------------------------------------
    "order_review": """
        SELECT order_id, review_score, review_comment_message IS NOT NULL AS has_review_comment
        FROM (SELECT *, row_number() OVER (PARTITION BY order_id
                     ORDER BY review_creation_date DESC, review_id DESC) AS nr
              FROM s_order_reviews) WHERE nr = 1""",
    "g_metrics": """
        SELECT o.order_id, o.customer_id, o.order_status, o.order_purchase_timestamp,
               o.order_approved_at, o.order_delivered_carrier_date,
               o.order_delivered_customer_date, o.order_estimated_delivery_date,
               total_items_value, total_freight, total_order_value, total_items,
               CAST(extract(DAY FROM (order_delivered_customer_date - order_purchase_timestamp))
                    AS INT) AS delivery_days,
               delay_days,
               order_delivered_customer_date > order_estimated_delivery_date AS is_late,
               order_status = 'delivered' AS is_delivered,
               CASE WHEN order_delivered_customer_date IS NULL THEN NULL
                    WHEN delay_days <= 0 THEN 'ON_TIME' WHEN delay_days <= 3 THEN '1-3d'
                    WHEN delay_days <= 7 THEN '4-7d' WHEN delay_days <= 15 THEN '8-15d'
                    ELSE '>15d' END AS delay_category,
               review_score, has_review_comment, payment_types, total_payment_value,
               avg_installments
        FROM (SELECT *, CASE WHEN order_delivered_customer_date > order_estimated_delivery_date
                     THEN CAST(extract(DAY FROM (order_delivered_customer_date
                               - order_estimated_delivery_date)) AS INT) ELSE 0 END AS delay_days
              FROM s_orders) o
        JOIN (SELECT order_id, sum(price) AS total_items_value, sum(freight_value) AS total_freight,
                     sum(price + freight_value) AS total_order_value, count(*) AS total_items
              FROM s_order_items GROUP BY order_id) i ON i.order_id = o.order_id
        LEFT JOIN order_review r ON r.order_id = o.order_id
        LEFT JOIN (SELECT order_id, string_agg(DISTINCT payment_type, ', ' ORDER BY payment_type)
                              AS payment_types,
                          sum(payment_value) AS total_payment_value,
                          CAST(sum(payment_installments) AS DOUBLE) / count(payment_installments)
                              AS avg_installments
                   FROM s_order_payments GROUP BY order_id) p ON p.order_id = o.order_id""",
    "g_seller_orders": """
        SELECT i.seller_id, i.order_id, revenue, freight, customer_id, order_purchase_timestamp,
               order_delivered_customer_date, is_delivered, delivery_days, delay_days, is_late,
               review_score
        FROM (SELECT seller_id, order_id, sum(price) AS revenue, sum(freight_value) AS freight
              FROM s_order_items GROUP BY ALL) i JOIN g_metrics m ON m.order_id = i.order_id""",
    "g_category_orders": """
        SELECT category, c.order_id, revenue, order_purchase_timestamp, delay_days, is_late
        FROM (SELECT coalesce(product_category_name, 'unknown') AS category, order_id,
                     sum(price) AS revenue
              FROM s_order_items JOIN s_products USING (product_id) GROUP BY ALL) c
        JOIN g_metrics m ON m.order_id = c.order_id""",
    "g_routes": """
        SELECT so.*, s.seller_state, c.customer_state, sr.region AS seller_region,
               cr.region AS customer_region,
               CASE WHEN s.seller_state = c.customer_state THEN 'LOCAL'
                    WHEN sr.region = cr.region THEN 'REGIONAL' ELSE 'NATIONAL' END
                   AS distance_category
        FROM g_seller_orders so
        JOIN s_sellers s ON s.seller_id = so.seller_id
        JOIN s_customers c ON c.customer_id = so.customer_id
        LEFT JOIN state_regions sr ON sr.state = s.seller_state
        LEFT JOIN state_regions cr ON cr.state = c.customer_state""",
    "g_customers": """
        SELECT c.customer_id, customer_unique_id, customer_zip_code_prefix, customer_city,
               customer_state, lat AS geolocation_lat, lng AS geolocation_lng,
               coalesce(total_orders, 0) AS total_orders, first_order_date, last_order_date,
               total_spent, avg_order_value, avg_review_score,
               CAST(DATE '2001-12-31' - CAST(last_order_date AS DATE) AS INT)
                   AS days_since_last_order
        FROM s_customers c
        LEFT JOIN geo_point ON customer_zip_code_prefix = zip
        LEFT JOIN (
            SELECT o.customer_id, count(*) AS total_orders,
                   min(order_purchase_timestamp) AS first_order_date,
                   max(order_purchase_timestamp) AS last_order_date, sum(spent) AS total_spent,
                   CAST(sum(spent) AS DOUBLE) / nullif(sum(n), 0) AS avg_order_value,
                   CAST(sum(score_sum) AS DOUBLE) / nullif(sum(scores), 0) AS avg_review_score
            FROM s_orders o
            LEFT JOIN (SELECT order_id, sum(price + freight_value) AS spent, count(*) AS n
                       FROM s_order_items GROUP BY order_id) i ON i.order_id = o.order_id
            LEFT JOIN (SELECT order_id, sum(review_score) AS score_sum, count(review_score) AS scores
                       FROM s_order_reviews GROUP BY order_id) r ON r.order_id = o.order_id
            WHERE order_status = 'delivered' GROUP BY o.customer_id) m
          ON m.customer_id = c.customer_id""",
    "g_products": """
        SELECT p.product_id, product_category_name,
               coalesce(product_category_name, 'unknown') AS product_category_clean,
               product_weight_g, product_length_cm, product_height_cm, product_width_cm,
               product_volume_cm3, coalesce(total_sales, 0) AS total_sales, total_revenue,
               avg_price, min_price, max_price, avg_review_score,
               coalesce(total_reviews, 0) AS total_reviews,
               coalesce(five_star_reviews, 0) AS five_star_reviews,
               coalesce(negative_reviews, 0) AS negative_reviews, last_sale,
               coalesce(unique_sellers, 0) AS unique_sellers
        FROM s_products p
        LEFT JOIN (
            SELECT product_id, count(DISTINCT order_id) AS total_sales, sum(price) AS total_revenue,
                   CAST(sum(price) AS DOUBLE) / count(price) AS avg_price, min(price) AS min_price,
                   max(price) AS max_price, max(order_purchase_timestamp) AS last_sale,
                   count(DISTINCT seller_id) AS unique_sellers
            FROM s_order_items JOIN s_orders USING (order_id)
            WHERE order_status = 'delivered' GROUP BY product_id) s ON s.product_id = p.product_id
        LEFT JOIN (
            SELECT product_id,
                   CAST(sum(review_score) AS DOUBLE) / nullif(count(review_score), 0)
                       AS avg_review_score,
                   count(review_id) AS total_reviews,
                   count(*) FILTER (WHERE review_score = 5) AS five_star_reviews,
                   count(*) FILTER (WHERE review_score <= 2) AS negative_reviews
            FROM (SELECT DISTINCT product_id, order_id FROM s_order_items)
            JOIN s_orders USING (order_id) JOIN s_order_reviews USING (order_id)
            WHERE order_status = 'delivered' GROUP BY product_id) r ON r.product_id = p.product_id""",
}


def pct(part: str, whole: str) -> str:
    """Percentage rounded half up to two digits, exactly, by integers."""
    return (f"CASE WHEN ({whole}) > 0 THEN CAST((CAST(({part}) AS HUGEINT) * 20000 + ({whole})) "
            f"// (2 * ({whole})) AS DOUBLE) / 100 END")


def mean(expr: str, where: str = "TRUE") -> str:
    return (f"CAST(sum({expr}) FILTER (WHERE {where}) AS DOUBLE) "
            f"/ nullif(count({expr}) FILTER (WHERE {where}), 0)")


def hits(cond: str) -> str:
    return f"count(*) FILTER (WHERE {cond})"


def md5_of(expr: str) -> str:
    return f"md5(coalesce(CAST({expr} AS VARCHAR), ''))"


def day_key(ts: str) -> str:
    return f"CAST(year({ts}) * 10000 + month({ts}) * 100 + day({ts}) AS INT)"


DELAYS = f"""{mean('delay_days', 'is_late IS NOT NULL')} AS avg_delay,
             {pct(hits('is_late'), hits('is_late IS NOT NULL'))} AS pct_delayed"""
DELAYS_LONG = DELAYS.replace("AS avg_delay,", "AS avg_delay_days,")
NPS = ("CAST((count(*) FILTER (WHERE review_score = 5) - count(*) FILTER (WHERE review_score <= 2))"
       " * 100 AS DOUBLE) / nullif(count(review_score), 0)")


def with_ctes(query: str) -> str:
    """Prepend every CTE the query names, directly or through others, in dependency order."""
    own = set(re.findall(r"\b(\w+) AS (?:MATERIALIZED )?\(\s*(?:SELECT|WITH)", query))
    ordered: list[str] = []

    def add(text: str) -> None:
        for name in CTES:
            if name not in ordered and name not in own and re.search(rf"\b{name}\b", text):
                add(CTES[name])
                if name not in ordered:
                    ordered.append(name)

    add(query)
    body = query.strip()
    if not ordered:
        return body
    head = ", ".join(f"{n} AS ({CTES[n].strip()})" for n in ordered)
    if body.upper().startswith("WITH "):
        return f"WITH {head}, {body[5:]}"
    return f"WITH {head} {body}"
