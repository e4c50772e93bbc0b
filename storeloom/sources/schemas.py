"""Declared schemas, keys and closed domains of the retail model."""

from __future__ import annotations


def _ddl(*fields: str) -> str:
    """DDL of ``name type`` pairs; a trailing ``!`` marks a column that may not be NULL."""
    return ", ".join(f.replace("!", " NOT NULL") for f in fields)


# Bronze column names and types, in source order.
BRONZE = {
    "customers": _ddl(
        "customer_id string!", "customer_unique_id string!", "customer_zip_code_prefix string!",
        "customer_city string!", "customer_state string!"),
    "sellers": _ddl(
        "seller_id string!", "seller_zip_code_prefix string!", "seller_city string!",
        "seller_state string!"),
    "products": _ddl(
        "product_id string!", "product_category_name string", "product_name_lenght int",
        "product_description_lenght int", "product_photos_qty int", "product_weight_g int",
        "product_length_cm int", "product_height_cm int", "product_width_cm int"),
    "orders": _ddl(
        "order_id string!", "customer_id string!", "order_status string!",
        "order_purchase_timestamp timestamp_ntz!", "order_approved_at timestamp_ntz",
        "order_delivered_carrier_date timestamp_ntz",
        "order_delivered_customer_date timestamp_ntz",
        "order_estimated_delivery_date timestamp_ntz"),
    "order_items": _ddl(
        "order_id string!", "order_item_id int!", "product_id string!", "seller_id string!",
        "shipping_limit_date timestamp_ntz!", "price decimal(10,2)!",
        "freight_value decimal(10,2)!"),
    "order_payments": _ddl(
        "order_id string!", "payment_sequential int!", "payment_type string!",
        "payment_installments int!", "payment_value decimal(10,2)!"),
    "order_reviews": _ddl(
        "review_id string!", "order_id string!", "review_score int!",
        "review_comment_title string", "review_comment_message string",
        "review_creation_date timestamp_ntz!", "review_answer_timestamp timestamp_ntz"),
    "geolocation": _ddl(
        "geolocation_zip_code_prefix string!", "geolocation_lat decimal(10,8)!",
        "geolocation_lng decimal(11,8)!", "geolocation_city string!",
        "geolocation_state string!"),
}

PRIMARY_KEYS = {
    "customers": ["customer_id"],
    "sellers": ["seller_id"],
    "products": ["product_id"],
    "orders": ["order_id"],
    "order_items": ["order_id", "order_item_id"],
    "order_payments": ["order_id", "payment_sequential"],
    "order_reviews": ["review_id"],
    "geolocation": ["geolocation_zip_code_prefix"],
}

# child table, foreign key, parent table, primary key
FOREIGN_KEYS = [
    ("orders", "customer_id", "customers", "customer_id"),
    ("order_items", "order_id", "orders", "order_id"),
    ("order_items", "product_id", "products", "product_id"),
    ("order_items", "seller_id", "sellers", "seller_id"),
    ("order_payments", "order_id", "orders", "order_id"),
    ("order_reviews", "order_id", "orders", "order_id"),
]

# Rows expected per bronze table.
EXPECTED_ROWS = {
    "customers": 99441,
    "sellers": 3095,
    "products": 32951,
    "orders": 99441,
    "order_items": 112650,
    "order_payments": 103886,
    "order_reviews": 99224,
    "geolocation": 19000,
}

# Columns every bronze table must have at least.
REQUIRED_COLUMNS = {
    "customers": ["customer_id", "customer_unique_id", "customer_zip_code_prefix",
                  "customer_city", "customer_state"],
    "sellers": ["seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"],
    "products": ["product_id", "product_category_name"],
    "orders": ["order_id", "customer_id", "order_status", "order_purchase_timestamp"],
    "order_items": ["order_id", "order_item_id", "product_id", "seller_id", "price"],
    "order_payments": ["order_id", "payment_sequential", "payment_type", "payment_value"],
    "order_reviews": ["review_id", "order_id", "review_score"],
    "geolocation": ["geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng",
                    "geolocation_city", "geolocation_state"],
}

# Latitude and longitude limits of Brazil (lat_min, lat_max, lng_min, lng_max).
BRAZIL_BOX = (-33, 5, -74, -34)

# Brazilian states by macro-region.
BRAZIL_REGIONS = {
    "NORTE": ["AC", "AM", "AP", "PA", "RO", "RR", "TO"],
    "NORDESTE": ["AL", "BA", "CE", "MA", "PB", "PE", "PI", "RN", "SE"],
    "CENTRO-OESTE": ["DF", "GO", "MS", "MT"],
    "SUDESTE": ["ES", "MG", "RJ", "SP"],
    "SUL": ["PR", "RS", "SC"],
}

AUDIT_COLUMNS = ["processed_at", "updated_at", "created_at"]
