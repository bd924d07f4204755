"""Which metric is measured on which table.  Fixed values, in layer order."""

from __future__ import annotations

NULL, DUPLICATE, ROWS, FRESHNESS = "NULL_COUNT", "DUPLICATE_COUNT", "ROW_COUNT", "FRESHNESS"
NEGATIVE, CUSTOMER_FK = "DMF_POSITIVE_AMOUNTS", "DMF_ORDERS_CUSTOMER_FK"

SCHEDULE = "60 MINUTES"

# (layer, table, metric, argument columns)
ATTACHMENTS: list[tuple[str, str, str, str]] = [
    ("bronze", "orders", NULL, "order_id"),
    ("bronze", "orders", DUPLICATE, "order_id"),
    ("bronze", "orders", ROWS, ""),
    ("bronze", "orders", FRESHNESS, ""),
    ("bronze", "orders", CUSTOMER_FK, "customer_id,order_id"),
    ("bronze", "orders", NEGATIVE, "total_amount"),
    ("bronze", "customers", NULL, "email"),
    ("bronze", "customers", DUPLICATE, "customer_id"),
    ("bronze", "customers", ROWS, ""),
    ("bronze", "customers", FRESHNESS, ""),
    ("bronze", "products", NULL, "product_id"),
    ("bronze", "products", DUPLICATE, "product_id"),
    ("bronze", "products", ROWS, ""),
    ("bronze", "order_items", NULL, "order_id"),
    ("bronze", "payments", NULL, "order_id"),
    ("bronze", "shipments", NULL, "order_id"),
    ("silver", "stg_orders", NULL, "order_id"),
    ("silver", "stg_orders", DUPLICATE, "order_id"),
    ("silver", "stg_orders", NEGATIVE, "total_amount"),
    ("silver", "stg_customers", NULL, "customer_id"),
    ("gold", "fact_sales", NULL, "order_id"),
    ("gold", "fact_sales", DUPLICATE, "order_id"),
    ("gold", "fact_sales", ROWS, ""),
    ("gold", "dim_customers", ROWS, ""),
    ("gold", "dim_products", ROWS, ""),
    ("gold", "dim_dates", NULL, "date_key"),
    ("gold", "dim_dates", DUPLICATE, "date_key"),
    ("gold", "dim_dates", ROWS, ""),
    ("gold", "fact_shipment_performance", NULL, "shipment_id"),
    ("gold", "fact_shipment_performance", DUPLICATE, "shipment_id"),
    ("gold", "fact_shipment_performance", ROWS, ""),
    ("gold", "fact_payment_summary", NULL, "order_id"),
    ("gold", "fact_payment_summary", DUPLICATE, "order_id"),
    ("gold", "fact_payment_summary", ROWS, ""),
    ("gold", "fact_daily_revenue", NULL, "revenue_date"),
    ("gold", "fact_daily_revenue", DUPLICATE, "revenue_date"),
    ("gold", "fact_daily_revenue", ROWS, ""),
]

# The column that tells when a table last changed.
CHANGE_TIMES = {"orders": "order_date", "customers": "created_at"}

# Tables whose attachments the inventory lists.
INVENTORY_TABLES = [
    "customers", "orders", "products", "order_items", "payments", "shipments", "stg_customers",
    "stg_orders", "stg_products", "dim_customers", "dim_products", "fact_sales",
]
