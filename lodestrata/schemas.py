"""Declared schemas of the landing feeds and the log tables."""

from __future__ import annotations

from pyspark.sql import types as T

_MONEY = T.DecimalType(12, 2)
_PRICE = T.DecimalType(10, 2)
_TYPES = {
    "id": T.LongType(),
    "text": T.StringType(),
    "time": T.TimestampNTZType(),
    "money": _MONEY,
    "price": _PRICE,
}


def _schema(text: str) -> T.StructType:
    fields = (item.split(":") for item in text.split())
    return T.StructType([T.StructField(name, _TYPES[kind], True) for name, kind in fields])


# Feed columns in file order (CSV columns bind by position).
BRONZE = {
    "customers": _schema(
        "customer_id:id first_name:text last_name:text email:text phone:text city:text "
        "state:text zip_code:text segment:text created_at:time"
    ),
    "orders": _schema(
        "order_id:id customer_id:id order_date:time status:text channel:text total_amount:money"
    ),
    "order_items": _schema(
        "order_item_id:id order_id:id product_id:id quantity:id unit_price:price "
        "discount:price line_total:money"
    ),
    "products": _schema(
        "product_id:id product_name:text category:text subcategory:text brand:text "
        "unit_price:price cost_price:price stock_quantity:id created_at:time"
    ),
    "payments": _schema(
        "payment_id:id order_id:id payment_method:text amount:money payment_date:time status:text"
    ),
    "shipments": _schema(
        "shipment_id:id order_id:id carrier:text tracking_number:text ship_date:time "
        "delivery_date:time status:text"
    ),
}

# Log tables.
LOGS = {
    "data_profile_log": _schema(
        "profile_run_id:text table_name:text column_name:text metric:text metric_value:text "
        "profiled_at:time"
    ),
    "anomaly_flags": _schema(
        "anomaly_id:text table_name:text record_id:text anomaly_type:text details:text "
        "detected_at:time"
    ),
    "customer_rfm_scores": _schema(
        "customer_id:id recency_score:id frequency_score:id monetary_score:id rfm_segment:text "
        "scored_at:time"
    ),
    "pipeline_run_summary": _schema(
        "run_id:text layer:text table_name:text row_count:id run_timestamp:time"
    ),
}

# The tables of each layer, in build order.
LAYERS = {
    "bronze": ["customers", "orders", "order_items", "products", "payments", "shipments"],
    "silver": [
        "stg_customers", "stg_orders", "stg_order_items", "stg_products", "stg_payments",
        "stg_shipments",
    ],
    "gold": [
        "dim_customers", "dim_products", "dim_dates", "fact_sales", "fact_daily_revenue",
        "fact_payment_summary", "fact_shipment_performance",
    ],
}

# The log tables of each layer.
LOG_TABLES = {
    "bronze": ["data_profile_log"],
    "silver": ["anomaly_flags"],
    "gold": ["customer_rfm_scores", "pipeline_run_summary"],
}
