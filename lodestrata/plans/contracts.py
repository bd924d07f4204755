"""Declared column tests.  Fixed values: table, column, tests, accepted values, parent."""

from __future__ import annotations

from typing import NamedTuple


class Column(NamedTuple):
    table: str
    column: str
    unique: bool = False
    accepted: tuple[str, ...] = ()
    parent: tuple[str, str] | None = None


# Every declared column must also be not null.
_PRICE_TIERS = ("BUDGET", "MID_RANGE", "PREMIUM", "LUXURY")
_SPEEDS = ("SAME_DAY", "FAST", "STANDARD", "SLOW", "PENDING")
_ORDER = ("stg_orders", "order_id")
_BUYER = ("dim_customers", "customer_id")

SILVER = [
    Column("stg_customers", "customer_id", unique=True),
    Column("stg_customers", "email", unique=True),
    Column("stg_customers", "full_name"),
    Column("stg_customers", "email_domain"),
    Column("stg_customers", "customer_tenure_days"),
    Column("stg_customers", "segment", accepted=("REGULAR", "VIP", "NEW", "PREMIUM")),
    Column("stg_orders", "order_id", unique=True),
    Column("stg_orders", "customer_id", parent=("stg_customers", "customer_id")),
    Column("stg_orders", "status",
           accepted=("SHIPPED", "CANCELLED", "COMPLETED", "PENDING", "RETURNED")),
    Column("stg_orders", "total_amount"),
    Column("stg_orders", "days_since_order"),
    Column("stg_orders", "order_day_of_week"),
    Column("stg_order_items", "order_item_id", unique=True),
    Column("stg_order_items", "order_id", parent=_ORDER),
    Column("stg_order_items", "product_id", parent=("stg_products", "product_id")),
    Column("stg_order_items", "quantity"),
    Column("stg_order_items", "discount_pct"),
    Column("stg_order_items", "line_total"),
    Column("stg_products", "product_id", unique=True),
    Column("stg_products", "category"),
    Column("stg_products", "unit_price"),
    Column("stg_products", "margin_pct"),
    Column("stg_products", "price_tier", accepted=_PRICE_TIERS),
    Column("stg_payments", "payment_id", unique=True),
    Column("stg_payments", "order_id", parent=_ORDER),
    Column("stg_payments", "status", accepted=("COMPLETED", "FAILED", "REFUNDED", "PENDING")),
    Column("stg_payments", "payment_method_group",
           accepted=("CARD", "DIGITAL", "GIFT_CARD", "OTHER")),
    Column("stg_shipments", "shipment_id", unique=True),
    Column("stg_shipments", "order_id", parent=_ORDER),
    Column("stg_shipments", "status",
           accepted=("IN_TRANSIT", "DELIVERED", "RETURNED", "OUT_FOR_DELIVERY")),
    Column("stg_shipments", "shipping_speed", accepted=_SPEEDS),
]

GOLD = [
    Column("fact_sales", "order_id", unique=True),
    Column("fact_sales", "customer_id", parent=_BUYER),
    Column("fact_sales", "order_status"),
    Column("fact_sales", "order_total"),
    Column("fact_sales", "net_revenue"),
    Column("dim_customers", "customer_id", unique=True),
    Column("dim_customers", "email", unique=True),
    Column("dim_customers", "full_name"),
    Column("dim_customers", "segment"),
    Column("dim_customers", "loyalty_tier", accepted=("PLATINUM", "GOLD", "SILVER", "BRONZE")),
    Column("dim_customers", "cancellation_rate"),
    Column("dim_products", "product_id", unique=True),
    Column("dim_products", "category"),
    Column("dim_products", "price_tier", accepted=_PRICE_TIERS),
    Column("dim_products", "sales_tier", accepted=("TOP_SELLER", "STRONG", "ACTIVE", "NO_SALES")),
    Column("dim_dates", "date_key", unique=True),
    Column("dim_dates", "month_num"),
    Column("dim_dates", "year_num"),
    Column("fact_shipment_performance", "shipment_id", unique=True),
    Column("fact_shipment_performance", "order_id"),
    Column("fact_shipment_performance", "customer_id", parent=_BUYER),
    Column("fact_shipment_performance", "carrier"),
    Column("fact_shipment_performance", "shipping_speed", accepted=_SPEEDS),
    Column("fact_payment_summary", "order_id", unique=True),
    Column("fact_payment_summary", "customer_id", parent=_BUYER),
    Column("fact_payment_summary", "payment_success_rate"),
    Column("fact_payment_summary", "payment_outcome",
           accepted=("CLEAN", "RECOVERED", "ALL_FAILED", "REFUNDED", "NO_PAYMENT")),
    Column("fact_daily_revenue", "revenue_date", unique=True),
    Column("fact_daily_revenue", "total_orders"),
    Column("fact_daily_revenue", "gross_revenue"),
    Column("fact_daily_revenue", "net_revenue"),
]

CONTRACTS = SILVER + GOLD
