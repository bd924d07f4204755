"""Silver staging models: clean, filter and derive.

Each model maps the Bronze tables to one staging table at the same grain.
All are narrow except the two that look up a parent column.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.functions.columns import (
    clean, clean_lower, clean_upper, days_between, decimal_pct, flag,
)

Tables = Mapping[str, DataFrame]

# Eighteen digits is the widest decimal kept as one long, in rows and in files.
MONEY = "decimal(18,2)"

HIGH_VALUE_AMOUNT = 5000
ACTIVE_TENURE_DAYS = 365
LOW_STOCK_UNITS = 100
DELAYED_AFTER_DAYS = 7
# Upper price bound (exclusive) of each tier but the last.
PRICE_TIERS = [(200, "BUDGET"), (500, "MID_RANGE"), (800, "PREMIUM")]
TOP_PRICE_TIER = "LUXURY"
# Payment methods of each group; any other method is OTHER.
METHOD_GROUPS = {
    "CARD": ["credit_card", "debit_card"],
    "DIGITAL": ["paypal", "google_pay"],
    "GIFT_CARD": ["gift_card"],
}
# Most delivery days of each speed; above the last is SLOW.
SPEEDS = [(1, "SAME_DAY"), (3, "FAST"), (7, "STANDARD")]


def stg_customers(bronze: Tables, as_of: dt.date) -> DataFrame:
    tenure = days_between("created_at", F.lit(as_of))
    email = clean_lower("email")
    return (
        bronze["customers"]
        .filter(F.col("customer_id").isNotNull() & F.col("email").isNotNull())
        .select(
            "customer_id",
            clean("first_name").alias("first_name"),
            clean("last_name").alias("last_name"),
            F.concat(clean("first_name"), F.lit(" "), clean("last_name")).alias("full_name"),
            email.alias("email"),
            F.split_part(email, F.lit("@"), F.lit(2)).alias("email_domain"),
            clean("phone").alias("phone"),
            clean("city").alias("city"),
            clean_upper("state").alias("state"),
            clean("zip_code").alias("zip_code"),
            clean_upper("segment").alias("segment"),
            "created_at",
            tenure.alias("customer_tenure_days"),
            flag(tenure <= ACTIVE_TENURE_DAYS).alias("is_active"),
        )
    )


def stg_orders(bronze: Tables, as_of: dt.date) -> DataFrame:
    return (
        bronze["orders"]
        .filter(
            F.col("order_id").isNotNull()
            & F.col("customer_id").isNotNull()
            & (F.col("total_amount") >= 0)
        )
        .select(
            "order_id",
            "customer_id",
            "order_date",
            clean_upper("status").alias("status"),
            clean_lower("channel").alias("channel"),
            "total_amount",
            days_between("order_date", F.lit(as_of)).alias("days_since_order"),
            flag(F.col("total_amount") > HIGH_VALUE_AMOUNT).alias("is_high_value"),
            F.dayname("order_date").alias("order_day_of_week"),
            flag(F.dayofweek("order_date").isin(1, 7)).alias("is_weekend_order"),
        )
    )


def stg_order_items(bronze: Tables, as_of: dt.date | None = None) -> DataFrame:
    costs = bronze["products"].filter(F.col("product_id").isNotNull()).select(
        "product_id", "cost_price"
    )
    gross = F.col("quantity") * F.col("unit_price")
    discount = F.coalesce("discount", F.lit(0).cast("decimal(10,2)"))
    cost = F.col("quantity") * F.coalesce("cost_price", F.lit(0).cast("decimal(10,2)"))
    return (
        bronze["order_items"]
        .drop("line_total")
        .filter(
            F.col("order_item_id").isNotNull()
            & F.col("order_id").isNotNull()
            & (F.col("quantity") > 0)
            & (F.col("unit_price") >= 0)
        )
        .join(costs, "product_id", "left")
        .select(
            "order_item_id",
            "order_id",
            "product_id",
            "quantity",
            "unit_price",
            discount.alias("discount"),
            (gross - discount).cast(MONEY).alias("line_total"),
            F.when(gross > 0, decimal_pct(discount, gross))
            .otherwise(F.lit(0).cast("decimal(18,2)"))
            .alias("discount_pct"),
            (discount > 0).alias("is_discounted"),
            (gross - discount - cost).cast(MONEY).alias("item_margin"),
        )
    )


def stg_products(bronze: Tables, as_of: dt.date | None = None) -> DataFrame:
    margin = F.col("unit_price") - F.col("cost_price")
    tier = F
    for bound, name in PRICE_TIERS:
        tier = tier.when(F.col("unit_price") < bound, name)
    return (
        bronze["products"]
        .filter(
            F.col("product_id").isNotNull()
            & (F.col("unit_price") > 0)
            & (F.col("cost_price") >= 0)
        )
        .select(
            "product_id",
            clean("product_name").alias("product_name"),
            clean_upper("category").alias("category"),
            clean_upper("subcategory").alias("subcategory"),
            clean("brand").alias("brand"),
            "unit_price",
            "cost_price",
            "stock_quantity",
            margin.alias("profit_margin"),
            decimal_pct(margin, F.nullif("unit_price", F.lit(0))).alias("margin_pct"),
            tier.otherwise(TOP_PRICE_TIER).alias("price_tier"),
            flag(F.col("stock_quantity") < LOW_STOCK_UNITS).alias("is_low_stock"),
            "created_at",
        )
    )


def stg_payments(bronze: Tables, as_of: dt.date | None = None) -> DataFrame:
    order_dates = bronze["orders"].filter(F.col("order_id").isNotNull()).select(
        "order_id", "order_date"
    )
    method = clean_lower("payment_method")
    group = F
    for name, methods in METHOD_GROUPS.items():
        group = group.when(method.isin(methods), name)
    return (
        bronze["payments"]
        .filter(
            F.col("payment_id").isNotNull()
            & F.col("order_id").isNotNull()
            & (F.col("amount") >= 0)
        )
        .join(order_dates, "order_id", "left")
        .select(
            "payment_id",
            "order_id",
            method.alias("payment_method"),
            group.otherwise("OTHER").alias("payment_method_group"),
            "amount",
            "payment_date",
            clean_upper("status").alias("status"),
            flag(clean_upper("status") == "COMPLETED").alias("is_successful"),
            days_between("order_date", "payment_date").alias("days_to_payment"),
        )
    )


def stg_shipments(bronze: Tables, as_of: dt.date | None = None) -> DataFrame:
    days = days_between("ship_date", "delivery_date")
    speed = F.when(F.col("delivery_date").isNull(), "PENDING")
    for most, name in SPEEDS:
        speed = speed.when(days <= most, name)
    return (
        bronze["shipments"]
        .filter(
            F.col("shipment_id").isNotNull()
            & F.col("order_id").isNotNull()
            & F.col("ship_date").isNotNull()
        )
        .select(
            "shipment_id",
            "order_id",
            clean_upper("carrier").alias("carrier"),
            clean("tracking_number").alias("tracking_number"),
            "ship_date",
            "delivery_date",
            clean_upper("status").alias("status"),
            days.alias("delivery_days"),
            flag(days > DELAYED_AFTER_DAYS).alias("is_delayed"),
            flag(clean_upper("status") == "DELIVERED").alias("is_delivered"),
            speed.otherwise("SLOW").alias("shipping_speed"),
        )
    )


MODELS: dict[str, Callable[[Tables, dt.date], DataFrame]] = {
    "stg_customers": stg_customers,
    "stg_orders": stg_orders,
    "stg_order_items": stg_order_items,
    "stg_products": stg_products,
    "stg_payments": stg_payments,
    "stg_shipments": stg_shipments,
}


def build_silver(bronze: Tables, as_of: dt.date) -> dict[str, DataFrame]:
    return {name: model(bronze, as_of) for name, model in MODELS.items()}
