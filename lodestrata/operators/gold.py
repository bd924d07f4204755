"""Gold dimensions and facts.

Shape of every model: reduce each child table to one row per join key, then
join.  Each right side is unique on its key, so rows never multiply, and the
reductions leave their output partitioned on the key the join needs.

``unique_orders`` tells a model that order ids do not repeat, which the Bronze
gate checks.  Distinct counts of orders then become plain counts and one
shuffle of the order table goes away.  The default stays exact either way.

Sums of money go through shuffles as whole cents (``cents_sum``), and a distinct count
beside sums has rows of its own: (key, value) pairs join the rows to be summed up as rows without measures.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestrata.functions.columns import (
    cents_mean, cents_sum, cents_where, count_where, days_between, flag, from_halves, half_up, halves, mean, or_zero,
    sum_where,
)

Tables = Mapping[str, DataFrame]

# Least orders and least spend of each loyalty tier.
LOYALTY_TIERS = [(10, 50000, "PLATINUM"), (5, 20000, "GOLD"), (2, 5000, "SILVER")]
LOWEST_LOYALTY_TIER = "BRONZE"
# Revenue each sales tier must exceed.
SALES_TIERS = [(50000, "TOP_SELLER"), (10000, "STRONG"), (0, "ACTIVE")]
LOWEST_SALES_TIER = "NO_SALES"
# Order channels with a daily count of their own.
CHANNEL_COUNTS = {
    "web_orders": "web",
    "mobile_orders": "mobile",
    "instore_orders": "in-store",
    "phone_orders": "phone",
}
# Shipping speeds from fast to slow, for ``slowest_by_rank``.
SPEED_ORDER = ["PENDING", "SAME_DAY", "FAST", "STANDARD", "SLOW"]
# The parity bound of the calendar; ``None`` covers the whole order range.
SPINE_DAYS = 1500


# ---------------------------------------------------------------- customers


def customer_orders(silver: Tables, as_of: dt.date, unique_orders: bool = False) -> DataFrame:
    """Order measures per customer."""
    orders = silver["stg_orders"]
    status_counts = {
        "completed_orders": "COMPLETED",
        "cancelled_orders": "CANCELLED",
        "returned_orders": "RETURNED",
    }
    if unique_orders:
        base = orders
        counts = [F.count("*").alias("total_orders")] + [
            count_where(F.col("status") == status).alias(name)
            for name, status in status_counts.items()
        ]
        rows = F.count("total_amount")
        amount, high, weekend = (
            cents_sum("total_amount", "decimal(22,2)"), count_where(F.col("is_high_value")),
            count_where(F.col("is_weekend_order")),
        )
        first, last = F.min("order_date"), F.max("order_date")
    else:
        # One row per (customer, order) first: a distinct count is then a sum.
        high_part, low_part = halves("total_amount")
        base = orders.groupBy("customer_id", "order_id").agg(
            F.sum(high_part).alias("amount_high"),
            F.sum(low_part).alias("amount_low"),
            F.count("total_amount").alias("amounts"),
            F.min("order_date").alias("first_date"),
            F.max("order_date").alias("last_date"),
            count_where(F.col("is_high_value")).alias("high"),
            count_where(F.col("is_weekend_order")).alias("weekend"),
            *[F.bool_or(F.col("status") == s).alias(n) for n, s in status_counts.items()],
        )
        counts = [F.count("order_id").alias("total_orders")] + [
            count_where(F.col(name)).alias(name) for name in status_counts
        ]
        rows = F.sum("amounts")
        amount = from_halves(F.sum("amount_high"), F.sum("amount_low"), "decimal(32,2)")
        high, weekend = F.sum("high"), F.sum("weekend")
        first, last = F.min("first_date"), F.max("last_date")
    return base.groupBy("customer_id").agg(
        *counts,
        amount.alias("lifetime_spend"),
        (amount.cast("double") / rows).alias("avg_order_value"),
        first.alias("first_order_date"),
        last.alias("last_order_date"),
        days_between(last, F.lit(as_of)).alias("days_since_last_order"),
        high.alias("high_value_order_count"),
        weekend.alias("weekend_order_count"),
    )


def customer_payments(silver: Tables) -> DataFrame:
    """Payment measures per customer, over payments that have an order."""
    owners = silver["stg_orders"].select("order_id", "customer_id")
    return (
        silver["stg_payments"]
        .select("payment_id", "order_id", "status", "amount")
        .join(owners, "order_id")
        .groupBy("customer_id")
        .agg(
            F.count_distinct("payment_id").alias("total_payments"),
            cents_where(F.col("status") == "COMPLETED", "amount", "decimal(22,2)").alias("total_paid"),
            cents_where(F.col("status") == "REFUNDED", "amount", "decimal(22,2)").alias("total_refunded"),
        )
    )


def preferred_channel(silver: Tables) -> DataFrame:
    """Most used channel per customer; the first in name order on a tie.

    Uses are counted by hash and combined map-side, so a customer with a large
    share of the orders is one row per channel and task before the shuffle.  The
    choice among these few rows sorts, as a least text has no fixed width.
    """
    per_channel = silver["stg_orders"].groupBy("customer_id", "channel").agg(
        F.count("*").alias("uses")
    )
    return per_channel.groupBy("customer_id").agg(
        F.min(F.struct((-F.col("uses")).alias("rank"), "channel"))["channel"].alias(
            "preferred_channel"
        )
    )


def _loyalty_tier():
    tier = F
    for orders, spend, name in LOYALTY_TIERS:
        tier = tier.when(
            (F.col("total_orders") >= orders) & (F.col("lifetime_spend") >= spend), name
        )
    return tier.otherwise(LOWEST_LOYALTY_TIER)


def customer_ratios(silver: Tables, as_of: dt.date, unique_orders: bool = False) -> DataFrame:
    """Ratios, net paid and loyalty tier per customer."""
    return dim_customers(silver, as_of, unique_orders).select(
        "customer_id", "cancellation_rate", "avg_days_between_orders", "orders_per_month",
        "net_paid",
    )


def loyalty_tiers(silver: Tables, as_of: dt.date, unique_orders: bool = False) -> DataFrame:
    return dim_customers(silver, as_of, unique_orders).select(
        "customer_id", "total_orders", "lifetime_spend", "loyalty_tier"
    )


def dim_customers(silver: Tables, as_of: dt.date, unique_orders: bool = False) -> DataFrame:
    """One row per staged customer."""
    span = days_between("first_order_date", "last_order_date")
    orders = F.col("total_orders")
    tenure = F.col("customer_tenure_days")
    zero = F.lit(0.0)
    return (
        silver["stg_customers"]
        .join(customer_orders(silver, as_of, unique_orders), "customer_id", "left")
        .join(customer_payments(silver), "customer_id", "left")
        .join(preferred_channel(silver), "customer_id", "left")
        .select(
            "customer_id",
            "first_name",
            "last_name",
            "full_name",
            "email",
            "email_domain",
            "city",
            "state",
            "zip_code",
            "segment",
            F.col("created_at").alias("customer_since"),
            "customer_tenure_days",
            "is_active",
            or_zero("total_orders").alias("total_orders"),
            or_zero("lifetime_spend").alias("lifetime_spend"),
            F.coalesce("avg_order_value", zero).alias("avg_order_value"),
            "first_order_date",
            "last_order_date",
            "days_since_last_order",
            or_zero("completed_orders").alias("completed_orders"),
            or_zero("cancelled_orders").alias("cancelled_orders"),
            or_zero("returned_orders").alias("returned_orders"),
            or_zero("high_value_order_count").alias("high_value_order_count"),
            or_zero("weekend_order_count").alias("weekend_order_count"),
            F.when(
                orders > 0,
                half_up(F.col("cancelled_orders").cast("double") / orders * 100, 2),
            ).otherwise(zero).alias("cancellation_rate"),
            F.when(
                (orders > 1) & (span > 0), half_up(span.cast("double") / (orders - 1), 1)
            ).alias("avg_days_between_orders"),
            F.when(
                tenure > 0,
                half_up(
                    or_zero("total_orders").cast("double") / (tenure.cast("double") / 30.0), 2
                ),
            ).otherwise(zero).alias("orders_per_month"),
            "preferred_channel",
            or_zero("total_paid").alias("total_paid"),
            or_zero("total_refunded").alias("total_refunded"),
            (or_zero("total_paid") - or_zero("total_refunded")).alias("net_paid"),
            _loyalty_tier().alias("loyalty_tier"),
        )
    )


# ----------------------------------------------------------------- products


def _sold_items(silver: Tables) -> DataFrame:
    """Items that have an order, with that order's date and status."""
    orders = silver["stg_orders"].select("order_id", "order_date", "status")
    return silver["stg_order_items"].join(orders, "order_id")


def _items_by_product(silver: Tables):
    """Items that have an order, grouped by product; ``first_in_order`` marks a product's first row in an order.

    Such rows are the product's distinct orders.  Rows of an order lie together behind the join, so the
    marks need no shuffle, and the sums run over plain rows: a distinct count beside them would keep
    every sum once for each product and order, in memory and in a shuffle more.
    """
    in_order = Window.partitionBy("order_id", "product_id").orderBy("order_id")
    return _sold_items(silver).withColumn("first_in_order", F.row_number().over(in_order) == 1).groupBy("product_id")


def _item_measures() -> list:
    """Measures of a product that hang on its items alone."""
    return [
        F.sum("quantity").alias("total_units_sold"),
        cents_sum("line_total", "decimal(28,2)").alias("total_revenue"),
        cents_sum("item_margin", "decimal(28,2)").alias("total_margin"),
        cents_mean("unit_price").alias("avg_selling_price"),
        cents_mean("discount").alias("avg_discount"),
        sum_where(F.col("is_discounted"), "quantity").alias("discounted_units"),
        cents_mean("discount_pct").alias("avg_discount_pct"),
    ]


def _order_measures() -> list:
    """Measures of a product that hang on the orders of its items."""
    return [
        count_where(F.col("first_in_order")).alias("orders_with_product"),
        F.min("order_date").alias("first_sold_date"),
        F.max("order_date").alias("last_sold_date"),
        cents_where(F.col("status") == "RETURNED", "line_total", "decimal(28,2)").alias("returned_revenue"),
    ]


def _sold_products(silver: Tables, items_have_orders: bool = False) -> DataFrame:
    """Measures per product, over items that have an order.

    ``items_have_orders`` tells that each item has one order, which two gates check: then only
    what hangs on the order moves to it, and the measures of the items are summed up where they lie.
    Items without a product are then left out.
    """
    if not items_have_orders:
        return _items_by_product(silver).agg(*_item_measures(), *_order_measures())
    items = silver["stg_order_items"]
    narrow = {**silver, "stg_order_items": items.select("order_id", "product_id", "line_total")}
    ordered = _items_by_product(narrow).agg(*_order_measures())
    return items.groupBy("product_id").agg(*_item_measures()).join(ordered, "product_id")


def _units_per_order():
    orders = F.col("orders_with_product")
    return F.when(orders > 0, half_up(F.col("total_units_sold").cast("double") / orders, 2)).otherwise(
        F.lit(0.0)).alias("avg_units_per_order")


def product_sales(silver: Tables) -> DataFrame:
    """Sales measures per product."""
    return _sold_products(silver).select(
        "product_id",
        "orders_with_product",
        "total_units_sold",
        "total_revenue",
        "total_margin",
        "avg_selling_price",
        "avg_discount",
        "discounted_units",
        "avg_discount_pct",
        _units_per_order(),
        "first_sold_date",
        "last_sold_date",
        days_between("first_sold_date", "last_sold_date").alias("selling_span_days"),
    )


def return_exposure(silver: Tables) -> DataFrame:
    """Revenue on returned orders per product; products without any are absent."""
    return (
        _sold_items(silver)
        .filter(F.col("status") == "RETURNED")
        .groupBy("product_id")
        .agg(F.sum("line_total").alias("returned_revenue"))
    )


def product_inventory(silver: Tables) -> DataFrame:
    """Turnover, stock cover and sales tier per product."""
    return dim_products(silver).select(
        "product_id", "inventory_turnover", "days_of_stock_remaining", "sales_tier"
    )


def dim_products(silver: Tables, items_have_orders: bool = False) -> DataFrame:
    """One row per staged product.

    Returned revenue is one more sum over the same items, so the item and
    order tables are joined once, not once per measure group.
    """
    sales = _sold_products(silver, items_have_orders).select(
        "*", _units_per_order(), days_between("first_sold_date", "last_sold_date").alias("selling_span_days"))
    units, stock, span = F.col("total_units_sold"), F.col("stock_quantity"), F.col(
        "selling_span_days"
    )
    tier = F
    for bound, name in SALES_TIERS:
        tier = tier.when(F.col("total_revenue") > bound, name)
    zero = F.lit(0.0)
    return silver["stg_products"].join(sales, "product_id", "left").select(
        "product_id",
        "product_name",
        "category",
        "subcategory",
        "brand",
        "unit_price",
        "cost_price",
        "profit_margin",
        "margin_pct",
        "price_tier",
        "stock_quantity",
        "is_low_stock",
        or_zero("total_units_sold").alias("total_units_sold"),
        or_zero("total_revenue").alias("total_revenue"),
        or_zero("total_margin").alias("total_margin"),
        or_zero("orders_with_product").alias("orders_with_product"),
        F.coalesce("avg_selling_price", zero).alias("avg_selling_price"),
        F.coalesce("avg_discount", zero).alias("avg_discount"),
        F.coalesce("avg_discount_pct", zero).alias("avg_discount_pct"),
        or_zero("discounted_units").alias("discounted_units"),
        F.coalesce("avg_units_per_order", zero).alias("avg_units_per_order"),
        "first_sold_date",
        "last_sold_date",
        or_zero("selling_span_days").alias("selling_span_days"),
        or_zero("returned_revenue").alias("returned_revenue"),
        F.when((units > 0) & (stock > 0), half_up(units.cast("double") / stock, 2))
        .otherwise(zero)
        .alias("inventory_turnover"),
        F.when(
            (units > 0) & (span > 0),
            half_up(stock.cast("double") / (units.cast("double") / span), 0),
        ).alias("days_of_stock_remaining"),
        tier.otherwise(LOWEST_SALES_TIER).alias("sales_tier"),
        "created_at",
    )


# -------------------------------------------------------------------- dates


def date_spine(bounds: DataFrame, max_days: int | None = None) -> DataFrame:
    """One row per day of the one-row frame ``bounds(lo, hi)``."""
    last = F.col("hi")
    if max_days is not None:
        last = F.least(last, F.date_add("lo", max_days - 1))
    return (
        bounds.filter(F.col("lo").isNotNull() & F.col("hi").isNotNull())
        .select(F.explode(F.sequence("lo", last)).alias("date_key"))
    )


def order_date_bounds(silver: Tables) -> DataFrame:
    return silver["stg_orders"].agg(
        F.to_date(F.min("order_date")).alias("lo"), F.to_date(F.max("order_date")).alias("hi")
    )


def dim_dates(silver: Tables, max_days: int | None = None) -> DataFrame:
    """Calendar from the first to the last order date."""
    day = F.col("date_key")
    # The fiscal year starts in April.
    fiscal = (F.quarter(day) + 2) % 4 + 1
    return date_spine(order_date_bounds(silver), max_days).select(
        "date_key",
        day.alias("full_date"),
        (F.dayofweek(day) - 1).alias("day_of_week"),
        F.dayname(day).alias("day_name"),
        F.dayofweek(day).isin(1, 7).alias("is_weekend"),
        F.dayofmonth(day).alias("day_of_month"),
        F.weekofyear(day).alias("week_of_year"),
        F.month(day).alias("month_num"),
        F.monthname(day).alias("month_name"),
        F.quarter(day).alias("quarter_num"),
        F.concat(F.lit("Q"), F.quarter(day)).alias("quarter_name"),
        F.year(day).alias("year_num"),
        F.concat(F.lit("FQ"), fiscal).alias("fiscal_quarter"),
        F.trunc(day, "MONTH").alias("first_day_of_month"),
        F.last_day(day).alias("last_day_of_month"),
    )


# -------------------------------------------------------------------- facts


def order_items_agg(silver: Tables) -> DataFrame:
    """Item measures per order.

    The different products of an order are rows beside its items, so the items of an order are one row
    per task before they move; a distinct count would carry every sum once for each order and product.
    """
    items = silver["stg_order_items"]
    products = items.filter(F.col("product_id").isNotNull()).select("order_id", "product_id").distinct()
    rows = items.select(
        "order_id", F.lit(True).alias("is_item"), "quantity", "line_total", "discount", "item_margin", "discount_pct",
        "is_discounted",
    ).unionByName(products, allowMissingColumns=True)
    return rows.groupBy("order_id").agg(
        count_where(F.col("is_item")).alias("line_item_count"),
        F.sum("quantity").alias("total_units"),
        cents_sum("line_total", "decimal(28,2)").alias("items_total"),
        cents_sum("discount", "decimal(20,2)").alias("total_discount"),
        cents_sum("item_margin", "decimal(28,2)").alias("total_item_margin"),
        F.count("product_id").alias("unique_products"),
        cents_mean("discount_pct").alias("avg_discount_pct"),
        count_where(F.col("is_discounted")).alias("discounted_line_items"),
    )


def _distinct_list(name: str):
    """Distinct values in order, as one text; empty when all are NULL.

    The sets merge map-side and hold distinct values only, so their size
    follows the number of methods and not the number of payments.
    """
    return F.array_join(F.array_sort(F.collect_set(name)), ", ")


def payment_agg(silver: Tables) -> DataFrame:
    """Payment measures per order, for the sales fact."""
    amount = {"amount_paid": "COMPLETED", "amount_refunded": "REFUNDED", "amount_failed": "FAILED"}
    return silver["stg_payments"].groupBy("order_id").agg(
        F.count("*").alias("payment_count"),
        *[cents_where(F.col("status") == s, "amount", "decimal(22,2)").alias(n) for n, s in amount.items()],
        _distinct_list("payment_method").alias("payment_methods"),
        _distinct_list("payment_method_group").alias("payment_method_groups"),
    )


def shipment_info(silver: Tables, slowest_by_rank: bool = False) -> DataFrame:
    """Shipment measures per order.

    ``slowest_shipping_speed`` is the greatest text by default;
    ``slowest_by_rank`` takes the slowest speed instead.
    """
    slowest = F.max("shipping_speed")
    if slowest_by_rank:
        ranks = F.array(*[F.lit(s) for s in SPEED_ORDER])
        last = F.max(F.array_position(ranks, F.col("shipping_speed")))
        slowest = F.element_at(ranks, last.cast("int"))
    return silver["stg_shipments"].groupBy("order_id").agg(
        F.min("ship_date").alias("first_ship_date"),
        F.max("delivery_date").alias("last_delivery_date"),
        F.max("status").alias("shipment_status"),
        mean("delivery_days").alias("avg_delivery_days"),
        F.bool_or("is_delayed").alias("has_delayed_shipment"),
        slowest.alias("slowest_shipping_speed"),
    )


def customer_order_counts(silver: Tables) -> DataFrame:
    """Distinct orders per customer and whether there is more than one."""
    return (
        silver["stg_orders"]
        .groupBy("customer_id")
        .agg(F.count_distinct("order_id").alias("customer_total_orders"))
        .withColumn("is_repeat_customer", F.col("customer_total_orders") > 1)
    )


def sales_derived(silver: Tables) -> DataFrame:
    """The derived columns of the sales fact."""
    return fact_sales(silver).select(
        "order_id", "net_revenue", "is_profitable", "days_to_ship", "days_to_deliver",
        "is_repeat_customer", "order_month", "order_quarter", "order_year",
    )


def _only_orders(silver: Tables) -> DataFrame:
    """The order of each customer who has just one.

    The least and the greatest order id are equal exactly when there is one
    distinct id, so no distinct count is needed.
    """
    return (
        silver["stg_orders"]
        .groupBy("customer_id")
        .agg(F.min("order_id").alias("only_order"), F.max("order_id").alias("last_order"))
        .filter(F.col("only_order") == F.col("last_order"))
        .select("only_order", F.col("customer_id").alias("only_buyer"))
    )


def fact_sales(silver: Tables, slowest_by_rank: bool = False) -> DataFrame:
    """One row per staged order.

    The customer columns come first, while the order rows are narrow; both
    sides of that join are plain tables, so Spark can split a customer with
    very many orders.  Everything else joins on the order: the reductions
    bring the partitioning with them, and the repeat flag asks whether the
    order is its customer's only one instead of joining on the customer again.
    """
    buyers = silver["stg_customers"].select(
        "customer_id",
        F.col("full_name").alias("customer_name"),
        F.col("segment").alias("customer_segment"),
        F.col("state").alias("customer_state"),
        F.col("is_active").alias("is_active_customer"),
    )
    orders = silver["stg_orders"].drop("days_since_order").join(buyers, "customer_id", "left")
    # The difference keeps the customer out of the join keys, which would
    # otherwise move the orders once more.
    same_order = (F.col("order_id") == F.col("only_order")) & (
        (F.col("customer_id") <= F.col("only_buyer")) & (F.col("customer_id") >= F.col("only_buyer"))
    )
    net = or_zero("amount_paid") - or_zero("amount_refunded")
    return (
        orders.join(_only_orders(silver), same_order, "left")
        .join(order_items_agg(silver), "order_id", "left")
        .join(payment_agg(silver), "order_id", "left")
        .join(shipment_info(silver, slowest_by_rank), "order_id", "left")
        .select(
            "order_id",
            "customer_id",
            "customer_name",
            "customer_segment",
            "customer_state",
            "is_active_customer",
            "order_date",
            F.col("status").alias("order_status"),
            "channel",
            F.col("total_amount").alias("order_total"),
            "is_high_value",
            "is_weekend_order",
            "order_day_of_week",
            or_zero("line_item_count").alias("line_item_count"),
            or_zero("total_units").alias("total_units"),
            or_zero("items_total").alias("items_total"),
            or_zero("total_discount").alias("total_discount"),
            or_zero("total_item_margin").alias("total_item_margin"),
            or_zero("unique_products").alias("unique_products"),
            F.coalesce("avg_discount_pct", F.lit(0.0)).alias("avg_discount_pct"),
            or_zero("discounted_line_items").alias("discounted_line_items"),
            or_zero("payment_count").alias("payment_count"),
            or_zero("amount_paid").alias("amount_paid"),
            or_zero("amount_refunded").alias("amount_refunded"),
            or_zero("amount_failed").alias("amount_failed"),
            "payment_methods",
            "payment_method_groups",
            net.alias("net_revenue"),
            (net > 0).alias("is_profitable"),
            "first_ship_date",
            "last_delivery_date",
            "shipment_status",
            "avg_delivery_days",
            flag(F.col("has_delayed_shipment")).alias("has_delayed_shipment"),
            "slowest_shipping_speed",
            days_between("order_date", "first_ship_date").alias("days_to_ship"),
            days_between("order_date", "last_delivery_date").alias("days_to_deliver"),
            F.col("only_buyer").isNull().alias("is_repeat_customer"),
            F.trunc("order_date", "MONTH").alias("order_month"),
            F.trunc("order_date", "QUARTER").alias("order_quarter"),
            F.year("order_date").alias("order_year"),
        )
    )


def fact_shipment_performance(silver: Tables) -> DataFrame:
    """One row per shipment that has an order.

    Customer columns join the orders first: there are fewer orders than
    shipments, and the wider side is then shuffled once.
    """
    buyers = silver["stg_customers"].select(
        "customer_id",
        F.col("segment").alias("customer_segment"),
        F.col("state").alias("customer_state"),
    )
    orders = (
        silver["stg_orders"]
        .select(
            "order_id",
            "customer_id",
            F.col("channel").alias("order_channel"),
            F.col("total_amount").alias("order_value"),
            F.col("is_high_value").alias("is_high_value_order"),
            "order_date",
        )
        .join(buyers, "customer_id", "left")
    )
    return silver["stg_shipments"].join(orders, "order_id").select(
        "shipment_id",
        "order_id",
        "customer_id",
        "customer_segment",
        "customer_state",
        "order_channel",
        "order_value",
        "is_high_value_order",
        "order_date",
        "ship_date",
        "delivery_date",
        "carrier",
        F.col("status").alias("shipment_status"),
        "tracking_number",
        "delivery_days",
        "is_delayed",
        "is_delivered",
        "shipping_speed",
        days_between("order_date", "ship_date").alias("days_order_to_ship"),
        days_between("order_date", "delivery_date").alias("days_order_to_delivery"),
        F.trunc("ship_date", "MONTH").alias("ship_month"),
        F.year("ship_date").alias("ship_year"),
    )


def payment_outcome(failed, completed, refunded):
    """Outcome of an order from its attempt counts; the first match wins."""
    return (
        F.when((failed > 0) & (completed > 0), "RECOVERED")
        .when((failed > 0) & (completed == 0), "ALL_FAILED")
        .when(refunded > 0, "REFUNDED")
        .when(completed > 0, "CLEAN")
        .otherwise("NO_PAYMENT")
    )


def payment_outcomes(silver: Tables) -> DataFrame:
    return fact_payment_summary(silver).select(
        "order_id", "completed_payments", "failed_payments", "refunded_payments",
        "pending_payments", "payment_outcome",
    )


def fact_payment_summary(silver: Tables) -> DataFrame:
    """One row per staged order with its payment attempts."""
    status = F.col("status")
    done = count_where(status == "COMPLETED")
    attempts = silver["stg_payments"].groupBy("order_id").agg(
        F.count("*").alias("attempts"),
        done.alias("completed"),
        count_where(status == "FAILED").alias("failed"),
        count_where(status == "REFUNDED").alias("refunded"),
        count_where(status == "PENDING").alias("pending"),
        cents_sum("amount", "decimal(22,2)").alias("total_amount_attempted"),
        cents_where(status == "COMPLETED", "amount", "decimal(22,2)").alias("total_amount_completed"),
        cents_where(status == "FAILED", "amount", "decimal(22,2)").alias("total_amount_failed"),
        cents_where(status == "REFUNDED", "amount", "decimal(22,2)").alias("total_amount_refunded"),
        half_up(done.cast("double") / F.count("*") * 100, 2).alias("payment_success_rate"),
        _distinct_list("payment_method").alias("payment_methods_used"),
        _distinct_list("payment_method_group").alias("payment_groups_used"),
        F.min("payment_date").alias("first_payment_date"),
        F.max("payment_date").alias("last_payment_date"),
    )
    orders = silver["stg_orders"].select(
        "order_id", "customer_id", "order_date", F.col("status").alias("order_status"), "channel",
        F.col("total_amount").alias("order_total"),
    )
    return orders.join(attempts, "order_id", "left").select(
        "order_id",
        "customer_id",
        "order_date",
        "order_status",
        "channel",
        "order_total",
        or_zero("attempts").alias("total_payment_attempts"),
        or_zero("completed").alias("completed_payments"),
        or_zero("failed").alias("failed_payments"),
        or_zero("refunded").alias("refunded_payments"),
        or_zero("pending").alias("pending_payments"),
        or_zero("total_amount_attempted").alias("total_amount_attempted"),
        or_zero("total_amount_completed").alias("total_amount_completed"),
        or_zero("total_amount_failed").alias("total_amount_failed"),
        or_zero("total_amount_refunded").alias("total_amount_refunded"),
        F.coalesce("payment_success_rate", F.lit(0.0)).alias("payment_success_rate"),
        "payment_methods_used",
        "payment_groups_used",
        "first_payment_date",
        "last_payment_date",
        payment_outcome(F.col("failed"), F.col("completed"), F.col("refunded")).alias(
            "payment_outcome"
        ),
    )


def _daily_orders(silver: Tables, unique_orders: bool) -> DataFrame:
    """Order measures per day.

    The different customers of a day are rows beside its orders, so the orders of a day are
    one row per task before they move.  Distinct orders come from (day, order) rows, or from a
    plain count when order ids are known not to repeat.
    """
    orders = silver["stg_orders"].withColumn("revenue_date", F.to_date("order_date"))
    status = F.col("status")
    order_counts = []
    if unique_orders:
        order_counts = [count_where(F.col("is_order")).alias("total_orders")] + [
            count_where(F.col("channel") == c).alias(n) for n, c in CHANNEL_COUNTS.items()
        ]
    buyers = orders.filter(F.col("customer_id").isNotNull()).select("revenue_date", "customer_id").distinct()
    rows = orders.select(
        "revenue_date", F.lit(True).alias("is_order"), "status", "channel", "total_amount", "is_high_value",
        "is_weekend_order",
    ).unionByName(buyers, allowMissingColumns=True)
    days = rows.groupBy("revenue_date").agg(
        F.count("customer_id").alias("unique_customers"),
        F.sum("total_amount").alias("gross_revenue"),
        mean("total_amount").alias("avg_order_value"),
        F.min("total_amount").alias("min_order_value"),
        F.max("total_amount").alias("max_order_value"),
        count_where(F.col("is_high_value")).alias("high_value_orders"),
        count_where(F.col("is_weekend_order")).alias("weekend_orders"),
        sum_where(status == "COMPLETED", "total_amount").alias("completed_revenue"),
        sum_where(status == "CANCELLED", "total_amount").alias("cancelled_revenue"),
        sum_where(status == "RETURNED", "total_amount").alias("returned_revenue"),
        *order_counts,
    )
    if unique_orders:
        return days
    counts = (
        orders.groupBy("revenue_date", "order_id")
        .agg(*[F.bool_or(F.col("channel") == c).alias(n) for n, c in CHANNEL_COUNTS.items()])
        .groupBy(F.col("revenue_date").alias("count_date"))
        .agg(
            F.count("order_id").alias("total_orders"),
            *[count_where(F.col(n)).alias(n) for n in CHANNEL_COUNTS],
        )
    )
    # A NULL day is a group of its own and must find its counts again.
    return days.join(counts, F.col("revenue_date").eqNullSafe(F.col("count_date"))).drop(
        "count_date"
    )


def _daily_items(silver: Tables) -> DataFrame:
    """Item measures per day, over items that have an order.

    Behind the join an item becomes two rows, one with its measures and one with its product.  Those of a
    day's measures are one per task before they move, and those of its products hold nothing else.
    """
    days = silver["stg_orders"].select("order_id", F.to_date("order_date").alias("revenue_date"))
    parts = {"quantity": F.col("quantity")}
    for name in ("discount", "line_total", "item_margin"):
        parts[f"{name}_high"], parts[f"{name}_low"] = halves(name)
    none = F.lit(None).cast("bigint")
    rows = F.array(
        F.struct(none.alias("product"), *[part.alias(name) for name, part in parts.items()]),
        F.struct(F.col("product_id").alias("product"), *[none.alias(name) for name in parts]),
    )
    sums = (
        silver["stg_order_items"].join(days, "order_id").select("revenue_date", F.inline(rows))
        .groupBy("revenue_date", "product").agg(*[F.sum(name).alias(name) for name in parts])
    )

    def total(name, kind):
        return from_halves(F.sum(f"{name}_high"), F.sum(f"{name}_low"), kind)

    return sums.groupBy("revenue_date").agg(
        F.sum("quantity").alias("total_units_sold"),
        total("discount", "decimal(20,2)").alias("total_discount"),
        total("line_total", "decimal(28,2)").alias("total_line_revenue"),
        total("item_margin", "decimal(28,2)").alias("total_item_margin"),
        F.count("product").alias("unique_products_sold"),
    )


def fact_daily_revenue(silver: Tables, unique_orders: bool = False) -> DataFrame:
    """One row per day with orders, in day order."""
    net = F.col("gross_revenue") - F.col("cancelled_revenue") - F.col("returned_revenue")
    return (
        _daily_orders(silver, unique_orders)
        .join(_daily_items(silver), "revenue_date", "left")
        .select(
            "revenue_date",
            "total_orders",
            "unique_customers",
            "gross_revenue",
            "avg_order_value",
            "min_order_value",
            "max_order_value",
            "high_value_orders",
            "weekend_orders",
            "completed_revenue",
            "cancelled_revenue",
            "returned_revenue",
            net.alias("net_revenue"),
            *CHANNEL_COUNTS,
            or_zero("total_units_sold").alias("total_units_sold"),
            or_zero("total_discount").alias("total_discount"),
            or_zero("total_line_revenue").alias("total_line_revenue"),
            or_zero("total_item_margin").alias("total_item_margin"),
            or_zero("unique_products_sold").alias("unique_products_sold"),
        )
        .orderBy("revenue_date")
    )


def gold_models(
    silver: Tables, as_of: dt.date, unique_orders: bool = False, max_days: int | None = None,
    items_have_orders: bool = False,
) -> dict[str, Callable[[], DataFrame]]:
    """How to build each Gold table; nothing is planned before the call."""
    return {
        "dim_customers": lambda: dim_customers(silver, as_of, unique_orders),
        "dim_products": lambda: dim_products(silver, items_have_orders),
        "dim_dates": lambda: dim_dates(silver, max_days),
        "fact_sales": lambda: fact_sales(silver),
        "fact_daily_revenue": lambda: fact_daily_revenue(silver, unique_orders),
        "fact_payment_summary": lambda: fact_payment_summary(silver),
        "fact_shipment_performance": lambda: fact_shipment_performance(silver),
    }


def build_gold(
    silver: Tables, as_of: dt.date, unique_orders: bool = False, max_days: int | None = None,
    items_have_orders: bool = False,
) -> dict[str, DataFrame]:
    models = gold_models(silver, as_of, unique_orders, max_days, items_have_orders)
    return {name: build() for name, build in models.items()}
