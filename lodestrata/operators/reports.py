"""Business reports over the Gold tables and the logs."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.functions.columns import count_where, first_rows, mean, sum_where

Tables = Mapping[str, DataFrame]


# ------------------------------------------------------------------ revenue


def rpt_daily_revenue(gold: Tables) -> DataFrame:
    """Daily rollup of the sales fact; net revenue is paid minus refunded."""
    status, channel = F.col("order_status"), F.col("channel")
    return (
        gold["fact_sales"]
        .groupBy(F.to_date("order_date").alias("revenue_date"))
        .agg(
            F.count("*").alias("total_orders"),
            F.count_distinct("customer_id").alias("unique_customers"),
            F.sum("order_total").alias("gross_revenue"),
            F.sum("net_revenue").alias("net_revenue"),
            mean("order_total").alias("avg_order_value"),
            sum_where(status == "COMPLETED", "order_total").alias("completed_revenue"),
            sum_where(status == "CANCELLED", "order_total").alias("cancelled_revenue"),
            sum_where(status == "RETURNED", "order_total").alias("returned_revenue"),
            count_where(channel == "web").alias("web_orders"),
            count_where(channel == "mobile").alias("mobile_orders"),
            count_where(channel == "in-store").alias("instore_orders"),
            count_where(channel == "phone").alias("phone_orders"),
            F.sum("total_units").alias("total_units_sold"),
            F.sum("total_discount").alias("total_discount"),
        )
        .orderBy("revenue_date")
    )


def rpt_kpis(gold: Tables) -> DataFrame:
    """Six headline numbers; sales are aggregated once, the rest are scalars."""
    def rows(name):
        return gold[name].agg(F.count("*").alias("n")).scalar()

    return (
        gold["fact_sales"]
        .agg(
            F.sum("order_total").alias("total_revenue"),
            F.count("*").alias("total_orders"),
            mean("order_total").alias("avg_order_value"),
            F.sum("total_units").alias("total_units_sold"),
        )
        .select(
            rows("dim_customers").alias("total_customers"),
            "total_revenue",
            "total_orders",
            "avg_order_value",
            rows("dim_products").alias("total_products"),
            "total_units_sold",
        )
    )


def rpt_status_monthly(daily: DataFrame) -> DataFrame:
    """Revenue per month and order status, from the daily report."""
    columns = ["completed_revenue", "cancelled_revenue", "returned_revenue"]
    return (
        daily.unpivot(["revenue_date"], columns, "type", "amount")
        .groupBy(
            F.trunc("revenue_date", "MONTH").alias("month"),
            F.initcap(F.replace("type", F.lit("_revenue"), F.lit(""))).alias("type"),
        )
        .agg(F.sum("amount").alias("amount"))
    )


def rpt_channel_mix(daily: DataFrame) -> DataFrame:
    """Orders per channel, from the daily report."""
    columns = ["web_orders", "mobile_orders", "instore_orders", "phone_orders"]
    return (
        daily.agg(*[F.sum(c).alias(c) for c in columns])
        .unpivot([], columns, "channel", "orders")
        .select(F.initcap(F.replace("channel", F.lit("_orders"), F.lit(""))).alias("channel"),
                "orders")
    )


def rpt_orders_vs_customers(daily: DataFrame) -> DataFrame:
    """Orders and customers per day, one row per day and metric."""
    names = F.create_map(F.lit("total_orders"), F.lit("Orders"),
                         F.lit("unique_customers"), F.lit("Customers"))
    return daily.unpivot(
        ["revenue_date"], ["total_orders", "unique_customers"], "metric", "count"
    ).select("revenue_date", F.element_at(names, F.col("metric")).alias("metric"), "count")


# ---------------------------------------------------------------- customers


def rpt_customer_segments(gold: Tables) -> DataFrame:
    return (
        gold["dim_customers"]
        .groupBy("segment", "loyalty_tier")
        .agg(
            F.count("*").alias("customer_count"),
            F.sum("total_orders").alias("total_orders"),
            F.sum("lifetime_spend").alias("total_spend"),
            # Doubles are summed as decimals so that the order of rows is no matter.
            mean(F.col("avg_order_value").cast("decimal(20,6)")).alias("avg_aov"),
            mean(F.col("cancellation_rate").cast("decimal(5,2)")).alias("avg_cancel_rate"),
        )
        .orderBy(F.desc("total_spend"), "segment", "loyalty_tier")
    )


def rpt_spend_by_segment(segments: DataFrame) -> DataFrame:
    return segments.groupBy("segment").agg(
        F.sum("total_spend").alias("total_spend"), F.sum("customer_count").alias("customer_count")
    )


def rpt_loyalty_mix(segments: DataFrame) -> DataFrame:
    return segments.groupBy("loyalty_tier").agg(F.sum("customer_count").alias("customer_count"))


def rpt_segment_detail(segments: DataFrame, weighted: bool = False) -> DataFrame:
    """Segment totals; averages are means of the group means.

    ``weighted`` weighs each group by its customers instead.
    """
    def average(name):
        value = F.col(name).cast("decimal(20,6)")
        if weighted:
            spread = F.sum(value * F.col("customer_count")).cast("double")
            return spread / F.sum("customer_count")
        return mean(value)

    return (
        segments.groupBy("segment")
        .agg(
            F.sum("customer_count").alias("customer_count"),
            F.sum("total_orders").alias("total_orders"),
            F.sum("total_spend").alias("total_spend"),
            average("avg_aov").alias("avg_aov"),
            average("avg_cancel_rate").alias("avg_cancel_rate"),
        )
        .orderBy(F.desc("total_spend"), "segment")
    )


# ----------------------------------------------------------------- products


def rpt_top_products(gold: Tables) -> DataFrame:
    """All products by revenue."""
    return gold["dim_products"].select(
        "product_id", "product_name", "category", "brand", "price_tier", "sales_tier",
        "total_revenue", "total_units_sold", "orders_with_product", "margin_pct",
        "profit_margin", "stock_quantity", "is_low_stock", "days_of_stock_remaining",
    ).orderBy(F.desc("total_revenue"), "product_id")


def rpt_top15(gold: Tables, k: int = 15) -> DataFrame:
    """The ``k`` products with the highest revenue."""
    return rpt_top_products(gold).limit(k)


def rpt_category_revenue(gold: Tables) -> DataFrame:
    return (
        gold["dim_products"]
        .groupBy("category")
        .agg(F.sum("total_revenue").alias("total_revenue"))
        .orderBy(F.desc("total_revenue"), "category")
    )


def rpt_low_stock(gold: Tables) -> DataFrame:
    return (
        gold["dim_products"]
        .filter("is_low_stock")
        .select("product_id", "product_name", "category", "stock_quantity", "total_units_sold",
                "days_of_stock_remaining")
        .orderBy("stock_quantity", "product_id")
    )


# --------------------------------------------------------------- operations


def rpt_shipment_performance(gold: Tables) -> DataFrame:
    return (
        gold["fact_shipment_performance"]
        .groupBy("carrier", "shipment_status", "shipping_speed")
        .agg(
            F.count("*").alias("shipment_count"),
            mean("delivery_days").alias("avg_delivery_days"),
            mean("days_order_to_ship").alias("avg_days_to_ship"),
            count_where(F.col("is_delayed")).alias("delayed_count"),
            count_where(F.col("is_delivered")).alias("delivered_count"),
        )
        .orderBy(F.desc("shipment_count"), "carrier", "shipment_status", "shipping_speed")
    )


def rpt_carrier_on_time(shipments: DataFrame) -> DataFrame:
    """Per carrier, from the shipment report.

    On-time percent is delivered minus delayed over delivered, as is.
    """
    totals = shipments.groupBy("carrier").agg(
        F.sum("shipment_count").alias("shipment_count"),
        F.sum("delivered_count").alias("delivered_count"),
        F.sum("delayed_count").alias("delayed_count"),
        mean(F.col("avg_delivery_days").cast("decimal(20,6)")).alias("avg_delivery_days"),
    )
    delivered = F.col("delivered_count")
    over = F.when(delivered == 0, 1).otherwise(delivered)
    on_time = (delivered - F.col("delayed_count")).cast("double") / over * 100
    return totals.select("*", on_time.alias("on_time_pct"))


def rpt_speed_mix(shipments: DataFrame) -> DataFrame:
    return shipments.groupBy("shipping_speed").agg(
        F.sum("shipment_count").alias("shipment_count")
    )


def rpt_payment_summary(gold: Tables) -> DataFrame:
    return (
        gold["fact_payment_summary"]
        .groupBy("payment_outcome")
        .agg(
            F.count("*").alias("order_count"),
            F.sum("total_amount_completed").alias("total_completed"),
            F.sum("total_amount_refunded").alias("total_refunded"),
            F.sum("total_amount_failed").alias("total_failed"),
            mean(F.col("payment_success_rate").cast("decimal(5,2)")).alias("avg_success_rate"),
        )
        .orderBy(F.desc("order_count"), "payment_outcome")
    )


def rpt_payment_health(payments: DataFrame) -> DataFrame:
    """Totals over all outcomes; the success rate (0 to 100) is weighted by orders."""
    rate = F.col("avg_success_rate").cast("decimal(20,6)") * F.col("order_count")
    return payments.agg(
        F.sum("total_completed").alias("total_completed"),
        F.sum("total_refunded").alias("total_refunded"),
        F.sum("total_failed").alias("total_failed"),
        (F.sum(rate).cast("double") / F.sum("order_count")).alias("success_rate"),
    )


# ----------------------------------------------------------- pipeline health


def rpt_rfm_segments(rfm: DataFrame) -> DataFrame:
    return (
        rfm.groupBy("rfm_segment")
        .agg(
            F.count("*").alias("customer_count"),
            mean("recency_score").alias("avg_r"),
            mean("frequency_score").alias("avg_f"),
            mean("monetary_score").alias("avg_m"),
        )
        .orderBy(F.desc("customer_count"), "rfm_segment")
    )


def rpt_anomaly_summary(flags: DataFrame) -> DataFrame:
    return (
        flags.groupBy("anomaly_type", "table_name")
        .agg(F.count("*").alias("cnt"))
        .orderBy(F.desc("cnt"), "anomaly_type", "table_name")
    )


def rpt_anomaly_totals(summary: DataFrame) -> DataFrame:
    return summary.agg(
        F.sum("cnt").alias("total_anomalies"), F.count("*").alias("anomaly_types")
    )


def _of_latest_run(log: DataFrame, run: str, time: str) -> DataFrame:
    """Rows of the newest run; the run id is one scalar."""
    newest = log.agg(F.max_by(run, F.struct(time, run)).alias("run")).scalar()
    return log.filter(F.col(run) == newest)


def rpt_latest_profile(profile_log: DataFrame) -> DataFrame:
    return (
        _of_latest_run(profile_log, "profile_run_id", "profiled_at")
        .select("table_name", "column_name", "metric", "metric_value")
        .orderBy("table_name", "column_name", "metric")
    )


def rpt_latest_run(run_log: DataFrame) -> DataFrame:
    return (
        _of_latest_run(run_log, "run_id", "run_timestamp")
        .select("layer", "table_name", "row_count", "run_timestamp")
        .orderBy("layer", "table_name")
    )


def rpt_profile_rows(profile: DataFrame) -> DataFrame:
    """Row counts of the latest profile."""
    return profile.filter(F.col("metric") == "ROW_COUNT").select(
        "table_name", F.col("metric_value").cast("bigint").alias("row_count")
    )


def rpt_profile_nulls(profile: DataFrame, k: int | None = None) -> DataFrame:
    """Columns with NULLs in the latest profile, most first; the first ``k`` if given."""
    return first_rows(
        profile.filter(F.col("metric") == "NULL_PCT")
        .select("table_name", "column_name", F.col("metric_value").cast("double").alias("null_pct"))
        .filter(F.col("null_pct") > 0)
        .orderBy(F.desc("null_pct"), "table_name", "column_name"), k
    )
