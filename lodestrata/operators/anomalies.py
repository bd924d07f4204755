"""Anomaly flags over the Silver tables."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.functions.columns import days_between, moment
from lodestrata.functions.order_stats import order_statistics

IQR_FACTOR = Decimal("1.5")
DISCOUNT_LIMIT_PCT = 50
TENURE_DAYS = 365
IDLE_DAYS = 90


def _flag_row(table: str, record, kind: str, details: Column) -> list[Column]:
    return [
        F.lit(table).alias("table_name"),
        F.col(record).cast("string").alias("record_id"),
        F.lit(kind).alias("anomaly_type"),
        details.alias("details"),
    ]


def amount_quartiles(stg_orders: DataFrame) -> DataFrame:
    """One row ``q1, q3``: interpolated quartiles of the amounts, exact.

    Quartile p lies at position p * (n - 1); the neighbours below and above
    are order statistics, and a quarter step between two cent amounts fits
    four decimals.
    """
    total = F.col("total")
    ranks = {}
    for tag, quarters in (("q1", 1), ("q3", 3)):
        ranks[f"{tag}_lo"] = F.floor((total - 1) * quarters / 4)
        ranks[f"{tag}_hi"] = F.ceil((total - 1) * quarters / 4)
    values = stg_orders.select(
        F.lit("amount").alias("grp"), (F.col("total_amount") * 100).cast("bigint").alias("v")
    )
    found = order_statistics(values, ranks)

    def at(tag):
        return F.max(F.when(F.col("tag") == tag, F.col("v")))

    row = found.agg(F.max("total").alias("n"), *[at(tag).alias(tag) for tag in ranks])

    def quartile(tag, quarters):
        quarter_steps = (F.col("n") - 1) * quarters % 4
        step = (F.col(f"{tag}_hi") - F.col(f"{tag}_lo")) * quarter_steps
        return ((F.col(f"{tag}_lo") * 4 + step).cast("decimal(20,0)") * Decimal("0.0025")).cast(
            "decimal(20,4)"
        )

    return row.select(quartile("q1", 1).alias("q1"), quartile("q3", 3).alias("q3"))


def iqr_outliers(stg_orders: DataFrame, k: Decimal = IQR_FACTOR) -> DataFrame:
    """Orders whose amount lies outside the quartile bounds."""
    reach = F.lit(Decimal(k)) * (F.col("q3") - F.col("q1"))
    bounds = amount_quartiles(stg_orders).select(
        F.struct((F.col("q1") - reach).alias("low"), (F.col("q3") + reach).alias("high"))
    )
    amount = F.col("total_amount")
    details = F.concat(
        F.lit("Amount $"), amount.cast("string"), F.lit(" outside IQR bounds [$"),
        F.col("bounds.low").cast("decimal(18,2)").cast("string"), F.lit(", $"),
        F.col("bounds.high").cast("decimal(18,2)").cast("string"), F.lit("]"),
    )
    return (
        stg_orders.select("order_id", "total_amount", bounds.scalar().alias("bounds"))
        .filter((amount < F.col("bounds.low")) | (amount > F.col("bounds.high")))
        .select(*_flag_row("STG_ORDERS", "order_id", "AMOUNT_OUTLIER", details))
    )


def high_discount(stg_order_items: DataFrame, pct: int = DISCOUNT_LIMIT_PCT) -> DataFrame:
    """Order items discounted by more than ``pct`` percent."""
    details = F.concat(
        F.lit("Discount "), F.col("discount_pct").cast("string"),
        F.lit(f"% exceeds {pct}% threshold (order_item_id="),
        F.col("order_item_id").cast("string"), F.lit(")"),
    )
    return stg_order_items.filter(F.col("discount_pct") > pct).select(
        *_flag_row("STG_ORDER_ITEMS", "order_item_id", "HIGH_DISCOUNT", details)
    )


def dormant_customers(
    stg_customers: DataFrame, stg_orders: DataFrame, as_of: dt.date,
    tenure: int = TENURE_DAYS, idle: int = IDLE_DAYS,
) -> DataFrame:
    """Customers of long standing without a recent order."""
    last = stg_orders.groupBy("customer_id").agg(F.max("order_date").alias("last_order"))
    details = F.lit(f"Tenure >{tenure} days with no orders in last {idle} days")
    return (
        stg_customers.filter(F.col("customer_tenure_days") > tenure)
        .select("customer_id")
        .join(last, "customer_id", "left")
        .filter(
            F.col("last_order").isNull()
            | (days_between("last_order", F.lit(as_of)) > idle)
        )
        .select(*_flag_row("STG_CUSTOMERS", "customer_id", "DORMANT_CUSTOMER", details))
    )


def anomaly_flags(
    silver: dict[str, DataFrame], as_of: dt.date, run_id: str, ts: dt.datetime
) -> DataFrame:
    """All flags of one run.

    The flag id is a digest of the run and the flagged record, so a task that
    runs twice gives the same id.
    """
    flags = (
        iqr_outliers(silver["stg_orders"])
        .unionByName(high_discount(silver["stg_order_items"]))
        .unionByName(dormant_customers(silver["stg_customers"], silver["stg_orders"], as_of))
    )
    key = F.concat_ws("|", F.lit(run_id), "table_name", "record_id", "anomaly_type")
    return flags.select(
        F.md5(key).alias("anomaly_id"), "table_name", "record_id", "anomaly_type", "details",
        moment(ts).alias("detected_at"),
    )
