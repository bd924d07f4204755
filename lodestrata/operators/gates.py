"""Validation gates between the layers.

A gate measures its tables with one-row aggregates, stacks them, and turns
the stack into one row of named numbers.  The checks read that row.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.functions.columns import count_where

Tables = Mapping[str, DataFrame]

# Accepted classifications.
LOYALTY_VALUES = ["PLATINUM", "GOLD", "SILVER", "BRONZE"]
OUTCOME_VALUES = ["CLEAN", "RECOVERED", "ALL_FAILED", "REFUNDED", "NO_PAYMENT"]
# Keys that the first gate proves unique.
UNIQUE_KEYS = {
    "orders": ["order_id"], "customers": ["customer_id"], "products": ["product_id"],
}
# Message of a gate without failures.
PASS_TEXTS = {
    1: "Bronze data validated for Silver promotion",
    2: "Silver data validated for Gold promotion",
    3: "Gold data certified for analytics consumption",
}


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """One row ``n``: how many key values occur more than once."""
    return df.groupBy(key).agg(F.count("*").alias("uses")).agg(
        count_where(F.col("uses") > 1).alias("n")
    )


def orphan_rows(
    child: DataFrame, key: str, parent: DataFrame, parent_key: str | None = None,
    skip_null: bool = False,
) -> DataFrame:
    """One row ``n``: child rows whose key has no parent row.

    Child keys are counted before the join: a key with many rows is one row by
    then, and the aggregate's partitioning serves the join.
    """
    keys = child.groupBy(F.col(key).alias("child_key")).agg(F.count("*").alias("uses"))
    if skip_null:
        keys = keys.filter(F.col("child_key").isNotNull())
    owners = parent.select(F.col(parent_key or key).alias("child_key"))
    return keys.join(owners, "child_key", "left_anti").agg(
        F.coalesce(F.sum("uses"), F.lit(0)).alias("n")
    )


def _stack(df: DataFrame, **measures: Column) -> DataFrame:
    """Aggregate once, then one row per measure."""
    cells = [
        F.struct(F.lit(name).alias("measure"), value.cast("bigint").alias("n"))
        for name, value in measures.items()
    ]
    return df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


def _named(name: str, one_row: DataFrame) -> DataFrame:
    return one_row.select(F.lit(name).alias("measure"), F.col("n").cast("bigint").alias("n"))


def _as_row(parts: list[DataFrame], names: list[str]) -> DataFrame:
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part)
    return stacked.agg(
        *[F.max(F.when(F.col("measure") == name, F.col("n"))).alias(name) for name in names]
    )


class _Checks:
    """Collects the checks of one gate and renders them as rows."""

    def __init__(self, gate: int):
        self.gate = gate
        self.cells: list[Column] = []

    def add(self, name: str, observed: Column, passed: Column, text: list, expected=0) -> None:
        parts = [p if isinstance(p, Column) else F.lit(p) for p in text]
        self.cells.append(
            F.struct(
                F.lit(self.gate).alias("gate"),
                F.lit(len(self.cells) + 1).alias("check_no"),
                F.lit(name).alias("check_name"),
                observed.cast("bigint").alias("observed"),
                (expected if isinstance(expected, Column) else F.lit(expected))
                .cast("bigint").alias("expected"),
                passed.alias("passed"),
                F.concat(F.lit("FAIL: "), *[p.cast("string") for p in parts]).alias("failure"),
            )
        )

    def none(self, name: str, measure: str, text: str) -> None:
        """The measured number must be 0."""
        n = F.col(measure)
        self.add(name, n, n == 0, [n, text])

    def same(self, name: str, left: str, right: str, right_table: str) -> None:
        a, b = F.col(left), F.col(right)
        self.add(name, a, a == b, [f"{name} rows (", a, f") != {right_table} rows (", b, ")."], b)

    def some(self, name: str, measure: str) -> None:
        """The table must have rows; 1 stands for at least one."""
        n = F.col(measure)
        self.add(name, n, n > 0, [f"{name} is empty."], 1)

    def over(self, row: DataFrame) -> DataFrame:
        return row.select(F.inline(F.array(*self.cells)))


def _empty_tables(measures: list[str]) -> Column:
    total = F.lit(0)
    for name in measures:
        total = total + F.when(F.col(name) == 0, 1).otherwise(0)
    return total


def validate_bronze(bronze: Tables) -> DataFrame:
    """Six checks: null keys, empty tables, duplicate keys."""
    null = {c: F.col(c).isNull() for c in ("order_id", "customer_id", "email")}
    rows = F.count("*")
    parts = [
        _stack(bronze["orders"], ord=rows,
               null_ord=count_where(null["order_id"] | null["customer_id"])),
        _stack(bronze["customers"], cust=rows,
               null_cust=count_where(null["customer_id"] | null["email"])),
        _stack(bronze["order_items"], oi=rows),
        _stack(bronze["products"], prod=rows),
        _stack(bronze["payments"], pay=rows),
        _stack(bronze["shipments"], ship=rows),
        _named("dup_ord", duplicate_keys(bronze["orders"], "order_id")),
        _named("dup_cust", duplicate_keys(bronze["customers"], "customer_id")),
        _named("dup_prod", duplicate_keys(bronze["products"], "product_id")),
    ]
    sizes = ["cust", "ord", "oi", "prod", "pay", "ship"]
    row = _as_row(parts, [*sizes, "null_ord", "null_cust", "dup_ord", "dup_cust", "dup_prod"])
    checks = _Checks(1)
    checks.none("orders_null_keys", "null_ord", " null key values in orders.")
    checks.none("customers_null_keys", "null_cust", " null key values in customers.")
    text: list = ["One or more Bronze tables are empty ("]
    for spot, name in enumerate(sizes):
        text += [f"{', ' if spot else ''}{name}=", F.col(name)]
    empty = _empty_tables(sizes)
    checks.add("empty_tables", empty, empty == 0, [*text, ")."])
    checks.none("orders_duplicate_keys", "dup_ord", " duplicate order_ids.")
    checks.none("customers_duplicate_keys", "dup_cust", " duplicate customer_ids.")
    checks.none("products_duplicate_keys", "dup_prod", " duplicate product_ids.")
    return checks.over(row)


def validate_silver(silver: Tables) -> DataFrame:
    """Six checks: orphans, required fields, value range, empty tables."""
    orders = silver["stg_orders"]
    required = ["order_id", "customer_id", "order_date"]
    missing = F.col(required[0]).isNull()
    for name in required[1:]:
        missing = missing | F.col(name).isNull()
    sizes = [f"n_{name}" for name in silver if name.startswith("stg_")]
    parts = [
        _stack(df, **{f"n_{name}": F.count("*")})
        for name, df in silver.items()
        if name.startswith("stg_") and name != "stg_orders"
    ]
    parts += [
        _stack(orders, n_stg_orders=F.count("*"), missing=count_where(missing),
               negative=count_where(F.col("total_amount") < 0)),
        _named("no_customer", orphan_rows(orders, "customer_id", silver["stg_customers"])),
        _named("no_order_item", orphan_rows(silver["stg_order_items"], "order_id", orders)),
        _named("no_order_pay", orphan_rows(silver["stg_payments"], "order_id", orders)),
    ]
    row = _as_row(
        parts, [*sizes, "missing", "negative", "no_customer", "no_order_item", "no_order_pay"]
    )
    checks = _Checks(2)
    checks.none("orphan_orders", "no_customer", " orphan orders (no matching customer).")
    checks.none("orphan_order_items", "no_order_item", " orphan order_items (no matching order).")
    checks.none("orphan_payments", "no_order_pay", " orphan payments (no matching order).")
    checks.none("orders_required_fields", "missing", " null required fields in stg_orders.")
    checks.none("orders_negative_amounts", "negative", " negative amounts in stg_orders.")
    empty = _empty_tables(sizes)
    checks.add("empty_tables", empty, empty == 0, ["One or more Silver tables are empty."])
    return checks.over(row)


def validate_gold(gold: Tables, silver: Tables) -> DataFrame:
    """Fourteen checks: sizes against Silver, keys, classifications."""
    rows = F.count("*")

    def null_keys(key):
        return count_where(F.col(key).isNull())

    parts = [
        _stack(gold["fact_sales"], sales=rows, null_sales=null_keys("order_id")),
        _stack(gold["dim_customers"], cust=rows,
               bad_tier=count_where(~F.col("loyalty_tier").isin(LOYALTY_VALUES))),
        _stack(gold["dim_products"], prod=rows),
        _stack(gold["dim_dates"], dates=rows),
        _stack(gold["fact_shipment_performance"], ship=rows, null_ship=null_keys("shipment_id")),
        _stack(gold["fact_payment_summary"], pay=rows, null_pay=null_keys("order_id"),
               bad_outcome=count_where(~F.col("payment_outcome").isin(OUTCOME_VALUES))),
        _stack(gold["fact_daily_revenue"], daily=rows, null_daily=null_keys("revenue_date")),
        _stack(silver["stg_orders"], stg_ord=rows),
        _stack(silver["stg_customers"], stg_cust=rows),
        _stack(silver["stg_products"], stg_prod=rows),
        _stack(silver["stg_shipments"], stg_ship=rows),
    ]
    row = _as_row(parts, [
        "sales", "null_sales", "cust", "bad_tier", "prod", "dates", "ship", "null_ship", "pay",
        "null_pay", "bad_outcome", "daily", "null_daily", "stg_ord", "stg_cust", "stg_prod",
        "stg_ship",
    ])
    checks = _Checks(3)
    checks.same("fact_sales", "sales", "stg_ord", "stg_orders")
    checks.same("dim_customers", "cust", "stg_cust", "stg_customers")
    checks.same("dim_products", "prod", "stg_prod", "stg_products")
    checks.some("dim_dates", "dates")
    checks.same("fact_shipment_performance", "ship", "stg_ship", "stg_shipments")
    checks.same("fact_payment_summary", "pay", "stg_ord", "stg_orders")
    checks.some("fact_daily_revenue", "daily")
    checks.none("fact_sales_null_keys", "null_sales", " null order_ids in fact_sales.")
    checks.none("fact_shipment_performance_null_keys", "null_ship",
                " null shipment_ids in fact_shipment_performance.")
    checks.none("fact_payment_summary_null_keys", "null_pay",
                " null order_ids in fact_payment_summary.")
    checks.none("fact_daily_revenue_null_keys", "null_daily",
                " null revenue_dates in fact_daily_revenue.")
    checks.none("loyalty_tier_values", "bad_tier", " invalid loyalty_tier values.")
    checks.none("payment_outcome_values", "bad_outcome", " invalid payment_outcome values.")
    empty = _empty_tables(["sales", "cust", "prod"])
    checks.add("core_tables", empty, empty == 0, ["One or more core Gold tables are empty."])
    return checks.over(row)


def gate_message(checks: DataFrame) -> DataFrame:
    """Pass or fail text per gate, failures in check order.

    A gate has at most fourteen checks, so the ordered list stays small.
    """
    failed = ~F.col("passed")
    listed = F.array_sort(F.collect_list(F.when(failed, F.struct("check_no", "failure"))))
    texts = F.concat(F.array_join(F.transform(listed, lambda c: c["failure"]), " "), F.lit(" "))
    passes = F.create_map(*[F.lit(p) for pair in PASS_TEXTS.items() for p in pair])
    return (
        checks.groupBy("gate")
        .agg(count_where(failed).alias("failures"), texts.alias("texts"))
        .select(
            "gate",
            F.when(
                F.col("failures") == 0,
                F.concat(F.lit("GATE "), F.col("gate"), F.lit(" PASSED: "),
                         F.element_at(passes, F.col("gate"))),
            ).otherwise(
                F.concat(F.lit("GATE "), F.col("gate"), F.lit(" FAILED ("), F.col("failures"),
                         F.lit(" checks): "), F.col("texts")),
            ).alias("message"),
        )
    )
