"""Each check must fire for its own defect, on frames passed straight to the gate."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lodestrata.operators import gates, gold
from tests.conftest import AS_OF, ROWS, day, feed, money


def failed(checks):
    return [r["check_no"] for r in checks.orderBy("check_no").collect() if not r["passed"]]


def message(checks):
    return gates.gate_message(checks).first()["message"]


def test_clean_feeds_pass(bronze):
    checks = gates.validate_bronze(bronze)
    assert checks.count() == 6 and failed(checks) == []
    assert message(checks) == "GATE 1 PASSED: Bronze data validated for Silver promotion"


ORDER = (30, 1, day("2024-06-01"), "x", "web", money("1"))
CUSTOMER = (4, "D", "E", "d@e", "1", "c", "s", "z", "new", day("2024-01-01"))
BRONZE_DEFECTS = [
    ("orders", [(31, None, *ORDER[2:])], 1, "FAIL: 1 null key values in orders."),
    ("customers", [(*CUSTOMER[:3], None, *CUSTOMER[4:])], 2,
     "FAIL: 1 null key values in customers."),
    ("orders", [ORDER, ORDER, ORDER], 4, "FAIL: 1 duplicate order_ids."),
    ("customers", [CUSTOMER, CUSTOMER], 5, "FAIL: 1 duplicate customer_ids."),
    ("products", [ROWS["products"][0]], 6, "FAIL: 1 duplicate product_ids."),
]


@pytest.mark.parametrize("table, extra, check, text", BRONZE_DEFECTS)
def test_bronze_defects(spark, bronze, table, extra, check, text):
    bronze[table] = feed(spark, table, ROWS[table] + extra)
    checks = gates.validate_bronze(bronze)
    assert failed(checks) == [check]
    assert message(checks) == f"GATE 1 FAILED (1 checks): {text} "


def test_empty_feed(spark, bronze):
    bronze["shipments"] = feed(spark, "shipments", [])
    checks = gates.validate_bronze(bronze)
    assert failed(checks) == [3]
    assert message(checks) == (
        "GATE 1 FAILED (1 checks): FAIL: One or more Bronze tables are empty "
        "(cust=3, ord=4, oi=4, prod=3, pay=4, ship=0). "
    )


def test_failures_are_listed_in_check_order(spark, bronze):
    bronze["orders"] = feed(spark, "orders", [*ROWS["orders"], ORDER, ORDER, (None, *ORDER[1:])])
    assert message(gates.validate_bronze(bronze)) == (
        "GATE 1 FAILED (2 checks): FAIL: 1 null key values in orders. "
        "FAIL: 1 duplicate order_ids. "
    )


def test_clean_silver_passes(staged):
    checks = gates.validate_silver(staged)
    assert checks.count() == 6 and failed(checks) == []
    assert message(checks) == "GATE 2 PASSED: Silver data validated for Gold promotion"


SILVER_DEFECTS = [
    ("stg_orders", {"customer_id": "cast(99 as bigint)"}, [1], "4 orphan orders"),
    ("stg_orders", {"customer_id": "cast(null as bigint)"}, [1, 4], "4 orphan orders"),
    ("stg_order_items", {"order_id": "cast(99 as bigint)"}, [2], "4 orphan order_items"),
    ("stg_payments", {"order_id": "cast(99 as bigint)"}, [3], "4 orphan payments"),
    ("stg_orders", {"order_date": "cast(null as timestamp_ntz)"}, [4], "4 null required"),
    ("stg_orders", {"total_amount": "cast(-1 as decimal(12,2))"}, [5], "4 negative amounts"),
]


@pytest.mark.parametrize("table, change, checks, text", SILVER_DEFECTS)
def test_silver_defects(staged, table, change, checks, text):
    staged[table] = staged[table].withColumns({c: F.expr(e) for c, e in change.items()})
    found = gates.validate_silver(staged)
    assert failed(found) == checks
    assert text in message(found)


def test_empty_silver_table(staged):
    staged["stg_shipments"] = staged["stg_shipments"].limit(0)
    assert failed(gates.validate_silver(staged)) == [6]


@pytest.fixture()
def modelled(staged):
    return gold.build_gold(staged, AS_OF)


def test_clean_gold_passes(modelled, staged):
    checks = gates.validate_gold(modelled, staged)
    assert checks.count() == 14 and failed(checks) == []
    assert message(checks) == "GATE 3 PASSED: Gold data certified for analytics consumption"


GOLD_DEFECTS = [
    ("fact_sales", lambda d: d.limit(3), [1]),
    ("dim_customers", lambda d: d.limit(2), [2]),
    ("dim_products", lambda d: d.unionByName(d), [3]),
    ("dim_dates", lambda d: d.limit(0), [4]),
    ("fact_shipment_performance", lambda d: d.limit(1), [5]),
    ("fact_payment_summary", lambda d: d.limit(1), [6]),
    ("fact_daily_revenue", lambda d: d.limit(0), [7]),
    ("fact_sales", lambda d: d.withColumn("order_id", F.lit(None).cast("bigint")), [8]),
    ("fact_shipment_performance", lambda d: d.withColumn("shipment_id", F.lit(None).cast("bigint")), [9]),
    ("fact_payment_summary", lambda d: d.withColumn("order_id", F.lit(None).cast("bigint")), [10]),
    ("fact_daily_revenue", lambda d: d.withColumn("revenue_date", F.lit(None).cast("date")), [11]),
    ("dim_customers", lambda d: d.withColumn("loyalty_tier", F.lit("TIN")), [12]),
    ("fact_payment_summary", lambda d: d.withColumn("payment_outcome", F.lit("LOST")), [13]),
    ("dim_products", lambda d: d.limit(0), [3, 14]),
]


@pytest.mark.parametrize("table, change, checks", GOLD_DEFECTS)
def test_gold_defects(modelled, staged, table, change, checks):
    modelled[table] = change(modelled[table])
    assert failed(gates.validate_gold(modelled, staged)) == checks


def test_null_classification_passes(modelled, staged):
    customers = modelled["dim_customers"]
    modelled["dim_customers"] = customers.withColumn("loyalty_tier", F.lit(None).cast("string"))
    assert failed(gates.validate_gold(modelled, staged)) == []


def test_row_count_text(modelled, staged):
    modelled["fact_sales"] = modelled["fact_sales"].limit(1)
    text = message(gates.validate_gold(modelled, staged))
    assert "FAIL: fact_sales rows (1) != stg_orders rows (4). " in text
