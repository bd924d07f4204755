from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lodestrata.operators import gold
from lodestrata.operators.silver import build_silver
from tests.conftest import AS_OF, ROWS, by, day, feed, money


def test_customer_measures(staged):
    out = by(gold.dim_customers(staged, AS_OF), "customer_id")
    ann, bob, cy = out[1], out[2], out[3]
    assert ann["total_orders"] == 3 and ann["lifetime_spend"] == Decimal("6150.00")
    assert ann["avg_order_value"] == 2050.0
    assert (ann["completed_orders"], ann["cancelled_orders"], ann["returned_orders"]) == (1, 1, 1)
    assert ann["cancellation_rate"] == 33.33
    assert ann["avg_days_between_orders"] == 5.0
    assert ann["orders_per_month"] == round(3 / (1643 / 30), 2)
    assert ann["preferred_channel"] == "web" and ann["loyalty_tier"] == "SILVER"
    assert ann["total_paid"] == 6000 and ann["total_refunded"] == 50 and ann["net_paid"] == 5950
    assert bob["avg_days_between_orders"] is None and bob["total_paid"] == 0
    # no orders at all
    assert cy["total_orders"] == 0 and cy["lifetime_spend"] == 0 and cy["avg_order_value"] == 0
    assert cy["days_since_last_order"] is None and cy["preferred_channel"] is None
    assert cy["cancellation_rate"] == 0 and cy["loyalty_tier"] == "BRONZE"


def test_both_ways_of_counting_orders_agree(staged):
    plain = gold.dim_customers(staged, AS_OF, unique_orders=True)
    assert sorted(plain.collect()) == sorted(gold.dim_customers(staged, AS_OF).collect())
    plain = gold.fact_daily_revenue(staged, unique_orders=True)
    assert plain.collect() == gold.fact_daily_revenue(staged).collect()


def test_repeated_order_ids_count_once(spark, bronze):
    again = (10, 1, day("2024-06-02"), "cancelled", "phone", money("10.00"))
    bronze["orders"] = feed(spark, "orders", [*ROWS["orders"], again, again])
    staged = build_silver(bronze, AS_OF)
    row = by(gold.customer_orders(staged, AS_OF), "customer_id")[1]
    assert row["total_orders"] == 3 and row["cancelled_orders"] == 2
    assert row["lifetime_spend"] == Decimal("6170.00")
    assert row["avg_order_value"] == 6170 / 5
    daily = by(gold.fact_daily_revenue(staged), "revenue_date")[dt.date(2024, 6, 2)]
    assert daily["total_orders"] == 1 and daily["phone_orders"] == 1
    counts = by(gold.customer_order_counts(staged), "customer_id")
    assert counts[1]["customer_total_orders"] == 3 and counts[1]["is_repeat_customer"]
    assert not counts[2]["is_repeat_customer"]


def test_one_order_twice_is_no_repeat_customer(spark, bronze):
    bronze["orders"] = feed(spark, "orders", [ROWS["orders"][3]] * 2)
    staged = build_silver(bronze, AS_OF)
    assert {r["is_repeat_customer"] for r in gold.fact_sales(staged).collect()} == {False}


def test_channel_ties_go_by_name(spark, bronze):
    rows = [(i, 1, day("2024-06-01"), "x", c, money("1")) for i, c in enumerate("bbaac")]
    bronze["orders"] = feed(spark, "orders", rows)
    staged = build_silver(bronze, AS_OF)
    assert gold.preferred_channel(staged).first()["preferred_channel"] == "a"


@pytest.mark.parametrize(
    "orders, spend, tier",
    [(10, 50000, "PLATINUM"), (10, 49999, "GOLD"), (9, 50000, "GOLD"), (5, 20000, "GOLD"),
     (4, 20000, "SILVER"), (2, 5000, "SILVER"), (1, 90000, "BRONZE"), (2, 4999, "BRONZE")],
)
def test_loyalty_tiers(spark, bronze, orders, spend, tier):
    rows = [
        (i, 1, day("2024-06-01"), "x", "web", money(spend if i == 0 else 0))
        for i in range(orders)
    ]
    bronze["orders"] = feed(spark, "orders", rows)
    staged = build_silver(bronze, AS_OF)
    assert by(gold.dim_customers(staged, AS_OF), "customer_id")[1]["loyalty_tier"] == tier


def test_products(staged):
    out = by(gold.dim_products(staged), "product_id")
    lamp = out[7]
    assert lamp["orders_with_product"] == 3 and lamp["total_units_sold"] == 6
    assert lamp["total_revenue"] == Decimal("520.00")
    assert lamp["returned_revenue"] == Decimal("300.00")
    assert lamp["selling_span_days"] == 28 and lamp["inventory_turnover"] == 0.06
    assert lamp["days_of_stock_remaining"] == 462.0 and lamp["sales_tier"] == "ACTIVE"
    assert out[8]["sales_tier"] == "NO_SALES" and out[8]["days_of_stock_remaining"] is None
    assert out[9]["total_revenue"] == 0 and out[9]["first_sold_date"] is None
    assert out[9]["inventory_turnover"] == 0
    exposure = by(gold.return_exposure(staged), "product_id")
    assert exposure == {7: {"product_id": 7, "returned_revenue": Decimal("300.00")}}


def test_calendar(staged):
    out = by(gold.dim_dates(staged), "date_key")
    assert len(out) == 29 and min(out) == dt.date(2024, 6, 1)
    first = out[dt.date(2024, 6, 1)]
    assert first["day_of_week"] == 6 and first["day_name"] == "Sat" and first["is_weekend"]
    assert first["fiscal_quarter"] == "FQ1" and first["quarter_name"] == "Q2"
    assert first["last_day_of_month"] == dt.date(2024, 6, 30)
    assert gold.dim_dates(staged, max_days=10).count() == 10


def test_calendar_bound(spark, bronze):
    rows = [(i, 1, day(d), "x", "web", money(1)) for i, d in enumerate(["2018-01-01", "2024-01-01"])]
    bronze["orders"] = feed(spark, "orders", rows)
    staged = build_silver(bronze, AS_OF)
    assert gold.dim_dates(staged, max_days=gold.SPINE_DAYS).count() == 1500
    assert gold.dim_dates(staged).count() == 2192


@pytest.mark.parametrize("month, quarter", [(1, "FQ4"), (4, "FQ1"), (7, "FQ2"), (10, "FQ3")])
def test_fiscal_quarters(spark, bronze, month, quarter):
    rows = [(1, 1, dt.datetime(2023, month, 15), "x", "web", money(1))]
    bronze["orders"] = feed(spark, "orders", rows)
    assert gold.dim_dates(build_silver(bronze, AS_OF)).first()["fiscal_quarter"] == quarter


def test_calendar_without_orders(spark, bronze):
    bronze["orders"] = feed(spark, "orders", [])
    assert gold.dim_dates(build_silver(bronze, AS_OF)).count() == 0


def test_sales(staged):
    out = by(gold.fact_sales(staged), "order_id")
    assert len(out) == 4
    first = out[10]
    assert first["customer_name"] == "Ann Lee" and first["line_item_count"] == 2
    assert first["payment_methods"] == "credit_card, paypal"
    assert first["payment_method_groups"] == "CARD, DIGITAL"
    assert first["amount_paid"] == 6000 and first["amount_failed"] == 6000
    assert first["net_revenue"] == 6000 and first["is_profitable"]
    assert first["has_delayed_shipment"] and first["avg_delivery_days"] == 4.5
    assert first["slowest_shipping_speed"] == "SLOW"
    assert first["days_to_ship"] == 1 and first["days_to_deliver"] == 9
    assert first["order_month"] == dt.date(2024, 6, 1)
    assert first["order_quarter"] == dt.date(2024, 4, 1)
    assert out[12]["net_revenue"] == -50 and not out[12]["is_profitable"]
    assert out[12]["days_to_deliver"] is None and out[12]["avg_delivery_days"] is None
    bare = out[11]
    assert bare["line_item_count"] == 0 and bare["first_ship_date"] is None
    assert bare["has_delayed_shipment"] is False
    assert out[20]["payment_count"] == 0 and out[20]["payment_methods"] is None
    assert out[20]["is_repeat_customer"] is False and first["is_repeat_customer"] is True


def test_order_without_customer_row_stays(spark, bronze):
    bronze["customers"] = feed(spark, "customers", ROWS["customers"][:1])
    out = by(gold.fact_sales(build_silver(bronze, AS_OF)), "order_id")
    assert len(out) == 4 and out[20]["customer_name"] is None


def test_slowest_speed_is_text_order_unless_ranked(spark, bronze):
    rows = [
        (1, 10, "u", "t", day("2024-06-01"), day("2024-06-06"), "x"),  # STANDARD
        (2, 10, "u", "t", day("2024-06-01"), day("2024-06-20"), "x"),  # SLOW
    ]
    bronze["shipments"] = feed(spark, "shipments", rows)
    staged = build_silver(bronze, AS_OF)
    name = "slowest_shipping_speed"
    assert gold.shipment_info(staged).first()[name] == "STANDARD"
    assert gold.shipment_info(staged, slowest_by_rank=True).first()[name] == "SLOW"


def test_payment_lists_of_unknown_methods_are_empty(spark, bronze):
    bronze["payments"] = feed(spark, "payments", [(1, 10, None, money(1), day("2024-06-01"), "x")])
    row = gold.payment_agg(build_silver(bronze, AS_OF)).first()
    assert row["payment_methods"] == "" and row["payment_method_groups"] == "OTHER"


def test_payment_outcomes(staged):
    out = by(gold.fact_payment_summary(staged), "order_id")
    outcomes = {k: v["payment_outcome"] for k, v in out.items()}
    assert outcomes == {10: "RECOVERED", 11: "ALL_FAILED", 12: "REFUNDED", 20: "NO_PAYMENT"}
    assert out[10]["payment_success_rate"] == 50.0 and out[20]["payment_success_rate"] == 0


@pytest.mark.parametrize(
    "statuses, outcome",
    [(["completed"], "CLEAN"), (["pending"], "NO_PAYMENT"), (["completed", "refunded"], "REFUNDED"),
     (["failed", "refunded"], "ALL_FAILED"), (["failed", "completed", "refunded"], "RECOVERED")],
)
def test_outcome_order(spark, bronze, statuses, outcome):
    rows = [(i, 10, "paypal", money(1), day("2024-06-01"), s) for i, s in enumerate(statuses)]
    bronze["payments"] = feed(spark, "payments", rows)
    out = by(gold.fact_payment_summary(build_silver(bronze, AS_OF)), "order_id")
    assert out[10]["payment_outcome"] == outcome


def test_shipment_performance_needs_the_order(spark, bronze):
    stray = (9, 777, "u", "t", day("2024-06-01"), None, "x")
    bronze["shipments"] = feed(spark, "shipments", [*ROWS["shipments"], stray])
    out = by(gold.fact_shipment_performance(build_silver(bronze, AS_OF)), "shipment_id")
    assert set(out) == {1, 2, 3, 4}
    assert out[4]["days_order_to_ship"] == 1 and out[3]["days_order_to_delivery"] is None
    assert out[1]["customer_segment"] == "VIP" and out[1]["ship_month"] == dt.date(2024, 6, 1)


def test_daily_revenue(staged):
    rows = gold.fact_daily_revenue(staged).collect()
    assert [r["revenue_date"].day for r in rows] == [1, 5, 11, 29]
    first, second, third, _ = rows
    assert first["web_orders"] == 1 and first["net_revenue"] == 6000
    assert first["total_units_sold"] == 3 and first["unique_products_sold"] == 2
    assert second["net_revenue"] == 0 and second["total_units_sold"] == 0
    assert third["returned_revenue"] == 50 and third["net_revenue"] == 0


def test_totals_agree_between_layers(staged):
    total = staged["stg_orders"].agg(F.sum("total_amount")).first()[0]
    daily = gold.fact_daily_revenue(staged).agg(F.sum("gross_revenue")).first()[0]
    spend = gold.dim_customers(staged, AS_OF).agg(F.sum("lifetime_spend")).first()[0]
    assert total == daily == spend


def test_orders_of_a_product_count_once(spark, bronze, staged):
    orders = [(10, 1, day("2024-06-01"), "completed", "web", money("1.00"))] * 2
    orders += [(11, 1, day("2024-06-02"), "returned", "web", money("1.00"))]
    items = [(100 + i, order, product, 1, money("10.00"), None, None)
             for i, (order, product) in enumerate([(10, 7), (10, 7), (11, 7), (10, None), (11, None), (11, None), (99, 7)])]
    found = by(gold.product_sales(build_silver(
        {**bronze, "orders": feed(spark, "orders", orders), "order_items": feed(spark, "order_items", items)}, AS_OF)), "product_id")
    # An order that is there twice doubles its rows and stays one order; an item without an order counts nothing.
    assert (found[7]["orders_with_product"], found[7]["total_units_sold"]) == (2, 5)
    assert (found[None]["orders_with_product"], found[None]["total_units_sold"]) == (2, 4)


def test_items_and_products_of_an_order_are_counted_apart(spark, bronze, staged):
    items = staged["stg_order_items"]
    unknown = items.withColumn("product_id", F.lit(None).cast("bigint"))
    strange = items.withColumn("order_id", F.lit(None).cast("bigint"))
    silver = {**staged, "stg_order_items": items.union(items).union(unknown).union(strange)}
    sales = gold.fact_sales(silver)
    # A distinct count beside the sums would keep every sum once for each order and product.
    assert "distinct" not in sales._jdf.queryExecution().executedPlan().toString().lower()
    measures = gold.order_items_agg(silver)
    wanted = {x["order_id"]: x.asDict() for x in measures.collect() if x["order_id"] is not None}
    found = by(sales, "order_id")
    assert wanted and any(x["unique_products"] > 1 for x in wanted.values())
    for order, row in wanted.items():
        assert {name: found[order][name] for name in measures.columns} == row
    without = by(gold.fact_sales({**silver, "stg_order_items": unknown}), "order_id")
    assert {x["unique_products"] for x in without.values()} == {0}
