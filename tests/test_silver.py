from __future__ import annotations

from decimal import Decimal

import pytest

from lodestrata.operators import silver
from tests.conftest import AS_OF, ROWS, by, day, feed, money


def test_customers_are_cleaned(staged):
    rows = by(staged["stg_customers"], "customer_id")
    assert rows[1]["full_name"] == "Ann Lee"
    assert rows[1]["email"] == "ann@shop.com" and rows[1]["email_domain"] == "shop.com"
    assert rows[1]["state"] == "IT" and rows[1]["segment"] == "VIP"
    assert rows[1]["is_active"] is False
    assert rows[2]["customer_tenure_days"] == 182 and rows[2]["is_active"] is True
    # exactly 365 days still counts; no @ gives an empty domain; a missing name part, NULL
    assert rows[3]["customer_tenure_days"] == 365 and rows[3]["is_active"] is True
    assert rows[3]["email_domain"] == "" and rows[3]["full_name"] is None


def test_customers_need_id_and_email(spark, bronze):
    base = ROWS["customers"][0]
    rows = [(None, *base[1:]), (*base[:3], None, *base[4:]), base]
    bronze["customers"] = feed(spark, "customers", rows)
    assert silver.stg_customers(bronze, AS_OF).count() == 1


def test_orders(spark, bronze):
    rows = [
        (1, 1, day("2024-06-29"), " Shipped", " WEB ", money("5000.00")),
        (2, 1, day("2024-06-30"), "shipped", "web", money("5000.01")),
        (3, 1, None, None, None, money("0.00")),
        (4, 1, day("2024-06-30"), "shipped", "web", money("-0.01")),
        (5, 1, day("2024-06-30"), "shipped", "web", None),
        (None, 1, day("2024-06-30"), "shipped", "web", money("1")),
        (7, None, day("2024-06-30"), "shipped", "web", money("1")),
        (8, 1, day("2024-07-01"), "shipped", "web", money("1")),
    ]
    bronze["orders"] = feed(spark, "orders", rows)
    out = by(silver.stg_orders(bronze, AS_OF), "order_id")
    assert set(out) == {1, 2, 3, 8}
    assert out[1]["status"] == "SHIPPED" and out[1]["channel"] == "web"
    assert [out[i]["is_high_value"] for i in (1, 2)] == [False, True]
    assert [out[i]["is_weekend_order"] for i in (1, 2, 3, 8)] == [True, True, False, False]
    assert [out[i]["order_day_of_week"] for i in (1, 2, 8)] == ["Sat", "Sun", "Mon"]
    assert out[1]["days_since_order"] == 2 and out[3]["days_since_order"] is None


def test_order_items(spark, bronze):
    extra = [
        (104, 10, 99, 1, money("3.00"), money("1.00"), None),  # no such product: cost 0
        (105, 10, 7, 0, money("3.00"), None, None),
        (106, 10, 7, 1, None, None, None),
        (107, 10, 7, 1, money("-1"), None, None),
    ]
    bronze["order_items"] = feed(spark, "order_items", ROWS["order_items"] + extra)
    out = by(silver.stg_order_items(bronze, AS_OF), "order_item_id")
    assert set(out) == {100, 101, 102, 103, 104}
    first = out[100]  # the feed's line_total is not used
    assert first["line_total"] == Decimal("180.00") and first["discount_pct"] == Decimal("10.00")
    assert first["item_margin"] == Decimal("60.00") and first["is_discounted"] is True
    free = out[101]
    assert free["discount_pct"] == 0 and free["discount"] == 0 and not free["is_discounted"]
    assert free["item_margin"] == Decimal("-900.00")
    assert out[104]["item_margin"] == Decimal("2.00")
    assert out[104]["discount_pct"] == Decimal("33.33")


def test_discount_percent_rounds_the_quotient_first(spark, bronze):
    # 0.01 / 8.00 = 0.00125 -> 0.125 % -> 0.13
    bronze["order_items"] = feed(
        spark, "order_items", [(1, 1, 7, 1, money("8.00"), money("0.01"), None)]
    )
    row = silver.stg_order_items(bronze).first()
    assert row["discount_pct"] == Decimal("0.13")


@pytest.mark.parametrize(
    "price, tier",
    [("199.99", "BUDGET"), ("200", "MID_RANGE"), ("500", "PREMIUM"), ("800", "LUXURY")],
)
def test_price_tiers(spark, bronze, price, tier):
    row = (1, "x", "c", "s", "b", money(price), money("1"), 5, day("2024-01-01"))
    bronze["products"] = feed(spark, "products", [row])
    assert silver.stg_products(bronze).first()["price_tier"] == tier


def test_products(spark, bronze):
    extra = [
        (20, "x", "c", "s", "b", money("0"), money("1"), 5, day("2024-01-01")),
        (21, "x", "c", "s", "b", money("5"), money("-1"), 5, day("2024-01-01")),
        (22, "x", "c", "s", "b", money("5"), None, 5, day("2024-01-01")),
    ]
    bronze["products"] = feed(spark, "products", ROWS["products"] + extra)
    out = by(silver.stg_products(bronze), "product_id")
    assert set(out) == {7, 8, 9}
    assert [out[i]["is_low_stock"] for i in (7, 8, 9)] == [True, False, False]
    assert out[8]["margin_pct"] == Decimal("-12.50") and out[9]["margin_pct"] == 100
    assert out[7]["category"] == "HOME" and out[7]["product_name"] == "Lamp"


def test_payments(spark, bronze):
    rows = [
        (i, 10, method, money("1"), day("2024-06-03"), status)
        for i, (method, status) in enumerate([
            (" CREDIT_card ", " completed"), ("debit_card", "failed"), ("paypal", None),
            ("google_pay", "x"), ("gift_card", "x"), ("wire", "x"), (None, "x"),
        ])
    ]
    rows.append((90, 999, "paypal", money("1"), day("2024-06-03"), "completed"))
    rows.append((91, 10, "paypal", money("-1"), day("2024-06-03"), "completed"))
    bronze["payments"] = feed(spark, "payments", rows)
    out = by(silver.stg_payments(bronze), "payment_id")
    groups = [out[i]["payment_method_group"] for i in range(7)]
    assert groups == ["CARD", "CARD", "DIGITAL", "DIGITAL", "GIFT_CARD", "OTHER", "OTHER"]
    assert out[0]["is_successful"] is True and out[2]["is_successful"] is False
    assert out[0]["days_to_payment"] == 2 and out[90]["days_to_payment"] is None
    assert 91 not in out


@pytest.mark.parametrize(
    "delivered, speed, delayed",
    [(None, "PENDING", False), ("2024-06-01", "SAME_DAY", False), ("2024-06-02", "SAME_DAY", False),
     ("2024-06-04", "FAST", False), ("2024-06-08", "STANDARD", False), ("2024-06-09", "SLOW", True)],
)
def test_shipping_speed(spark, bronze, delivered, speed, delayed):
    row = (1, 1, "ups", "t", day("2024-06-01"), delivered and day(delivered), "Delivered ")
    bronze["shipments"] = feed(spark, "shipments", [row])
    out = silver.stg_shipments(bronze).first()
    assert (out["shipping_speed"], out["is_delayed"]) == (speed, delayed)
    assert out["is_delivered"] is True


def test_shipments_need_a_ship_date(spark, bronze):
    bronze["shipments"] = feed(spark, "shipments", [(1, 1, "u", "t", None, None, "x")])
    assert silver.stg_shipments(bronze).count() == 0
