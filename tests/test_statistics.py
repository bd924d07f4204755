"""Order statistics, RFM scores and anomaly flags against brute force."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lodestrata.functions import order_stats
from lodestrata.operators import anomalies, rfm
from lodestrata.operators.silver import build_silver
from tests.conftest import AS_OF, NOW, by, day, feed, money


def numbers(kind: str) -> list[int]:
    rng = random.Random(7)
    return {
        "one": [5],
        "equal": [3] * 50,
        "negative": [rng.randint(-10**6, 10**6) for _ in range(300)],
        "wide": [rng.randint(-(2**60), 2**60) for _ in range(300)],
        "hot": [42] * 500 + [rng.randint(0, 10**9) for _ in range(400)],
    }[kind]


@pytest.mark.parametrize("kind", ["one", "equal", "negative", "wide", "hot"])
def test_every_rank_matches_a_sort(spark, kind):
    values = numbers(kind)
    ranks = {0, len(values) - 1, len(values) // 2, len(values) // 4, len(values) * 3 // 4}
    frame = spark.createDataFrame([("g", v) for v in [*values, None]], "grp string, v bigint")
    found = order_stats.order_statistics(frame, {str(k): F.lit(k) for k in ranks})
    expected = {str(k): sorted(values)[k] for k in ranks}
    assert {r["tag"]: r["v"] for r in found.collect()} == expected


def test_groups_are_apart_and_missing_ranks_have_no_row(spark):
    frame = spark.createDataFrame(
        [("a", 1), ("a", 9), ("b", 5), ("c", None)], "grp string, v bigint"
    )
    found = order_stats.order_statistics(
        frame, {"last": F.col("total") - 1, "second": F.lit(1)}
    )
    assert {(r["grp"], r["tag"]): r["v"] for r in found.collect()} == {
        ("a", "last"): 9, ("a", "second"): 9, ("b", "last"): 5,
    }


def brute_scores(rows):
    """Positions in the sorted list, one customer at a time."""
    def cuts(values):
        ordered = sorted(values)
        return [ordered[len(ordered) * i // 4] for i in (1, 2, 3)] if ordered else None

    r_cuts = cuts([r for _, r, _, _ in rows if r is not None])
    f_cuts, m_cuts = cuts([f for _, _, f, _ in rows]), cuts([m for _, _, _, m in rows])

    def place(value, points):
        return 1 + sum(value > p for p in points)

    out = {}
    for key, r, f, m in rows:
        r = 9999 if r is None else r
        scores = (5 - place(r, r_cuts) if r_cuts else 2, place(f, f_cuts), place(m, m_cuts))
        mean = sum(scores) / 3
        segment = ("CHAMPION" if mean >= 3.5 else "LOYAL" if mean >= 2.5
                   else "AT_RISK" if mean >= 1.5 else "HIBERNATING")
        out[key] = (*scores, segment)
    return out


@pytest.mark.parametrize("size, top", [(1, 5), (2, 5), (3, 4), (7, 3), (50, 4), (203, 60)])
def test_rfm_matches_brute_force(spark, size, top):
    rng = random.Random(size)
    rows = [
        (i, rng.choice([None, rng.randint(-5, top)]), rng.randint(1, top),
         money(rng.randint(0, top * 100) / 100))
        for i in range(size)
    ]
    idle = (-1, None, 0, money(0))
    frame = spark.createDataFrame(
        [*rows, idle],
        "customer_id bigint, days_since_last_order int, total_orders bigint, "
        "lifetime_spend decimal(22,2)",
    )
    got = by(rfm.rfm_scores(frame, NOW), "customer_id")
    found = {
        k: (v["recency_score"], v["frequency_score"], v["monetary_score"], v["rfm_segment"])
        for k, v in got.items()
    }
    assert found == brute_scores(rows)
    assert all(v["scored_at"] == NOW for v in got.values())


def test_rfm_without_buyers(spark):
    frame = spark.createDataFrame(
        [], "customer_id bigint, days_since_last_order int, total_orders bigint, "
        "lifetime_spend decimal(22,2)",
    )
    assert rfm.rfm_scores(frame, NOW).count() == 0


@pytest.mark.parametrize("size", [1, 2, 3, 4, 5, 6, 41])
def test_quartiles_interpolate(spark, size):
    rng = random.Random(size)
    amounts = [money(rng.randint(0, 99999) / 100) for _ in range(size)]
    frame = spark.createDataFrame([(a,) for a in amounts], "total_amount decimal(12,2)")
    row = anomalies.amount_quartiles(frame).first()
    ordered = sorted(amounts)
    for name, share in (("q1", Decimal("0.25")), ("q3", Decimal("0.75"))):
        spot = share * (size - 1)
        low = int(spot)
        high = min(low + 1, size - 1)
        assert row[name] == ordered[low] + (spot - low) * (ordered[high] - ordered[low])


def orders(spark, amounts):
    rows = [(i, 1, day("2024-06-01"), "x", "web", money(a)) for i, a in enumerate(amounts)]
    return feed(spark, "orders", rows)


def test_outliers(spark, bronze):
    bronze["orders"] = orders(spark, ["10", "11", "12", "13", "100"])
    out = anomalies.iqr_outliers(build_silver(bronze, AS_OF)["stg_orders"]).collect()
    assert [r.asDict() for r in out] == [{
        "table_name": "STG_ORDERS", "record_id": "4", "anomaly_type": "AMOUNT_OUTLIER",
        "details": "Amount $100.00 outside IQR bounds [$8.00, $16.00]",
    }]


def test_no_orders_no_outliers(spark, bronze):
    bronze["orders"] = orders(spark, [])
    assert anomalies.iqr_outliers(build_silver(bronze, AS_OF)["stg_orders"]).count() == 0


def test_high_discount(staged):
    out = anomalies.high_discount(staged["stg_order_items"]).collect()
    assert [r["details"] for r in out] == [
        "Discount 60.00% exceeds 50% threshold (order_item_id=103)"
    ]


def test_dormant(spark, bronze):
    bronze["customers"] = feed(spark, "customers", [
        (i, "a", "b", f"{i}@x", "", "", "", "", "", day(created))
        for i, created in enumerate(["2020-01-01", "2020-01-01", "2020-01-01", "2024-01-01"])
    ])
    bronze["orders"] = feed(spark, "orders", [
        (1, 0, day("2024-04-02"), "x", "web", money(1)),  # 90 days before
        (2, 1, day("2024-04-01"), "x", "web", money(1)),  # 91 days before
    ])
    staged = build_silver(bronze, AS_OF)
    out = anomalies.dormant_customers(staged["stg_customers"], staged["stg_orders"], AS_OF)
    assert sorted(r["record_id"] for r in out.collect()) == ["1", "2"]


def test_flag_ids_are_stable_within_a_run(staged):
    once = anomalies.anomaly_flags(staged, AS_OF, "r1", NOW)
    again = anomalies.anomaly_flags(staged, AS_OF, "r1", NOW)
    other = anomalies.anomaly_flags(staged, AS_OF, "r2", NOW + dt.timedelta(hours=1))
    assert sorted(once.collect()) == sorted(again.collect())
    ids = {r["anomaly_id"] for r in once.collect()}
    assert ids and ids.isdisjoint(r["anomaly_id"] for r in other.collect())
