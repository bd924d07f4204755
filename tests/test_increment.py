"""Runs over what is new against runs over everything."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lodestrata.plans import increment, medallion
from lodestrata.schemas import LAYERS
from lodestrata.sources.sample import AS_OF as SAMPLE_DAY
from lodestrata.sources.sample import sample_bronze
from lodestrata.sources.tables import Lake
from tests.conftest import AS_OF, NOW, ROWS, day, feed, money

LATER = NOW + dt.timedelta(minutes=5)


def land(lake, tables, run):
    for name, df in tables.items():
        lake.append_log(df, "bronze", name, run)


def rows(lake, layer, name):
    return sorted((tuple(x) for x in lake.read(layer, name).drop("_loaded_at").collect()), key=str)


def equal_to_a_whole_run(spark, lake, as_of, path, skip=()):
    """Every table as a run over all Bronze rows builds it."""
    other = Lake(spark, path)
    for name in LAYERS["bronze"]:
        other.publish(lake.read("bronze", name), "bronze", name)
    medallion.run_medallion(spark, other.root, as_of, LATER, "r")
    for layer in ("silver", "gold"):
        for name in LAYERS[layer]:
            assert rows(lake, layer, name) == rows(other, layer, name), name
    assert rows(lake, "gold", "customer_rfm_scores") == [
        (*x[:-1], LATER) for x in rows(other, "gold", "customer_rfm_scores")]


def status(steps):
    return [x["status"] for x in steps.orderBy("step_no").collect()]


@pytest.fixture()
def lake(spark, tmp_path):
    found = Lake(spark, str(tmp_path / "lake"))
    land(found, {name: feed(spark, name) for name in ROWS}, "d1")
    return found


MORE = {
    "customers": [(4, "Di", "Fox", "di@x.org", "4", "Riga", "lv", "4", "vip", day("2024-06-30"))],
    "orders": [(21, 2, day("2024-06-29"), "completed", "web", money("10.00")),
               (40, 4, day("2024-06-30"), "shipped", "web", money("70.00"))],
    # One item of an old order, and one of a product that was not known.
    "order_items": [(104, 12, 8, 1, money("800.00"), None, money("800.00")),
                    (105, 40, 11, 1, money("70.00"), None, money("70.00"))],
    "products": [(11, "Rug", "home", "soft", "C", money("70.00"), money("30.00"), 5, day("2024-01-01"))],
    "payments": [(5, 11, "credit_card", money("100.00"), day("2024-06-06"), "completed"),
                 (6, 40, "paypal", money("70.00"), day("2024-06-30"), "completed")],
    "shipments": [(5, 11, "dhl", "T5", day("2024-06-07"), day("2024-06-20"), "delivered")],
}


def test_equal_to_a_whole_run(spark, lake, tmp_path):
    """Drops one after the other: a payment and an item of old orders, then parents, then their children."""
    assert status(increment.run_increment(spark, lake.root, AS_OF, NOW, "r1")) == ["DONE"] * 8
    drops = [
        {"payments": MORE["payments"][:1], "order_items": MORE["order_items"][:1]},
        {name: MORE[name] for name in ("customers", "products", "orders")},
        {"order_items": MORE["order_items"][1:], "payments": MORE["payments"][1:], "shipments": MORE["shipments"]},
    ]
    for i, drop in enumerate(drops, 2):
        land(lake, {name: feed(spark, name, found) for name, found in drop.items()}, f"d{i}")
        assert status(increment.run_increment(spark, lake.root, AS_OF, LATER, f"r{i}")) == ["DONE"] * 8
        if i == 2:
            # Gold rows that nothing new touches are the stored ones: the order of the other customer.
            old = lake.read("gold", "fact_sales").filter(F.col("_loaded_at") == F.lit(NOW).cast("timestamp_ntz"))
            assert [x.order_id for x in old.collect()] == [20]
    equal_to_a_whole_run(spark, lake, AS_OF, str(tmp_path / "other"))
    assert status(increment.run_increment(spark, lake.root, AS_OF, LATER, "r9")) == ["SKIPPED"]


def test_what_needs_a_whole_run(spark, lake, tmp_path):
    increment.run_increment(spark, lake.root, AS_OF, NOW, "r1")

    def loaded():
        return {x[0] for x in lake.read("gold", "fact_sales").select("_loaded_at").distinct().collect()}

    # Another day: all ages differ.
    tomorrow = NOW + dt.timedelta(days=1)
    increment.run_increment(spark, lake.root, AS_OF + dt.timedelta(days=1), tomorrow, "r2")
    assert loaded() == {tomorrow}
    # A Bronze table that was replaced.
    lake.publish(feed(spark, "orders"), "bronze", "orders")
    later = tomorrow + dt.timedelta(hours=1)
    increment.run_increment(spark, lake.root, AS_OF + dt.timedelta(days=1), later, "r3")
    assert loaded() == {later}


def test_a_failed_run_is_no_base(spark, lake, tmp_path, monkeypatch):
    increment.run_increment(spark, lake.root, AS_OF, NOW, "r1")
    land(lake, {name: feed(spark, name, MORE[name]) for name in ROWS}, "d2")
    # Stops when Silver and a part of Gold are written.
    monkeypatch.setattr(increment.gold, "dim_dates", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError):
        increment.run_increment(spark, lake.root, AS_OF, LATER, "r2")
    monkeypatch.undo()
    increment.run_increment(spark, lake.root, AS_OF, LATER, "r3")
    equal_to_a_whole_run(spark, lake, AS_OF, str(tmp_path / "other"))


def test_a_gate_that_fails_stops_the_increment(spark, lake, tmp_path):
    increment.run_increment(spark, lake.root, AS_OF, NOW, "r1")
    before = rows(lake, "gold", "fact_sales")
    land(lake, {"orders": feed(spark, "orders", ROWS["orders"][:1])}, "d2")
    steps = increment.run_increment(spark, lake.root, AS_OF, LATER, "r2")
    assert "duplicate order_ids" in steps.filter("step_no = 1").first()["message"]
    assert rows(lake, "gold", "fact_sales") == before
    # An order of a customer nobody knows passes the first gate and not the second.
    lake.append_log(feed(spark, "orders", [(50, 99, day("2024-06-30"), "shipped", "web", money("1.00"))]), "bronze", "orders", "d2")
    steps = {x["step"]: x["status"] for x in increment.run_increment(spark, lake.root, AS_OF, LATER, "r3").collect()}
    assert steps["silver_transform"] == "DONE" and steps["gold_transform"] == "SKIPPED"
    assert rows(lake, "gold", "fact_sales") == before


def test_a_small_drop_touches_a_small_share(spark, tmp_path):
    """The payments of the last days of the sample feeds arrive behind the rest."""
    lake = Lake(spark, str(tmp_path / "lake"))
    bronze = sample_bronze(spark, "/root/testdata/sf0.001")
    late = F.col("payment_date") >= F.lit(dt.date(2001, 7, 25))
    noon = dt.datetime(2001, 8, 15, 12)
    land(lake, {**bronze, "payments": bronze["payments"].filter(~late | F.col("payment_date").isNull())}, "d1")
    increment.run_increment(spark, lake.root, SAMPLE_DAY, noon, "r1")
    land(lake, {"payments": bronze["payments"].filter(late)}, "d2")
    seen = increment.Seen(lake.read(increment.LAYER, increment.TABLE).collect())
    kept = {n: increment.standing(lake.history("bronze", n)) for n in LAYERS["bronze"]}
    new = increment.Increment(lake, seen, kept, SAMPLE_DAY, LATER)
    new.build_silver()
    keys = new.touched()
    orders = lake.read("silver", "stg_orders").count()
    assert 0 < keys["order"].count() < orders / 4 and keys["customer"].count() <= 12
    increment.run_increment(spark, lake.root, SAMPLE_DAY, LATER, "r2")
    equal_to_a_whole_run(spark, lake, SAMPLE_DAY, str(tmp_path / "other"))
