"""Increments that touch much are built whole, and what they leave on disk."""

from __future__ import annotations

import pytest

from lodestrata.plans import increment
from lodestrata.session import FREES_SHUFFLES
from tests.conftest import AS_OF, NOW, ROWS, day, feed, money
from tests.test_disk import lake, settings  # noqa: F401
from tests.test_increment import LATER, MORE, equal_to_a_whole_run, land


def test_runs_free_their_shuffles(spark, lake, settings):  # noqa: F811
    settings.clear()
    # The first one is a whole run.
    increment.run_increment(spark, lake.root, AS_OF, NOW, "r1")
    assert len(settings) >= 17 and set(settings.values()) == {"true"}
    assert spark.conf.get(FREES_SHUFFLES, None) is None


@pytest.mark.parametrize("share", [0, 2])
def test_gold_is_the_same_whole_and_by_keys(spark, lake, tmp_path, monkeypatch, share):  # noqa: F811
    calls = []
    for name in ("_whole_gold", "_replaced_gold"):
        real = getattr(increment.Increment, name)
        monkeypatch.setattr(increment.Increment, name, lambda self, keys, real=real, name=name: calls.append(name) or real(self, keys))
    monkeypatch.setattr(increment, "WHOLE_SHARE", share)
    increment.run_increment(spark, lake.root, AS_OF, NOW, "r1")
    land(lake, {name: feed(spark, name, MORE[name][:1]) for name in ("payments", "order_items")}, "d2")
    increment.run_increment(spark, lake.root, AS_OF, LATER, "r2")
    assert calls == ["_replaced_gold" if share else "_whole_gold"]
    for name, key, kept in (("fact_sales", "order_id", {20}), ("fact_payment_summary", "order_id", {20}),
                            ("dim_customers", "customer_id", {2, 3}), ("dim_products", "product_id", {9})):
        times = {x[key]: x["_loaded_at"] for x in lake.read("gold", name).collect()}
        assert {k for k, t in times.items() if t == NOW} == kept, name
        assert set(times.values()) == {NOW, LATER}
    # What test_increment compares was built whole, as its drops touch most orders.
    if share:
        equal_to_a_whole_run(spark, lake, AS_OF, str(tmp_path / "other"))


def test_few_touched_orders_are_replaced(spark, lake, monkeypatch):  # noqa: F811
    """By default the share of touched orders decides."""
    calls = []
    monkeypatch.setattr(increment.Increment, "_whole_gold", lambda self, keys: calls.append("whole") or {})
    monkeypatch.setattr(increment.Increment, "_replaced_gold", lambda self, keys: calls.append("keys") or {})
    many = [(1000 + i, 100 + i, day("2024-06-01"), "shipped", "web", money("1.00")) for i in range(40)]
    buyers = [(100 + i, "A", "B", f"a{i}@x.org", "4", "Riga", "lv", "4", "vip", day("2024-06-01")) for i in range(40)]
    land(lake, {"orders": feed(spark, "orders", many), "customers": feed(spark, "customers", buyers)}, "d1b")
    increment.run_increment(spark, lake.root, AS_OF, NOW, "r1")
    land(lake, {"payments": feed(spark, "payments", [(9, 1000, "paypal", money("1.00"), day("2024-06-02"), "completed")])}, "d2")
    increment.run_increment(spark, lake.root, AS_OF, LATER, "r2")
    assert calls == ["keys"]
