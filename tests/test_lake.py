"""Versions of stored tables: what readers see before, while and after a table is written."""

from __future__ import annotations

import datetime as dt
import uuid

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from checks.queries import Layers, dirty_layers
from lodestrata.operators import gates
from lodestrata.plans import medallion
from lodestrata.sources.tables import Lake
from tests.conftest import AS_OF, NOW, ROWS, by, feed


@pytest.fixture()
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


def ids(df):
    return sorted(x[0] for x in df.select("order_id").collect())


def test_a_killed_write_leaves_the_old_table(spark, lake):
    orders = feed(spark, "orders")
    lake.publish(orders, "silver", "orders")
    before = lake.history("silver", "orders")
    # Fails in a task, when others have written.
    broken = orders.repartition(4).withColumn("status", F.when(F.col("order_id") == 20, F.raise_error(F.lit("lost"))))
    with pytest.raises(PySparkException):
        lake.publish(broken, "silver", "orders")
    with pytest.raises(PySparkException):
        lake.append_log(broken, "silver", "orders", "r1")
    assert ids(lake.read("silver", "orders")) == [10, 11, 12, 20]
    assert lake.history("silver", "orders") == before
    lake.publish(orders.limit(1), "silver", "orders")
    assert lake.read("silver", "orders").count() == 1


def test_a_write_that_ends_before_its_log_row_does_not_count(spark, lake, monkeypatch):
    lake.publish(feed(spark, "orders"), "silver", "orders")
    monkeypatch.setattr(Lake, "_note", lambda self, entry: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError):
        lake.publish(feed(spark, "orders", ROWS["orders"][:1]), "silver", "orders")
    monkeypatch.undo()
    assert lake.read("silver", "orders").count() == 4
    found = by(lake.inventory({"silver": ["orders"]}), "table_name")
    assert found["ORDERS"]["row_count"] == 4


def test_readers_keep_their_version(spark, lake):
    lake.publish(feed(spark, "orders"), "silver", "orders")
    reader = lake.read("silver", "orders")
    assert reader.count() == 4
    # A table may be written from itself.
    lake.publish(lake.read("silver", "orders").filter("order_id > 11"), "silver", "orders")
    assert ids(reader) == [10, 11, 12, 20] and ids(lake.read("silver", "orders")) == [12, 20]
    assert ids(lake.read("silver", "orders", version=1)) == [10, 11, 12, 20]
    assert lake.retire("silver", "orders") == 1
    assert ids(lake.read("silver", "orders")) == [12, 20] and lake.retire("silver", "orders") == 0
    lake.publish(feed(spark, "orders"), "silver", "orders")
    assert lake.retire("silver", "orders", keep=2) == 0 and lake.retire("silver", "orders") == 1
    assert lake.read("silver", "orders").count() == 4


def test_a_run_adds_its_rows_once(spark, lake):
    orders = feed(spark, "orders")
    for run, n in (("r1", 1), ("r2", 2), ("r2", 3), ("r1", 2)):
        found = lake.append_log(orders.limit(n), "logs", "orders", run)
    assert found.count() == 5
    # Without the name of a run each write adds.
    lake.append_log(orders.limit(1), "logs", "orders")
    assert lake.append_log(orders.limit(1), "logs", "orders").count() == 7
    assert by(lake.inventory({"logs": ["orders"]}), "table_name")["ORDERS"]["row_count"] == 7
    lake.publish(orders.limit(1), "logs", "orders")
    assert lake.append_log(orders.limit(1), "logs", "orders", "r1").count() == 2


def test_a_repeated_run_leaves_one_set_of_rows_in_every_log(spark, lake):
    for name in ROWS:
        lake.publish(feed(spark, name), "bronze", name)
    logs = [("bronze", "data_profile_log"), ("silver", "anomaly_flags"), ("gold", "pipeline_run_summary"),
            ("gold", "customer_rfm_scores")]

    def run(name, ts=NOW):
        medallion.run_medallion(spark, lake.root, AS_OF, ts, name)
        return {log: lake.read(*log).count() for log in logs}

    once = run("r1")
    assert run("r1") == once
    twice = run("r2", NOW + dt.timedelta(hours=1))
    assert all(twice[log] == 2 * once[log] for log in logs[:3]) and twice[logs[3]] == once[logs[3]]
    assert run("r1") == twice


def test_empty_tables_and_odd_columns(spark, lake):
    empty = feed(spark, "orders", [])
    assert lake.publish(empty, "silver", "orders").count() == 0
    assert lake.publish(empty, "silver", "orders", partition_by=["status"]).count() == 0
    assert lake.replace_if_any(empty, "silver", "none") is None
    clashing = feed(spark, "orders").selectExpr("order_id", "status as kind", "1 as version", "'x' as layer", "2 as row_count")
    assert lake.append_log(clashing, "silver", "odd", "r").columns == clashing.columns
    found = by(lake.inventory({"silver": ["orders", "odd", "none"]}), "table_name")
    assert {k: v["row_count"] for k, v in found.items()} == {"ORDERS": 0, "ODD": 4}


def test_inventory_opens_no_data_file(spark, lake):
    """Even where the data files are gone, the logs tell what was written."""
    for name in ("orders", "customers"):
        lake.publish(feed(spark, name), "bronze", name)
    spark.createDataFrame([(1,)], "x int").write.parquet(lake.path("bronze", "plain"))
    for version in lake.history("bronze", "orders"):
        spark.createDataFrame([], "gone int").write.mode("overwrite").parquet(f"{lake.root}/{version.folder}")
    found = by(lake.inventory({"bronze": ["orders", "customers", "plain"]}), "table_name")
    assert {k: v["row_count"] for k, v in found.items()} == {"ORDERS": 4, "CUSTOMERS": 3, "PLAIN": 1}
    assert all(v["bytes"] > 0 and v["last_altered"] for v in found.values())
    with pytest.raises(ValueError):
        Lake(spark, f"{lake.root}/nothing").inventory({"bronze": ["orders"]})


def test_a_report_waits_for_its_tables_only(spark, bronze):
    x = Layers(spark, f"own rows {uuid.uuid4()}", bronze)
    assert x.personal().count() == 11
    _, written = x._stored_root()
    assert written == {("bronze", n) for n in ("customers", "orders", "payments")} | {
        ("silver", n) for n in ("stg_customers", "stg_orders", "stg_payments")} | {("gold", "dim_customers")}
    assert x.flag_log().select("detected_at").distinct().count() == 2
    assert ("silver", "stg_order_items") in written and not written & {("gold", "fact_sales"), ("bronze", "data_profile_log")}
    # The inventory is of everything, written at several at a time; what was there is not written again.
    assert x.stored_tables().count() == 23 and len(written) == 24
    versions = [x.lake().history(layer, name) for layer, name in written]
    assert sorted(map(len, versions)) == [1] * 20 + [2] * 4
    logged = {r["table_name"]: r["row_count"] for r in x.run_log().filter("run_id = 'run-2'").collect()}
    assert len(logged) == 20 and logged["STG_ORDERS"] == 4 and logged["FACT_SALES"] == 4


def test_faults_are_looked_for_in_the_tables_asked_for(spark, bronze):
    x = Layers(spark, f"own rows {uuid.uuid4()}", bronze)
    assert not gates.validate_bronze(dirty_layers(x)["bronze"]).filter("not passed").isEmpty()
    assert x._stored_root()[1] == {("bronze", n) for n in bronze}
