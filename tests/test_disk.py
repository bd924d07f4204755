"""What runs leave on disk, and what their models move."""

from __future__ import annotations

import re
import time
from concurrent.futures import ThreadPoolExecutor
from decimal import Decimal

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from checks import queries
from lodestrata.functions.columns import cents_sum, cents_where
from lodestrata.operators import gold
from lodestrata.operators.silver import build_silver
from lodestrata.plans import medallion
from lodestrata.session import FREES_SHUFFLES, shuffles_freed
from lodestrata.sources.tables import Lake
from tests.conftest import AS_OF, NOW, ROWS, by, day, feed, money
from tests.test_increment import land
from tests.test_plans import no_broadcast  # noqa: F401


@pytest.fixture()
def lake(spark, tmp_path):
    found = Lake(spark, str(tmp_path / "lake"))
    land(found, {name: feed(spark, name) for name in ROWS}, "d1")
    return found


def shuffle_files(spark) -> set[str]:
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return set(re.findall(r"shuffle_[0-9_]+\.data", files.mkString("\n")))


def test_shuffles_of_a_write_are_deleted(spark, tmp_path):
    def left(name: str) -> set[str]:
        before = shuffle_files(spark)
        rows = spark.range(2000).groupBy((F.col("id") % 100).alias("k")).count()
        rows.write.parquet(str(tmp_path / name))
        for _ in range(50):
            found = shuffle_files(spark) - before
            if not found:
                break
            time.sleep(0.1)
        return found

    assert left("outside")
    with shuffles_freed(spark):
        assert not left("inside")
        with shuffles_freed(spark):
            pass
        assert not left("again")
    assert spark.conf.get(FREES_SHUFFLES, None) is None


def test_threads_leave_the_setting_as_it_was(spark):
    def enter(_):
        with shuffles_freed(spark):
            return spark.conf.get(FREES_SHUFFLES, None)

    with ThreadPoolExecutor(8) as pool:
        assert set(pool.map(enter, range(100))) == {"true"}
    assert spark.conf.get(FREES_SHUFFLES, None) is None


def test_a_frame_that_is_executed_twice_is_right(spark):
    with shuffles_freed(spark):
        rows = spark.range(2000).groupBy((F.col("id") % 7).alias("k")).count()
        assert sorted(rows.collect()) == sorted(rows.collect())


@pytest.fixture()
def settings(monkeypatch):
    """How the setting stood when each table was written."""
    seen, write = {}, Lake._write

    def noted(self, df, layer, name, *args, **kwargs):
        seen[layer, name] = df.sparkSession.conf.get(FREES_SHUFFLES, None)
        return write(self, df, layer, name, *args, **kwargs)

    monkeypatch.setattr(Lake, "_write", noted)
    return seen


def test_stored_layers_free_their_shuffles(spark, settings, monkeypatch):
    monkeypatch.setattr(queries, "_STORED", {})
    queries.Layers(spark, "/root/testdata/sf0.001").table("silver", "stg_payments")
    assert ("silver", "stg_payments") in settings and set(settings.values()) == {"true"}
    assert spark.conf.get(FREES_SHUFFLES, None) is None


def test_a_run_that_fails_restores_the_setting(spark, lake, monkeypatch):
    monkeypatch.setattr(medallion.gates, "validate_bronze", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError):
        medallion.run_medallion(spark, lake.root, AS_OF, NOW, "r1")
    assert spark.conf.get(FREES_SHUFFLES, None) is None


def test_stored_files_are_zstd(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    lake.publish(feed(spark, "orders"), "bronze", "orders")
    files = list((tmp_path / "lake/bronze/orders/data").rglob("*.parquet"))
    assert files and {pq.read_metadata(f).row_group(0).column(0).compression for f in files} == {"ZSTD"}


def test_large_models_are_written_one_after_the_other():
    running, most, done = set(), [0], []

    def write(name):
        running.add(name)
        most[0] = max(most[0], len(running & set(medallion.LARGE_MODELS)))
        time.sleep(0.02)
        running.discard(name)
        done.append(name)

    names = [*medallion.LARGE_MODELS, "dim_customers", "dim_dates"]
    medallion.write_tables({name: (lambda name=name: write(name)) for name in names})
    assert most == [1] and sorted(done) == sorted(names)
    with pytest.raises(ZeroDivisionError):
        medallion.write_tables({name: (lambda: 1 / 0) for name in names})


# --------------------------------------------------------------- sums of money

GREATEST = Decimal("9999999999999999.99")


@pytest.mark.parametrize("kind, of", [("decimal(18,2)", "decimal(28,2)"), ("decimal(12,2)", "decimal(22,2)"),
                                      ("decimal(10,2)", "decimal(20,2)")])
def test_sums_of_cents_are_sums(spark, kind, of):
    rows = [(1, money(v)) for v in ("0.01", "-0.02", "10737418.24", "-10737418.25", "99999999.99")]
    rows += [(2, None), (3, None), (3, money("-5.00")), (4, money("0.00"))]
    rows += [(5, GREATEST)] * 40 + [(6, -GREATEST)] * 40 if kind == "decimal(18,2)" else []
    df = spark.createDataFrame(rows, f"k int, v {kind}")
    low = F.col("v") < 0
    found = df.groupBy("k").agg(cents_sum("v", of).alias("sum"), cents_where(low, "v", "decimal(28,2)").alias("low"))
    wanted = df.groupBy("k").agg(F.sum("v").alias("sum"), F.sum(F.when(low, F.col("v")).otherwise(0)).alias("low"))
    assert found.schema["sum"] == wanted.schema["sum"]
    assert sorted(found.collect(), key=str) == sorted(wanted.collect(), key=str)


# ---------------------------------------------------------------------- models


@pytest.fixture()
def odd(spark, bronze):
    """Silver with repeated, missing and unknown keys."""
    orders = [*ROWS["orders"], ROWS["orders"][0], (21, 2, day("2024-06-01"), "pending", None, money("7.00")),
              (22, 2, None, "completed", "web", money("8.00"))]
    items = [*ROWS["order_items"], *ROWS["order_items"], (110, 10, None, 1, money("3.00"), None, None),
             (111, 99, 7, 5, money("4.00"), None, None), (112, 22, 9, 2, money("5.00"), money("1.00"), None),
             (113, 21, None, 1, money("6.00"), money("6.00"), None), (114, 21, 404, 4, money("9.00"), None, None)]
    return build_silver({**bronze, "orders": feed(spark, "orders", orders), "order_items": feed(spark, "order_items", items)}, AS_OF)


def test_days_count_products_and_customers_apart(odd):
    found = by(gold.fact_daily_revenue(odd), "revenue_date")
    lines = odd["stg_order_items"].join(odd["stg_orders"].select("order_id", F.to_date("order_date").alias("d")), "order_id")
    wanted = by(lines.groupBy("d").agg(
        F.sum("quantity").alias("total_units_sold"), F.sum("discount").alias("total_discount"),
        F.sum("line_total").alias("total_line_revenue"), F.sum("item_margin").alias("total_item_margin"),
        F.count_distinct("product_id").alias("unique_products_sold")), "d")
    assert len(wanted) > 3
    for date, row in wanted.items():
        if date is not None:
            assert {c: found[date][c] for c in row if c != "d"} == {c: v for c, v in row.items() if c != "d"}
    buyers = by(odd["stg_orders"].groupBy(F.to_date("order_date").alias("d")).agg(
        F.count_distinct("customer_id").alias("n"), F.sum("total_amount").alias("sum")), "d")
    assert {d: (x["unique_customers"], x["gross_revenue"]) for d, x in found.items()} == {
        d: (x["n"], x["sum"]) for d, x in buyers.items()}


def test_order_measures_equal_a_distinct_count(odd):
    found = by(gold.order_items_agg(odd), "order_id")
    wanted = by(odd["stg_order_items"].groupBy("order_id").agg(
        F.count("*").alias("line_item_count"), F.sum("quantity").alias("total_units"),
        F.sum("line_total").alias("items_total"), F.sum("discount").alias("total_discount"),
        F.sum("item_margin").alias("total_item_margin"), F.count_distinct("product_id").alias("unique_products"),
        (F.sum("discount_pct").cast("double") / F.count("discount_pct")).alias("avg_discount_pct"),
        F.count_if("is_discounted").alias("discounted_line_items")), "order_id")
    assert found == wanted and found[21]["unique_products"] == 1


def moved_columns(df, key: str) -> list[str]:
    """The columns of each shuffle by a key, as the plan before execution has them."""
    plan = df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    return [columns for columns, keys in re.findall(
        r"\) Exchange\s*\nInput \[\d+\]: \[([^\]]*)\]\nArguments: hashpartitioning\(([^)]*)\)", plan)
        if re.sub(r"#\d+L?|, \d+$", "", keys) == key]


def test_sums_move_as_whole_numbers(spark, staged, no_broadcast):  # noqa: F811
    """Spark's own sum of a decimal comes with a flag ``isEmpty`` and takes four times the room of a long."""
    models = gold.build_gold(staged, AS_OF)
    assert moved_columns(models["fact_sales"], "order_id")
    for name, key in (("fact_sales", "order_id"), ("dim_products", "product_id"), ("fact_payment_summary", "order_id"),
                      ("dim_customers", "customer_id"), ("fact_daily_revenue", "revenue_date, product")):
        moved = moved_columns(models[name], key)
        assert moved and not any("isEmpty" in columns for columns in moved), name


def test_products_of_orders_that_are_known(spark, staged, no_broadcast):  # noqa: F811
    """What hangs on an item alone is summed up where it lies, with the same result."""
    narrow = gold.dim_products(staged, items_have_orders=True)
    assert sorted(narrow.collect(), key=str) == sorted(gold.dim_products(staged).collect(), key=str)
    assert narrow.schema == gold.dim_products(staged).schema
    to_orders = [x for x in moved_columns(narrow, "order_id") if "product_id" in x]
    assert to_orders and not any("discount" in x for x in to_orders)
