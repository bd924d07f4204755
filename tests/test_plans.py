"""What the physical plans must and must not do."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from checks.queries import Layers
from lodestrata.operators import anomalies, gates, gold, rfm, silver
from lodestrata.sources.sample import AS_OF
from lodestrata.sources.tables import Lake
from tests.conftest import NOW, ROWS, feed

SF = "/root/testdata/sf0.001"


def plan_text(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def count(pattern: str, text: str) -> int:
    tree = text.split("\n\n")[0]
    return len(re.findall(pattern, tree))


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Silver tables as files, so that plans start at scans."""
    lake = Lake(spark, str(tmp_path_factory.mktemp("lake")))
    layers = Layers(spark, SF)
    return {name: lake.publish(layers.silver[name], "silver", name) for name in layers.silver}


@pytest.fixture()
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_no_cross_joins_anywhere(stored, no_broadcast):
    frames = list(gold.build_gold(stored, AS_OF).values())
    frames += [gates.validate_silver(stored), anomalies.anomaly_flags(stored, AS_OF, "r", NOW),
               rfm.rfm_scores(frames[0], NOW)]
    for df in frames:
        text = plan_text(df)
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_only_bounded_sides_are_hinted(stored, no_broadcast):
    for df in gold.build_gold(stored, AS_OF).values():
        assert "BroadcastHashJoin" not in plan_text(df)


def test_scans_read_needed_columns_only(stored):
    text = plan_text(gold.preferred_channel(stored))
    assert "ReadSchema: struct<customer_id:bigint,channel:string>" in text
    text = plan_text(anomalies.high_discount(stored["stg_order_items"]))
    assert "PushedFilters: [IsNotNull(discount_pct), GreaterThan(discount_pct,50" in text


def test_sales_joins_reuse_the_order_partitioning(stored, no_broadcast):
    """Orders move twice (customer, order); each reduced child joins without a move of its own."""
    text = plan_text(gold.fact_sales(stored))
    assert count("SortMergeJoin", text) == 5
    # orders and customers on the customer, orders on the order; only orders (customer, order);
    # items (order and product, order); payments; shipments
    assert count(r"Exchange \(", text) == 9


def test_unique_orders_saves_a_shuffle(stored, no_broadcast):
    exact = count(r"Exchange \(", plan_text(gold.customer_orders(stored, AS_OF)))
    plain = count(r"Exchange \(", plan_text(gold.customer_orders(stored, AS_OF, True)))
    assert plain == exact - 1 == 1


def test_bucketed_tables_group_and_join_without_shuffle(spark, stored, no_broadcast, tmp_path):
    lake = Lake(spark, str(tmp_path))
    tables = dict(stored)
    try:
        for name in ("stg_orders", "stg_payments"):
            tables[name] = lake.publish_bucketed(stored[name], f"bucketed_{name}", "order_id", 4)
        df = gold.fact_payment_summary(tables)
        assert count(r"Exchange \(", plan_text(df)) == 0
        assert df.count() == stored["stg_orders"].count()
    finally:
        for name in ("stg_orders", "stg_payments"):
            spark.sql(f"drop table if exists bucketed_{name}")


def test_order_statistics_leave_flat_plans(spark, stored):
    """What the rounds found is in the plan as plain values; few jobs found it."""
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("quartiles", "")
    quartiles = anomalies.amount_quartiles(stored["stg_orders"])
    assert len(tracker.getJobIdsForGroup("quartiles")) <= 9
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert "FileScan" not in plan_text(quartiles)
    flags = anomalies.anomaly_flags(stored, AS_OF, "r", NOW)
    assert len(plan_text(flags)) < 100_000


HOT = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture()
def eager_splits(spark, no_broadcast):
    before = {key: spark.conf.get(key, None) for key in HOT}
    for key, value in HOT.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture()
def hot(spark, bronze):
    """Two thirds of the items on one product, of the orders on one customer."""
    ids = spark.range(0, 30000, 1, 8)
    spread = F.col("id") % 3 == 0

    def kept(value, other):
        return F.when(spread, value).otherwise(F.lit(other)).cast("bigint")

    def cents(value):
        return F.lit(value).cast("decimal(10,2)")

    orders = ids.select(
        F.col("id").alias("order_id"), kept(F.col("id") % 2000, 1).alias("customer_id"),
        F.lit(NOW).cast("timestamp_ntz").alias("order_date"), F.lit("returned").alias("status"),
        F.lit("web").alias("channel"), F.lit(2).cast("decimal(12,2)").alias("total_amount"),
    )
    items = spark.range(0, 60000, 1, 8).select(
        F.col("id").alias("order_item_id"), kept(F.col("id") % 30000, 11).alias("order_id"),
        kept(F.col("id") % 97, 7).alias("product_id"), F.lit(1).cast("bigint").alias("quantity"),
        cents(5).alias("unit_price"), cents(1).alias("discount"), cents(4).alias("line_total"),
    )
    return {**bronze, "orders": orders, "order_items": items}


def executed(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_product_is_split(hot, eager_splits):
    items = silver.stg_order_items(hot)
    assert "skew=true" in executed(items)
    assert items.count() == 60000


def test_hot_keys_are_split_below_an_aggregate(spark, hot, eager_splits):
    """The aggregate could reuse the join's partitioning; the split goes first."""
    staged = silver.build_silver(hot, AS_OF)
    sales = gold.product_sales(staged)
    assert "skew=true" in executed(sales)
    expected = sum(1 for i in range(60000) if i % 3 or i % 97 == 7)
    assert sales.filter("product_id = 7").first()["total_units_sold"] == expected
    facts = gold.fact_sales(staged)
    assert "skew=true" in executed(facts)
    assert facts.count() == 30000
    assert facts.agg(F.sum("total_units")).first()[0] == 60000


def test_results_do_not_depend_on_partitioning(spark, bronze):
    staged = silver.build_silver(bronze, AS_OF)
    spread = silver.build_silver(
        {name: feed(spark, name, ROWS[name]).repartition(7) for name in ROWS}, AS_OF
    )
    for build in (lambda s: gold.dim_customers(s, AS_OF), gold.dim_products, gold.fact_sales):
        assert sorted(build(staged).collect(), key=str) == sorted(build(spread).collect(), key=str)


def test_product_sums_move_items_once(stored, no_broadcast):
    """Orders and items on the order, then one row per product and task: distinct orders move nothing more."""
    text = plan_text(gold.product_sales(stored))
    assert count(r"Exchange \(", text) == 3
