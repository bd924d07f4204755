"""Ranks over whole groups, and the scores by quarters that use them."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from lodestrata.functions.ranks import global_ranks, ntile
from lodestrata.operators import rfm
from tests.conftest import NOW, by, money


def halves(n: int, k: int) -> list[int]:
    """ntile by its definition: ``n`` rows in ``k`` buckets."""
    sizes = [n // k + (i < n % k) for i in range(k)]
    return [i + 1 for i, size in enumerate(sizes) for _ in range(size)]


@pytest.mark.parametrize("buckets", [1, 3, 4, 7])
def test_ntile(spark, buckets):
    rows = [(n, r) for n in range(1, 30) for r in range(n)]
    df = spark.createDataFrame(rows, "total long, rank long")
    got = df.select("total", "rank", ntile(buckets, F.col("rank"), F.col("total")).alias("t")).collect()
    assert all(x.t == halves(x.total, buckets)[x.rank] for x in got)


def test_ranks_with_a_hot_value(spark):
    """A third of all rows has one value; ranges must cut through it."""
    rng = random.Random(1)
    rows = [("a" if i % 7 else "b", 5 if i % 3 == 0 else rng.choice([None, *range(40)]), i) for i in range(6000)]
    rows += [("only", None, -1), (None, 3, -2), (None, 2, -3)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, v long, id long").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "11")
    try:
        ranked = global_ranks(df, ["g"], ["v", "id"])
        got = ranked.collect()
        ranges = ranked.groupBy(F.spark_partition_id()).count().collect()
        plan = ranked._jdf.queryExecution().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    groups = {}
    for g, v, i in rows:
        groups.setdefault(g, []).append((v is not None, v or 0, i))
    want = {(g, x[2]): (r, len(found)) for g, found in groups.items() for r, x in enumerate(sorted(found))}
    assert {(x.g, x.id): (x.rank, x.total) for x in got} == want and len(got) == len(rows)
    # No task sees more than a part of a group, and nothing is gathered in one.
    assert max(x["count"] for x in ranges) < len(rows) / 2
    assert "SinglePartition" not in plan and "hashpartitioning(g#" in plan and "_range#" in plan


def brute(rows):
    """rows: customer, recency, frequency, monetary."""
    n = len(rows)
    quarters = halves(n, 4)

    def ranked(at):
        order = sorted(rows, key=lambda x: (9999 if x[at] is None else x[at], x[0]))
        return {x[0]: quarters[i] for i, x in enumerate(order)}

    r, f, m = ranked(1), ranked(2), ranked(3)
    out = {}
    for key, *_ in rows:
        scores = 5 - r[key], f[key], m[key]
        total = sum(scores)
        out[key] = (*scores, "CHAMPION" if total >= 11 else "LOYAL" if total >= 8 else "AT_RISK" if total >= 5
                    else "HIBERNATING")
    return out


@pytest.mark.parametrize("size", [1, 3, 4, 6, 211])
def test_rfm_ntile(spark, size):
    rng = random.Random(size)
    rows = [(i * 3, rng.choice([None, 1, 1, 2, 400]), rng.randint(1, 3), money(rng.randint(0, 5))) for i in range(size)]
    frame = spark.createDataFrame(
        [*rows, (-1, None, 0, money(0)), (-2, None, None, None)],
        "customer_id bigint, days_since_last_order int, total_orders bigint, lifetime_spend decimal(22,2)",
    )
    got = by(rfm.rfm_ntile(frame, NOW), "customer_id")
    assert {k: (v["recency_score"], v["frequency_score"], v["monetary_score"], v["rfm_segment"])
            for k, v in got.items()} == brute(rows)
    assert rfm.rfm_ntile(frame.filter("total_orders = 0"), NOW).count() == 0
