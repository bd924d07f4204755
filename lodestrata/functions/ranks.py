"""Ranks over whole groups without a task that holds a group.

``row_number`` over a window sorts each of its groups in one task.  Here the rows are
dealt by ranges of (group, order), a task numbers its own rows, and the numbers of the
rows in the ranges before are added: a group of any size spreads over as many tasks
as it has ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestrata.session import fresh_dir


def global_ranks(rows: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """``rows`` with their 0-based ``rank`` in their group and the ``total`` of its rows.

    ``group`` and ``order`` together name each row once, so ranks don't depend on how rows are dealt
    and equal values of the first columns spread over ranges, too.  NULL comes first.  The dealt rows are
    written below the shared folder: a task that is repeated must find the same ranges.
    """
    spark, path = rows.sparkSession, fresh_dir(rows.sparkSession, "ranks")
    rows.repartitionByRange(*group, *order).withColumn("_range", F.spark_partition_id()).write.parquet(path)
    dealt = spark.read.parquet(path)
    keys = [*group, "_range"]
    # One row for each group and range.
    counts = dealt.groupBy(*keys).agg(F.count("*").alias("n"))
    whole = Window.partitionBy(*group)
    before = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        *[F.col(c).alias(f"_{c}") for c in keys],
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"), F.sum("n").over(whole).alias("total"),
    )
    local = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in keys]
    return dealt.withColumn("_local", local).join(offsets, same).select(
        *rows.columns, (F.col("offset") + F.col("_local")).alias("rank"), "total"
    )


def ntile(buckets: int, rank: Column, total: Column) -> Column:
    """The bucket, from 1 on, of a 0-based rank: sizes differ by one at most, larger buckets first."""
    size, more = F.floor(total / buckets), total % buckets
    in_larger = rank < more * (size + 1)
    # A bucket of the larger size exists only where the rank may lie in it.
    return F.when(in_larger, F.floor(rank / (size + 1))).otherwise(
        more + F.floor((rank - more * (size + 1)) / F.greatest(size, F.lit(1)))
    ).cast("bigint") + 1
