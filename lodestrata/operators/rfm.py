"""Recency, frequency and monetary scores of customers with orders."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.functions.columns import moment
from lodestrata.functions.order_stats import order_statistics
from lodestrata.functions.ranks import global_ranks, ntile

# Recency of a customer without one, and the score used when no
# customer has a recency at all.
UNKNOWN_RECENCY = 9999
SCORE_WITHOUT_CUTS = 2
# Least sum of the three scores of each segment (mean score of
# at least 3.5, 2.5 and 1.5).
SEGMENTS = [(11, "CHAMPION"), (8, "LOYAL"), (5, "AT_RISK")]
LOWEST_SEGMENT = "HIBERNATING"
MEASURES = ["recency", "frequency", "monetary"]


def _measures(dim_customers: DataFrame) -> DataFrame:
    return dim_customers.filter(F.col("total_orders") > 0).select(
        "customer_id",
        F.col("days_since_last_order").cast("bigint").alias("recency"),
        F.col("total_orders").cast("bigint").alias("frequency"),
        (F.col("lifetime_spend") * 100).cast("bigint").alias("monetary"),
    )


def rfm_cuts(dim_customers: DataFrame) -> DataFrame:
    """One row with cut points ``<measure>_1 .. _3``.

    Cut i of n sorted values is the one at position floor(n * i / 4).
    """
    values = _measures(dim_customers).select(*MEASURES).unpivot([], MEASURES, "grp", "v")
    ranks = {str(i): F.floor(F.col("total") * i / 4) for i in (1, 2, 3)}
    found = order_statistics(values, ranks)
    return found.agg(*[
        F.max(F.when((F.col("grp") == m) & (F.col("tag") == tag), F.col("v"))).alias(f"{m}_{tag}")
        for m in MEASURES
        for tag in ranks
    ])


def _score(value: Column, measure: str, low_is_best: bool) -> Column:
    cut = [F.col(f"cuts.{measure}_{i}") for i in (1, 2, 3)]
    place = (
        F.when(cut[0].isNull(), SCORE_WITHOUT_CUTS)
        .when(value <= cut[0], 4 if low_is_best else 1)
        .when(value <= cut[1], 3 if low_is_best else 2)
        .when(value <= cut[2], 2 if low_is_best else 3)
    )
    return place.otherwise(1 if low_is_best else 4).cast("bigint")


def _segment() -> Column:
    total = F.col("recency_score") + F.col("frequency_score") + F.col("monetary_score")
    segment = F
    for least, name in SEGMENTS:
        segment = segment.when(total >= least, name)
    return segment.otherwise(LOWEST_SEGMENT).alias("rfm_segment")


def rfm_scores(dim_customers: DataFrame, ts: dt.datetime) -> DataFrame:
    """Scores 1 to 4 per customer, and the segment of their mean."""
    cuts = rfm_cuts(dim_customers)
    one_row = cuts.select(F.struct(*cuts.columns)).scalar().alias("cuts")
    recency = F.coalesce("recency", F.lit(UNKNOWN_RECENCY))
    return (
        _measures(dim_customers)
        .select("*", one_row)
        .select(
            "customer_id",
            _score(recency, "recency", True).alias("recency_score"),
            _score(F.col("frequency"), "frequency", False).alias("frequency_score"),
            _score(F.col("monetary"), "monetary", False).alias("monetary_score"),
        )
        .select("*", _segment(), moment(ts).alias("scored_at"))
    )


def rfm_ntile(dim_customers: DataFrame, ts: dt.datetime) -> DataFrame:
    """Scores 1 to 4 by quarters of equal size: equal values are split between quarters by customer id.

    The three measures are ranked at once, each over all customers, by ranges; no task holds
    a measure.  A customer without a recency counts as long gone.
    """
    rows = _measures(dim_customers).withColumn("recency", F.coalesce("recency", F.lit(UNKNOWN_RECENCY)))
    ranked = global_ranks(
        rows.unpivot(["customer_id"], MEASURES, "measure", "value"), ["measure"], ["value", "customer_id"]
    )
    quarter = ntile(4, F.col("rank"), F.col("total"))
    # Few days since the last order are best.
    scored = ranked.withColumn("score", F.when(F.col("measure") == "recency", 5 - quarter).otherwise(quarter))
    return (
        scored.groupBy("customer_id")
        .agg(*[F.max(F.when(F.col("measure") == m, F.col("score"))).alias(f"{m}_score") for m in MEASURES])
        .select("*", _segment(), moment(ts).alias("scored_at"))
    )
