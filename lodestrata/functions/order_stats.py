"""Exact order statistics without sorting or gathering the values.

Spark's exact ``percentile`` merges every distinct value of a group into one
buffer, which one task must hold.  Here the k-th smallest value is narrowed
down instead: each round cuts the current value range into at most ``FAN_OUT``
equal intervals, counts the values in each, and keeps the one that contains
rank k.  A round is one flat job over the counts of the values; what goes
through the driver are at most ``FAN_OUT`` counts of each range.  It ends when every range
is one value, so a range of 67 million cents takes two rounds, whatever the number of
values.  The result depends on the values alone, so a recomputed task gives the
same answer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FAN_OUT = 1 << 13


def order_statistics(values: DataFrame, ranks: dict[str, Column]) -> DataFrame:
    """The value at each wanted rank of each group.

    ``values`` has columns ``grp`` (text) and ``v`` (a long); NULL values are left
    out.  ``ranks`` maps a tag to a 0-based rank, written over ``total``, the
    number of values in the group.  Returns ``grp, tag, total, v``; a rank
    outside the group has no row.  Runs its jobs when called; groups should be
    few, as the counts of their ranges go through the driver.
    """
    counts = values.filter(F.col("v").isNotNull()).groupBy("grp", "v").agg(
        F.count("*").alias("n")
    ).persist()
    try:
        wanted = F.array(*[
            F.struct(F.lit(tag).alias("tag"), rank.cast("bigint").alias("k"))
            for tag, rank in ranks.items()
        ])
        state = counts.groupBy("grp").agg(
            F.min("v").alias("lo"), F.max("v").alias("hi"), F.sum("n").alias("total")
        ).select("grp", "total", "lo", "hi", F.inline(wanted)).filter(
            (F.col("k") >= 0) & (F.col("k") < F.col("total"))
        ).collect()
        # (group, lowest, highest) -> ranks within it; adjacent ranks share one range.
        found: dict[tuple, int] = {}
        open_: dict[tuple, set[int]] = {}
        places = {}
        for x in state:
            places[x.grp, x.tag] = ((x.grp, x.lo, x.hi, x.k), x.total)
            open_.setdefault((x.grp, x.lo, x.hi), set()).add(x.k)
        moved: dict[tuple, tuple] = {}
        while open_:
            going = {}
            for (grp, lo, hi), ks in open_.items():
                if lo == hi:
                    found.update({(grp, lo, hi, k): lo for k in ks})
                else:
                    going[grp, lo, hi] = ks
            open_ = {}
            for old, new in _narrow(counts, going).items():
                moved[old] = new
                open_.setdefault(new[:3], set()).add(new[3])
    finally:
        counts.unpersist()

    def value(place: tuple) -> int:
        while place in moved:
            place = moved[place]
        return found[place]

    rows = [(grp, tag, total, value(place)) for (grp, tag), (place, total) in places.items()]
    return values.sparkSession.createDataFrame(rows, "grp string, tag string, total long, v long")


def _narrow(counts: DataFrame, ranges: dict[tuple, set[int]]) -> dict:
    """The narrower range, and the rank within it, of each range and rank."""
    if not ranges:
        return {}
    listed = [(grp, lo, hi, (hi - lo) // FAN_OUT + 1) for grp, lo, hi in ranges]
    value, group = F.col("v"), F.col("grp")
    entries = F.array(*[
        F.when((group == grp) & value.between(lo, hi), F.struct(
            F.lit(spot).alias("spot"), F.expr(f"(v - ({lo}L)) div {width}L").alias("bucket")))
        for spot, (grp, lo, hi, width) in enumerate(listed)
    ])
    buckets = counts.select("n", F.explode(entries).alias("e")).filter("e is not null").groupBy("e").agg(
        F.sum("n").alias("n")
    ).select("e.*", "n").collect()
    moved, upto = {}, dict.fromkeys(range(len(listed)), 0)
    for x in sorted(buckets):
        grp, lo, hi, width = listed[x.spot]
        before, upto[x.spot] = upto[x.spot], upto[x.spot] + x.n
        start = lo + x.bucket * width
        for k in ranges[grp, lo, hi]:
            if before <= k < upto[x.spot]:
                moved[grp, lo, hi, k] = (grp, start, min(hi, start + width - 1), k - before)
    return moved
