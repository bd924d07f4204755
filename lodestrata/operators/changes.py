"""Change feed between two versions of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def snapshot_diff(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows that differ, with ``action`` INSERT, UPDATE or DELETE.

    ``key`` is unique in each version.  A changed row carries its new values,
    a deleted row its last ones.  NULL equals NULL.
    """
    columns = new.columns
    before = old.select(F.col(key).alias("k"), F.struct(*columns).alias("before"))
    after = new.select(F.col(key).alias("k"), F.struct(*columns).alias("after"))
    action = (
        F.when(F.col("before").isNull(), "INSERT")
        .when(F.col("after").isNull(), "DELETE")
        .when(~F.col("before").eqNullSafe(F.col("after")), "UPDATE")
    )
    return (
        before.join(after, "k", "full")
        .select(action.alias("action"), F.coalesce("after", "before").alias("row"))
        .filter(F.col("action").isNotNull())
        .select("action", "row.*")
    )
