"""Column profiles and the row-count summary of a run."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestrata.functions.columns import count_where, half_up, moment, or_zero

Tables = Mapping[str, DataFrame]


def _with_all_columns(measured: DataFrame, tables: Tables) -> DataFrame:
    """Columns without any row (an empty table) get zeros."""
    columns = [
        (name.upper(), column.upper(), spot)
        for name, df in tables.items()
        for spot, column in enumerate(df.columns)
    ]
    listed = measured.sparkSession.createDataFrame(
        columns, "table_name string, column_name string, spot int"
    )
    return listed.join(measured, ["table_name", "column_name"], "left")


def metric_rows(measured: DataFrame, run_id: str, ts: dt.datetime) -> DataFrame:
    rows, nulls = or_zero("rows"), or_zero("nulls")
    pct = F.when(rows > 0, half_up(nulls.cast("double") / rows * 100, 2)).otherwise(F.lit(0.0))

    def metric(name, value, column=None):
        column = F.col("column_name") if column is None else F.lit(column)
        return F.struct(
            column.alias("column_name"), F.lit(name).alias("metric"),
            value.cast("string").alias("metric_value"),
        )

    per_column = F.array(
        metric("NULL_COUNT", nulls),
        metric("NULL_PCT", pct),
        metric("DISTINCT_COUNT", or_zero("distincts")),
    )
    # The row count is the same for every column: take it from the first.
    per_table = F.array(metric("ROW_COUNT", rows, "*"))
    cells = F.when(F.col("spot") == 0, F.concat(per_table, per_column)).otherwise(per_column)
    return measured.select("table_name", F.inline(cells)).select(
        F.lit(run_id).alias("profile_run_id"),
        "table_name",
        "column_name",
        "metric",
        "metric_value",
        moment(ts).alias("profiled_at"),
    )


def profile_tables(
    tables: Tables, run_id: str, ts: dt.datetime, approx: bool = False,
    unique: Mapping[str, list[str]] | None = None,
) -> DataFrame:
    """Row count, and per column NULL count, NULL percent and distinct count.

    Row and NULL counts are one aggregate per table, of one row per task.  The distinct counts of all
    columns of all tables are one more: each value is a small column number and the value, and
    equal ones are combined before they move.  ``unique`` names columns that a key check has proved
    free of repeats: their values need not move.  ``approx`` replaces
    the exact distinct counts by sketches, so nothing but those one-row
    aggregates is shuffled.  NULL counts as one of the distinct values.
    """
    known = {name: set(df.columns if approx else (unique or {}).get(name, ())) for name, df in tables.items()}
    stacked = reduce(DataFrame.unionByName, [_cells(df, name, approx, known[name]) for name, df in tables.items()])
    rest = {name: [c for c in df.columns if c not in known[name]] for name, df in tables.items()}
    if any(rest.values()):
        exact = _distinct_values({name: tables[name] for name in tables if rest[name]}, rest)
        stacked = stacked.join(exact, ["table_name", "column_name"], "left").withColumn(
            "distincts", F.col("distincts") + or_zero("values")
        )
    return metric_rows(_with_all_columns(stacked, tables), run_id, ts)


def _cells(df: DataFrame, name: str, approx: bool, known: set[str]) -> DataFrame:
    """One row per column: table, column, rows, NULLs, distinct values.

    Of columns that are not ``known`` the last is 1 if there is a NULL, and 0 otherwise.
    """
    def distincts(c):
        null_counts_as_one = F.coalesce(F.max(F.col(c).isNull().cast("int")), F.lit(0))
        seen = F.lit(0)
        if c in known:
            seen = F.approx_count_distinct(c) if approx else F.count(c)
        return (seen + null_counts_as_one).cast("bigint")

    cells = [
        F.struct(
            F.lit(name.upper()).alias("table_name"),
            F.lit(c.upper()).alias("column_name"),
            F.count("*").alias("rows"),
            count_where(F.col(c).isNull()).alias("nulls"),
            distincts(c).alias("distincts"),
        )
        for c in df.columns
    ]
    return df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


def _value(field: T.StructField, number: int) -> Column:
    """A value as a column number and a long, or a text where it is no whole number; NULL for NULL."""
    column, kind = F.col(field.name), field.dataType
    if isinstance(kind, T.IntegralType):
        whole = column.cast("bigint")
    elif isinstance(kind, T.DecimalType) and kind.precision <= 18:
        whole = (column * 10**kind.scale).cast("bigint")
    elif isinstance(kind, T.DateType):
        whole = F.unix_date(column).cast("bigint")
    elif isinstance(kind, T.TimestampType):
        whole = F.unix_micros(column)
    elif isinstance(kind, T.BooleanType):
        whole = column.cast("int").cast("bigint")
    else:
        whole = None
    return F.when(column.isNotNull(), F.struct(
        F.lit(number).cast("smallint").alias("number"),
        (F.lit(None).cast("bigint") if whole is None else whole).alias("whole"),
        (column.cast("string") if whole is None else F.lit(None).cast("string")).alias("text"),
    ))


def _distinct_values(tables: Tables, columns: Mapping[str, list[str]]) -> DataFrame:
    """``table_name column_name values``: how many different values but NULL each column has.

    Narrow rows of all tables go through one aggregate; each table is read once.
    """
    names, parts = [], []
    for name, df in tables.items():
        cells = []
        for c in columns[name]:
            cells.append(_value(df.schema[c], len(names)).alias(f"c{len(names)}"))
            names.append((len(names), name.upper(), c.upper()))
        narrow = df.select(*cells)
        parts.append(narrow.unpivot([], narrow.columns, "cell", "value").filter("value is not null").select("value.*"))
    counts = reduce(DataFrame.unionByName, parts).distinct().groupBy("number").agg(F.count("*").alias("values"))
    listed = counts.sparkSession.createDataFrame(names, "number smallint, table_name string, column_name string")
    return listed.join(counts, "number").drop("number")


def profile_table(
    df: DataFrame, name: str, run_id: str, ts: dt.datetime, approx: bool = False
) -> DataFrame:
    return profile_tables({name: df}, run_id, ts, approx)


def run_summary(
    layers: dict[str, dict[str, DataFrame | None]], run_id: str, ts: dt.datetime
) -> DataFrame:
    """Row count per table; -1 for a table that is missing (``None``).

    The counts are one union, so they run as one job.
    """
    spark = next(df for t in layers.values() for df in t.values() if df is not None).sparkSession
    parts = []
    for layer, tables in layers.items():
        for name, df in tables.items():
            if df is None:
                counted = spark.range(1).select(F.lit(-1).cast("bigint").alias("row_count"))
            else:
                counted = df.agg(F.count("*").alias("row_count"))
            parts.append(counted.select(
                F.lit(layer.upper()).alias("layer"), F.lit(name.upper()).alias("table_name"),
                "row_count",
            ))
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part)
    return stacked.select(
        F.lit(run_id).alias("run_id"), "layer", "table_name", "row_count",
        moment(ts).alias("run_timestamp"),
    )
