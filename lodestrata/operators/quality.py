"""Data-quality metrics, their reports, and declared column tests."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestrata.functions.columns import count_where, moment
from lodestrata.operators.gates import duplicate_keys, orphan_rows
from lodestrata.plans import attachments as A
from lodestrata.plans.contracts import CONTRACTS
from lodestrata.plans.contracts import Column as Contract

Layers = Mapping[str, Mapping[str, DataFrame]]


def _stacked(parts: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


class KeyCheck(NamedTuple):
    """Values of a column that repeat or, with ``parent`` (table, column), rows without a parent."""

    table: str
    column: str
    parent: tuple[str, str] | None = None
    count_null: bool = False


def key_checks(tables: Mapping[str, DataFrame], checks: list[KeyCheck]) -> DataFrame:
    """Failures of many key checks, as ``no, failures``; each table is read once.

    A table gives each of its keys once per check it takes part in, with a small
    number for the key column that is checked (the own or the parent's), and one
    aggregate counts the uses of every key value.  Keys are combined before the
    shuffle, so a value with many rows moves as one row per task.  NULL keys
    fail no check, but with ``count_null`` they repeat like any other value.
    """
    owners = list(dict.fromkeys(c.parent or (c.table, c.column) for c in checks))
    children = [[i for i, c in enumerate(checks) if c.parent == owner] for owner in owners]
    slots = max([len(x) for x in children] + [0])
    uses: dict[str, list[Column]] = {}

    def use(table: str, column: str, owner: int, slot: int, count_null: bool) -> None:
        key, kind = F.col(column), tables[table].schema[column].dataType
        whole = isinstance(kind, T.IntegralType)
        cell = F.struct(
            F.lit(owner).alias("owner"), F.lit(slot).alias("slot"),
            (key if whole else F.lit(None)).cast("bigint").alias("whole"),
            (F.lit(None) if whole else key).cast("string").alias("text"),
        )
        cells = uses.setdefault(table, [])
        cells.append(cell if count_null else F.when(key.isNotNull(), cell))

    for owner, (table, column) in enumerate(owners):
        count_null = any(c.count_null and (c.table, c.column) == (table, column) for c in checks)
        use(table, column, owner, 0, count_null)
        for slot, i in enumerate(children[owner], 1):
            use(checks[i].table, checks[i].column, owner, slot, False)
    parts = [
        tables[table].select(F.explode(F.array(*cells)).alias("use")).filter("use is not null").select("use.*")
        for table, cells in uses.items()
    ]
    counts = [count_where(F.col("slot") == slot).alias(f"n{slot}") for slot in range(slots + 1)]
    keys = _stacked(parts).groupBy("owner", "whole", "text").agg(*counts)
    known = F.coalesce(F.col("whole").cast("string"), F.col("text")).isNotNull()
    failures = keys.groupBy("owner").agg(
        count_where(F.col("n0") > 1).alias("f0"),
        *[F.sum(F.when((F.col("n0") == 0) & known, F.col(f"n{slot}")).otherwise(0)).alias(f"f{slot}")
          for slot in range(1, slots + 1)],
    ).select("owner", F.posexplode(F.array(*[F.col(f"f{slot}") for slot in range(slots + 1)])).alias(
        "slot", "failures"))
    numbers = [
        (i, owners.index(c.parent or (c.table, c.column)),
         children[owners.index(c.parent)].index(i) + 1 if c.parent else 0)
        for i, c in enumerate(checks)
    ]
    listed = next(iter(tables.values())).sparkSession.createDataFrame(numbers, "no int, owner int, slot int")
    return listed.join(failures, ["owner", "slot"], "left").select(
        "no", F.coalesce("failures", F.lit(0)).cast("bigint").alias("failures")
    )


def _named(found: DataFrame, names: list[tuple], columns: str) -> DataFrame:
    """The failures of numbered checks with what each is of."""
    listed = found.sparkSession.createDataFrame([(i, *x) for i, x in enumerate(names)], f"no int, {columns}")
    return listed.join(found, "no").drop("no")


def _simple_metric(name: str, argument: str, changed: str | None, as_of: dt.datetime) -> Column:
    """Metrics that are one aggregate over the table."""
    if name == A.NULL:
        return count_where(F.col(argument).isNull())
    if name == A.ROWS:
        return F.count("*")
    if name == A.NEGATIVE:
        return count_where(F.col(argument) < 0)
    if name == A.FRESHNESS:
        return F.timestamp_diff("SECOND", F.max(changed), moment(as_of))
    raise ValueError(f"unknown metric {name}")


def _result(df: DataFrame, layer: str, table: str, as_of: dt.datetime) -> DataFrame:
    return df.select(
        F.lit(layer.upper()).alias("table_schema"),
        F.lit(table.upper()).alias("table_name"),
        "metric_name",
        "argument_names",
        F.col("value").cast("bigint").alias("value"),
        moment(as_of).alias("measurement_time"),
    )


def dq_metric(
    df: DataFrame, layer: str, table: str, metric: str, argument: str, as_of: dt.datetime,
    changed: str | None = None, parent: DataFrame | None = None,
) -> DataFrame:
    """One metric of one table, as one row.

    ``changed`` names the change-time column (freshness); ``parent`` is the
    referenced table (foreign key).
    """
    if metric == A.DUPLICATE:
        row = duplicate_keys(df, argument).select(F.col("n").alias("value"))
    elif metric == A.CUSTOMER_FK:
        key = argument.split(",")[0]
        row = orphan_rows(df, key, parent, skip_null=True).select(F.col("n").alias("value"))
    else:
        row = df.agg(_simple_metric(metric, argument, changed, as_of).alias("value"))
    row = row.select(
        F.lit(metric).alias("metric_name"), F.lit(argument.upper()).alias("argument_names"),
        "value",
    )
    return _result(row, layer, table, as_of)


def dq_suite(
    layers: Layers, as_of: dt.datetime,
    attachments: list[tuple[str, str, str, str]] | None = None,
) -> DataFrame:
    """Every attached metric.

    The plain metrics of a table share one aggregate, hence one scan, and the
    key metrics of all tables share another; pass stored layers.
    """
    chosen = A.ATTACHMENTS if attachments is None else attachments
    plain: dict[tuple[str, str], list[Column]] = {}
    tables, checks, names = {}, [], []
    for layer, table, metric, argument in chosen:
        if metric in (A.DUPLICATE, A.CUSTOMER_FK):
            name, key = f"{layer}.{table}", argument.split(",")[0]
            tables[name] = layers[layer][table]
            if metric == A.DUPLICATE:
                checks.append(KeyCheck(name, key, count_null=True))
            else:
                tables["bronze.customers"] = layers["bronze"]["customers"]
                checks.append(KeyCheck(name, key, ("bronze.customers", "customer_id")))
            names.append((layer.upper(), table.upper(), metric, argument.upper()))
            continue
        value = _simple_metric(metric, argument, A.CHANGE_TIMES.get(table), as_of)
        plain.setdefault((layer, table), []).append(
            F.struct(
                F.lit(metric).alias("metric_name"),
                F.lit(argument.upper()).alias("argument_names"),
                value.cast("bigint").alias("value"),
            )
        )
    parts = [
        _result(layers[layer][table].agg(F.array(*cells).alias("cells")).select(F.inline("cells")),
                layer, table, as_of)
        for (layer, table), cells in plain.items()
    ]
    if checks:
        columns = "table_schema string, table_name string, metric_name string, argument_names string"
        parts.append(_named(key_checks(tables, checks), names, columns).select(
            "table_schema", "table_name", "metric_name", "argument_names",
            F.col("failures").alias("value"), moment(as_of).alias("measurement_time"),
        ))
    return _stacked(parts)


def dq_results_read(results: DataFrame) -> DataFrame:
    """The metric log, newest first."""
    return results.orderBy(
        F.desc("measurement_time"), "table_schema", "table_name", "metric_name", "argument_names"
    )


def dq_latest(results: DataFrame) -> DataFrame:
    """Latest result per schema, table and metric; values that are no number become NULL.

    ``max_by`` keeps one row per group map-side, so a metric with a long
    history is not gathered in one task.
    """
    keys = ["table_schema", "table_name", "metric_name"]
    kept = F.max_by(
        F.struct("argument_names", "value", "measurement_time"),
        F.struct("measurement_time", "argument_names"),
    )
    return (
        results.groupBy(*keys)
        .agg(kept.alias("last"))
        .select(
            *keys,
            "last.argument_names",
            F.col("last.value").cast("string").try_cast("double").alias("value"),
            "last.measurement_time",
        )
    )


def dq_status(latest: DataFrame) -> DataFrame:
    """Latest results with a status text."""
    metric, value = F.col("metric_name"), F.col("value")
    whole = value.cast("bigint").cast("string")
    zero_is_good = F.when(value == 0, "PASS").otherwise(
        F.concat(F.lit("FAIL ("), whole, F.lit(")"))
    )
    status = (
        F.when(metric.isin(A.NULL, A.DUPLICATE, A.NEGATIVE, A.CUSTOMER_FK), zero_is_good)
        .when(metric == A.ROWS, F.when(value > 0, "OK").otherwise("EMPTY"))
        .when(metric == A.FRESHNESS, F.concat(whole, F.lit("s ago")))
        .otherwise(whole)
    )
    return latest.select("*", status.alias("status")).orderBy(
        "table_schema", "table_name", "metric_name"
    )


def dq_scorecard(status: DataFrame, results: DataFrame) -> DataFrame:
    """Checks passing and failing, and the number of results in the log."""
    text = F.col("status")
    return status.agg(
        count_where(text.startswith("PASS") | text.startswith("OK")).alias("checks_passing"),
        count_where(text.contains("FAIL")).alias("checks_failing"),
    ).select(
        "checks_passing", "checks_failing",
        results.agg(F.count("*").alias("n")).scalar().alias("total_results"),
    )


def dq_trend(results: DataFrame, metric: str) -> DataFrame:
    """One metric over time, labelled by schema and table."""
    return results.filter(F.col("metric_name") == metric).select(
        "measurement_time",
        F.concat("table_schema", F.lit("."), "table_name").alias("label"),
        "value",
    )


def dq_inventory(results: DataFrame) -> DataFrame:
    """The attachments of the listed tables with schedule and status.

    An attachment is STARTED once the log holds a measurement of it.
    """
    listed = [a for a in A.ATTACHMENTS if a[1] in A.INVENTORY_TABLES]
    spec = results.sparkSession.createDataFrame(
        [tuple(part.upper() for part in a) for a in listed],
        "table_schema string, table_name string, metric_name string, argument_names string",
    )
    keys = ["table_schema", "table_name", "metric_name", "argument_names"]
    measured = results.groupBy(*keys).agg(F.count("*").alias("measurements"))
    return spec.join(measured, keys, "left").select(
        *keys,
        F.lit(A.SCHEDULE).alias("schedule"),
        F.when(F.col("measurements") > 0, "STARTED").otherwise("SUSPENDED").alias(
            "schedule_status"
        ),
    )


# ------------------------------------------------------------- column tests


def schema_tests(
    tables: Mapping[str, DataFrame], contracts: list[Contract] | None = None
) -> DataFrame:
    """Failures of every declared column test.

    Null and accepted-value tests of a table share one aggregate, and the tests of
    keys of all tables another, so a table is read at most twice; pass stored
    layers.  A NULL is no failure of the other tests.  Failures count rows, for
    ``unique`` the repeated values.
    """
    chosen = CONTRACTS if contracts is None else contracts
    shared: dict[str, list[Column]] = {}
    parts, checks, names = [], [], []

    def cell(column, test, value):
        return F.struct(
            F.lit(column).alias("column_name"), F.lit(test).alias("test"),
            value.cast("bigint").alias("failures"),
        )

    for item in chosen:
        col = F.col(item.column)
        cells = shared.setdefault(item.table, [])
        cells.append(cell(item.column, "not_null", count_where(col.isNull())))
        if item.accepted:
            bad = count_where(~col.isin(*item.accepted))
            cells.append(cell(item.column, "accepted_values", bad))
        if item.unique:
            checks.append(KeyCheck(item.table, item.column))
            names.append((item.table, item.column, "unique"))
        if item.parent:
            checks.append(KeyCheck(item.table, item.column, item.parent))
            names.append((item.table, item.column, "relationships"))
    for table, cells in shared.items():
        rows = tables[table].agg(F.array(*cells).alias("cells")).select(F.inline("cells"))
        parts.append(rows.select(
            F.lit(table).alias("table_name"), "column_name", "test", "failures"
        ))
    if checks:
        parts.append(_named(
            key_checks(tables, checks), names, "table_name string, column_name string, test string"
        ))
    return _stacked(parts).withColumn("passed", F.col("failures") == 0)
