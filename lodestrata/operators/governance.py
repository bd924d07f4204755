"""Governance reports over tags, inventory and logs.

Tags are a small literal table.  The reports join them to an inventory that is
measured on the tables, so a tag on a table that does not exist does not count
and every report says how many rows stand behind a tag value.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.functions.columns import count_where, first_rows
from lodestrata.plans import tags as T

Layers = Mapping[str, Mapping[str, DataFrame]]

DATABASE = "RETAIL"


def tag_definitions(spark: SparkSession) -> DataFrame:
    rows = [(tag, value) for tag, values in T.DEFINITIONS.items() for value in values]
    return spark.createDataFrame(rows, "tag_name string, allowed_value string")


def tag_assignments(spark: SparkSession, database: str = DATABASE) -> DataFrame:
    """Four tags per table and one per column with personal data."""
    rows = []
    for layer, table, classification, domain in T.TABLES:
        values = [layer, classification, domain, T.QUALITY_BY_LAYER[layer]]
        for tag, value in zip(T.TABLE_TAGS, values):
            rows.append((tag, value, database, layer, table, "TABLE", None))
    for layer, table, columns in T.PERSONAL_COLUMNS:
        rows += [("PII", "TRUE", database, layer, table, "COLUMN", c) for c in columns]
    return spark.createDataFrame(
        rows,
        "tag_name string, tag_value string, object_database string, object_schema string, "
        "object_name string, domain string, column_name string",
    )


def tag_validate(assignments: DataFrame, definitions: DataFrame) -> DataFrame:
    """Assignments whose value the tag does not allow."""
    return assignments.join(
        definitions,
        (assignments["tag_name"] == definitions["tag_name"])
        & (assignments["tag_value"] == definitions["allowed_value"]),
        "left_anti",
    )


def measured_inventory(layers: Layers) -> DataFrame:
    """Schema, table and row count of each given table, counted in one job."""
    parts = [
        df.agg(F.count("*").alias("row_count")).select(
            F.lit(layer.upper()).alias("table_schema"), F.lit(name.upper()).alias("table_name"),
            "row_count",
        )
        for layer, tables in layers.items()
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def tag_references(
    assignments: DataFrame, inventory: DataFrame, database: str = DATABASE
) -> DataFrame:
    """Tags of existing tables in one database, with the rows they cover."""
    sizes = inventory.select(
        F.col("table_schema").alias("object_schema"), F.col("table_name").alias("object_name"),
        "row_count",
    )
    return (
        assignments.filter(F.col("object_database") == database)
        .join(sizes, ["object_schema", "object_name"])
        .orderBy("object_schema", "object_name", "tag_name", "column_name")
    )


def placed_assignments(assignments: DataFrame, inventory: DataFrame) -> DataFrame:
    """Every assignment with the rows of its table; NULL where the table is missing."""
    sizes = inventory.select(
        F.col("table_schema").alias("object_schema"), F.col("table_name").alias("object_name"),
        "row_count",
    )
    return assignments.join(sizes, ["object_schema", "object_name"], "left")


def definition_use(definitions: DataFrame, references: DataFrame) -> DataFrame:
    """Every allowed value with the number of its uses and the rows they cover."""
    used = references.groupBy("tag_name", F.col("tag_value").alias("allowed_value")).agg(
        F.count("*").alias("uses"), F.sum("row_count").alias("rows_covered")
    )
    return definitions.join(used, ["tag_name", "allowed_value"], "left").select(
        "tag_name", "allowed_value", F.coalesce("uses", F.lit(0)).alias("uses"),
        F.coalesce("rows_covered", F.lit(0)).alias("rows_covered"),
    )


def _table_tags(references: DataFrame, tag: str) -> DataFrame:
    return references.filter((F.col("domain") == "TABLE") & (F.col("tag_name") == tag))


def _per(references: DataFrame, *keys) -> DataFrame:
    return references.groupBy(*keys).agg(
        F.count("*").alias("tables"), F.sum("row_count").alias("rows_covered")
    )


def tag_coverage(references: DataFrame, inventory: DataFrame) -> DataFrame:
    """Every table with every tag type: the value or MISSING, and 1 or 0."""
    wanted = inventory.select(
        "table_schema", "table_name",
        F.explode(F.array(*[F.lit(tag) for tag in T.TABLE_TAGS])).alias("tag_name"),
    )
    given = references.filter(F.col("domain") == "TABLE").select(
        F.col("object_schema").alias("table_schema"), F.col("object_name").alias("table_name"),
        "tag_name", "tag_value",
    )
    return wanted.join(given, ["table_schema", "table_name", "tag_name"], "left").select(
        F.concat("table_schema", F.lit("."), "table_name").alias("full_name"),
        "tag_name",
        F.coalesce("tag_value", F.lit("MISSING")).alias("value"),
        F.col("tag_value").isNotNull().cast("int").alias("present"),
    )


def tag_distribution(references: DataFrame) -> DataFrame:
    """Assignments per tag."""
    return references.groupBy("tag_name").agg(
        F.count("*").alias("assignments"), F.sum("row_count").alias("rows_covered")
    )


def classification_distribution(references: DataFrame) -> DataFrame:
    return _per(_table_tags(references, "DATA_CLASSIFICATION"),
                F.col("tag_value").alias("classification"))


def quality_tier_by_layer(references: DataFrame) -> DataFrame:
    return _per(_table_tags(references, "QUALITY_TIER"), F.col("object_schema").alias("layer"),
                F.col("tag_value").alias("quality_tier"))


def tables_by_layer(references: DataFrame) -> DataFrame:
    return _per(_table_tags(references, "PIPELINE_LAYER"), F.col("tag_value").alias("layer"))


def domain_coverage(references: DataFrame) -> DataFrame:
    return _per(_table_tags(references, "DATA_DOMAIN"), F.col("object_schema").alias("layer"),
                F.col("tag_value").alias("data_domain"))


def governance_kpis(
    references: DataFrame, inventory: DataFrame, attachments: DataFrame, anomalies: DataFrame
) -> DataFrame:
    """The headline numbers in one row, each a scalar subquery."""
    personal = (F.col("tag_name") == "PII") & (F.col("tag_value") == "TRUE")

    def number(df, value):
        return df.agg(value.alias("n")).scalar()

    return references.agg(
        F.count_distinct(F.when(F.col("domain") == "TABLE", F.col("object_name"))).alias(
            "tagged_tables"
        ),
        count_where(personal & (F.col("domain") == "COLUMN")).alias("pii_columns"),
    ).select(
        "tagged_tables",
        number(inventory, F.count("*")).alias("total_tables"),
        "pii_columns",
        number(attachments, F.count("*")).alias("active_metrics"),
        number(attachments, count_where(F.col("schedule_status") == "STARTED")).alias(
            "running_metrics"
        ),
        number(anomalies, F.count("*")).alias("anomalies_detected"),
    )


def pii_inventory(assignments: DataFrame, layers: Layers) -> DataFrame:
    """Columns tagged as personal data, and how many values each one holds.

    All tagged columns of a table are counted in one scan.
    """
    counts = []
    for layer, table, columns in T.PERSONAL_COLUMNS:
        df = layers[layer.lower()][table.lower()]
        cells = [
            F.struct(F.lit(c).alias("column_name"), F.count(c.lower()).alias("values_held"))
            for c in columns
        ]
        counts.append(
            df.agg(F.array(*cells).alias("cells")).select(
                F.lit(layer).alias("object_schema"), F.lit(table).alias("object_name"),
                F.inline("cells"),
            )
        )
    measured = reduce(DataFrame.unionByName, counts)
    tagged = assignments.filter(
        (F.col("domain") == "COLUMN") & (F.col("tag_name") == "PII")
        & (F.col("tag_value") == "TRUE")
    ).select("object_schema", "object_name", "column_name")
    return (
        tagged.join(measured, ["object_schema", "object_name", "column_name"])
        .select(
            F.col("object_schema").alias("schema_name"), F.col("object_name").alias("table_name"),
            "column_name", "values_held",
        )
        .orderBy("schema_name", "table_name", "column_name")
    )


def pii_by_layer(inventory: DataFrame) -> DataFrame:
    """Columns with personal data per layer."""
    return inventory.groupBy("schema_name").agg(F.count("*").alias("pii_columns"))


def pii_propagation(inventory: DataFrame) -> DataFrame:
    """Per column, the layers in which it is tagged."""
    def mark(layer):
        seen = F.bool_or(F.col("schema_name") == layer)
        return F.when(seen, "Tagged").otherwise("-").alias(layer.lower())

    return (
        inventory.groupBy(F.col("column_name").alias("pii_column"))
        .agg(*[mark(layer) for layer in ("BRONZE", "SILVER", "GOLD")])
        .orderBy("pii_column")
    )


def row_count_consistency(inventory: DataFrame) -> DataFrame:
    """Rows of each entity per layer; Match is Yes when all are equal."""
    rows = [
        (entity, layer, table)
        for entity, tables in T.ENTITIES.items()
        for layer, table in tables.items()
    ]
    mapping = inventory.sparkSession.createDataFrame(
        rows, "entity string, table_schema string, table_name string"
    )
    placed = mapping.join(inventory, ["table_schema", "table_name"], "left")

    def size(layer):
        found = F.max(F.when(F.col("table_schema") == layer, F.col("row_count")))
        return F.coalesce(found, F.lit(0)).alias(layer.lower())

    sizes = placed.groupBy("entity").agg(*[size(x) for x in ("BRONZE", "SILVER", "GOLD")])
    equal = (F.col("bronze") == F.col("silver")) & (F.col("silver") == F.col("gold"))
    return sizes.select("*", F.when(equal, "Yes").otherwise("No").alias("match"))


def inventory_report(inventory: DataFrame) -> DataFrame:
    """Table sizes for display: missing counts are 0, bytes become MB."""
    return inventory.select(
        "table_schema",
        "table_name",
        F.coalesce("row_count", F.lit(0)).alias("row_count"),
        F.round(F.coalesce("bytes", F.lit(0)) / F.lit(1024.0 * 1024.0), 2).alias("size_mb"),
        "last_altered",
    ).orderBy("table_schema", "table_name")


def profile_log_read(profile_log: DataFrame) -> DataFrame:
    """The profile log, newest first."""
    return profile_log.select(
        "table_name", "column_name", "metric", "metric_value", "profiled_at"
    ).orderBy(F.desc("profiled_at"), "table_name", "column_name", "metric")


def anomalies_by_type(flags: DataFrame) -> DataFrame:
    return flags.groupBy("anomaly_type").agg(F.count("*").alias("anomalies"))


def anomaly_kpis(flags: DataFrame) -> DataFrame:
    """Total flags and the two types shown by name."""
    kind = F.col("anomaly_type")
    return flags.agg(
        F.count("*").alias("total_anomalies"),
        count_where(kind == "DORMANT_CUSTOMER").alias("dormant_customers"),
        count_where(kind == "AMOUNT_OUTLIER").alias("amount_outliers"),
    )


def anomaly_timeline(flags: DataFrame) -> DataFrame:
    return flags.groupBy(
        F.to_date("detected_at").alias("detected_date"), "anomaly_type"
    ).agg(F.count("*").alias("anomalies"))


def anomaly_details(
    flags: DataFrame, types: list[str] | None = None, k: int | None = None
) -> DataFrame:
    """Flags of the given types, newest first; the first ``k`` if given."""
    if types is not None:
        flags = flags.filter(F.col("anomaly_type").isin(types))
    return first_rows(
        flags.select("record_id", "anomaly_type", "details", "detected_at")
        .orderBy(F.desc("detected_at"), "anomaly_type", "record_id"), k
    )


def null_highlights(profile_log: DataFrame, k: int | None = None) -> DataFrame:
    """Columns by NULL share, highest first; the first ``k`` if given."""
    share = F.col("metric_value").try_cast("double")
    return first_rows(
        profile_log.filter(F.col("metric") == "NULL_PCT")
        .select("table_name", "column_name", F.round(share, 2).alias("null_pct"))
        .filter(F.col("null_pct") > 0)
        .orderBy(F.desc("null_pct"), "table_name", "column_name"), k
    )
