"""Stored tables: parquet folders behind an append-only log of versions.

Every write goes to a folder of its own, and then one row into the table's log says that the folder
counts.  Readers follow the log, so a table changes at one moment: a write that fails
half way leaves a folder that nothing refers to, and a reader that has begun goes on
with the folders it found.  Nothing is renamed and nothing is overwritten.

The log row also holds what was written (rows, counted by the write itself, files and bytes), so
reports on the stored tables open no data file.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestrata.functions.columns import moment

REPLACE, APPEND, RETIRE = "replace", "append", "retire"
# Of the data files; about a quarter smaller than Spark's default.
COMPRESSION = "zstd"
LOG_DDL = (
    "layer string, name string, version long, kind string, folder string, run_id string, row_count long, "
    "bytes long, files long, written_at timestamp_ntz, columns string"
)


class Version(NamedTuple):
    """One write of a table."""

    layer: str
    name: str
    version: int
    kind: str
    folder: str
    run_id: str | None
    row_count: int
    bytes: int
    files: int
    written_at: dt.datetime
    columns: str


def standing(log: list[Version]) -> list[Version]:
    """The writes that make up a table: the last replacement and what was appended since, once per run."""
    ordered = sorted(log, key=lambda x: (x.version, x.folder))
    since = max((i for i, x in enumerate(ordered) if x.kind == REPLACE), default=0)
    last = {x.run_id or x.folder: x for x in ordered[since:] if x.kind != RETIRE}
    return sorted(last.values(), key=lambda x: (x.version, x.folder))


class Lake:
    """Access of the tables below one root folder, one writer per table at a time."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"

    def log_path(self, layer: str, name: str) -> str:
        return f"{self.path(layer, name)}/versions"

    # ---------------------------------------------------------------- the log

    def history(self, layer: str, name: str) -> list[Version]:
        """All writes of a table: one short row each, whatever the table's size."""
        try:
            rows = self.spark.read.schema(LOG_DDL).parquet(self.log_path(layer, name)).collect()
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return []
            raise
        return sorted((Version(*x) for x in rows), key=lambda x: (x.version, x.folder))

    def _note(self, entry: Version) -> None:
        """Append a row to the log: one file, which is there as a whole or not at all."""
        kinds = dict(item.rsplit(" ", 1) for item in LOG_DDL.split(", "))
        values = {**entry._asdict(), "written_at": entry.written_at.isoformat(sep=" ")}
        row = self.spark.range(0, 1, 1, 1).select(*[F.lit(values[c]).cast(kind).alias(c) for c, kind in kinds.items()])
        row.write.mode("append").parquet(self.log_path(entry.layer, entry.name))

    def _files(self, folder: str) -> tuple[int, int]:
        """Number and bytes of the files below a folder, from its listing alone."""
        listed = self.spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option(
            "recursiveFileLookup", "true").load(f"{self.root}/{folder}")
        found = listed.agg(F.count("path").alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")).first()
        return found["files"], found["bytes"]

    def _next(self, layer: str, name: str) -> tuple[int, str]:
        version = max((x.version for x in self.history(layer, name)), default=0) + 1
        return version, f"{layer}/{name}/data/v{version:06d}-{uuid.uuid4().hex[:8]}"

    def _write(
        self, df: DataFrame, layer: str, name: str, kind: str, run_id: str | None = None,
        partition_by: list[str] | None = None,
    ) -> Version:
        version, folder = self._next(layer, name)
        counted = Observation()
        writer = df.observe(counted, F.count(F.lit(1)).alias("row_count")).write.option("compression", COMPRESSION)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(f"{self.root}/{folder}")
        files, size = self._files(folder)
        entry = Version(
            layer, name, version, kind, folder, run_id, counted.get["row_count"], size, files,
            dt.datetime.now(), df.schema.json(),
        )
        self._note(entry)
        return entry

    def read_versions(self, versions: list[Version]) -> DataFrame:
        """The rows of some writes of one table, with the columns of the last."""
        schema = T.StructType.fromJson(json.loads(versions[-1].columns))
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{x.folder}" for x in versions])

    # ------------------------------------------------------------------ tables

    def read(self, layer: str, name: str, version: int | None = None) -> DataFrame:
        """The table as it now is, or as it was after a given version."""
        log = self.history(layer, name)
        kept = standing([x for x in log if version is None or x.version <= version])
        # A folder of plain parquet files is a table without a history.
        return self.read_versions(kept) if kept else self.spark.read.parquet(self.path(layer, name))

    def find(self, layer: str, name: str) -> DataFrame | None:
        """The table, or ``None`` where there is none."""
        try:
            return self.read(layer, name)
        except AnalysisException as error:
            if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return None
            raise

    def publish(
        self, df: DataFrame, layer: str, name: str, loaded_at: dt.datetime | None = None,
        partition_by: list[str] | None = None,
    ) -> DataFrame:
        """Replace a table and return it as stored.

        ``loaded_at`` adds the load time column.  ``partition_by`` suits facts
        that are read by month.  ``df`` may read the table itself.
        """
        if loaded_at is not None:
            df = df.withColumn("_loaded_at", moment(loaded_at))
        return self.read_versions([self._write(df, layer, name, REPLACE, partition_by=partition_by)])

    def replace_if_any(
        self, df: DataFrame, layer: str, name: str, given: DataFrame | None = None
    ) -> DataFrame | None:
        """Replace a table unless there is nothing to put in.

        ``given`` are rows that ``df`` has a row for each of; asking them saves a
        run of a plan that is costly.
        """
        if (df if given is None else given).isEmpty():
            return self.find(layer, name)
        return self.publish(df, layer, name)

    def append_log(self, df: DataFrame, layer: str, name: str, run_id: str | None = None) -> DataFrame:
        """Add rows to a log table and return the whole log.

        Rows of a ``run_id`` take the place of those that the same run has added before, so a run
        that is repeated, after a failure or by mistake, leaves one set of rows.
        """
        self._write(df, layer, name, APPEND, run_id)
        return self.read(layer, name)

    def land(
        self, df: DataFrame, rejected: Column, layer: str, name: str, rejects: str, run_id: str,
        columns: list[str], reject_columns: list[str],
    ) -> tuple[int, int]:
        """Append rows to a table, and those that are ``rejected`` to the same table of layer ``rejects``.

        One job over ``df`` writes both, so its source is read once; each table has its own columns of
        it.  Returns how many rows went to each.
        """
        version, folder = self._next(layer, name)
        counted = Observation()
        df.withColumn("taken", F.when(rejected, "rejects").otherwise("rows")).observe(
            counted, F.count_if(~rejected).alias("rows"), F.count_if(rejected).alias("rejects")
        ).write.option("compression", COMPRESSION).partitionBy("taken").parquet(f"{self.root}/{folder}")
        numbers = counted.get
        for kind, at, kept in (("rows", layer, columns), ("rejects", rejects, reject_columns)):
            if numbers[kind]:
                files, size = self._files(f"{folder}/taken={kind}")
                self._note(Version(
                    at, name, version if at == layer else self._next(at, name)[0], APPEND, f"{folder}/taken={kind}",
                    run_id, numbers[kind], size, files, dt.datetime.now(), df.select(*kept).schema.json(),
                ))
        return numbers["rows"], numbers["rejects"]

    def retire(self, layer: str, name: str, keep: int = 1) -> int:
        """Empty the folders that none of the last ``keep`` versions of a table needs; how many.

        Spark's public interface deletes no folder, so each is overwritten by an empty table.  Readers of older
        versions must be through.
        """
        log = self.history(layer, name)
        numbers = sorted({x.version for x in log if x.kind != RETIRE})
        needed = {
            x.folder for number in numbers[-keep:] for x in standing([x for x in log if x.version <= number])
        }
        emptied = {x.folder for x in log if x.kind == RETIRE}
        count = 0
        for x in log:
            if x.kind != RETIRE and x.folder not in needed | emptied:
                self.spark.createDataFrame([], "retired boolean").write.mode("overwrite").parquet(f"{self.root}/{x.folder}")
                self._note(x._replace(kind=RETIRE, row_count=0, bytes=0, files=0, written_at=dt.datetime.now()))
                count += 1
        return count

    def publish_bucketed(
        self, df: DataFrame, table: str, key: str, buckets: int
    ) -> DataFrame:
        """Store a catalog table bucketed by ``key``.

        Tables with the same key and number of buckets then group and join on
        it without a shuffle.
        """
        (
            df.write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key)
            .option("path", f"{self.root}/bucketed/{table}").saveAsTable(table)
        )
        return self.spark.table(table)

    # --------------------------------------------------------------- inventory

    def logged(self) -> DataFrame:
        """The log rows of all tables that count now, read in one job.

        The same choice as ``standing``, for all tables at once.
        """
        log = self.spark.read.schema(LOG_DDL).parquet(f"{self.root}/*/*/versions").filter(F.col("kind") != RETIRE)
        table = ["layer", "name"]
        since = F.max(F.when(F.col("kind") == REPLACE, F.col("version"))).over(Window.partitionBy(*table))
        run = F.coalesce("run_id", "folder")
        newest = Window.partitionBy(*table, run).orderBy(F.col("version").desc(), F.col("folder").desc())
        return (
            log.withColumn("since", since).filter(F.col("since").isNull() | (F.col("version") >= F.col("since")))
            .withColumn("place", F.row_number().over(newest)).filter("place = 1").drop("since", "place")
        )

    def inventory(self, layers: dict[str, list[str]]) -> DataFrame:
        """Rows, bytes and last change of every table found, as the logs tell it.

        No data file is opened, but for those of tables without a history.
        """
        try:
            noted = self.logged()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            noted = self.spark.createDataFrame([], LOG_DDL)
        wanted = {(layer, name) for layer, names in layers.items() for name in names}
        known = {tuple(x) for x in noted.select("layer", "name").distinct().collect()}
        sums = noted.groupBy("layer", "name").agg(
            F.sum("row_count").alias("row_count"), F.sum("bytes").alias("bytes"),
            F.max("written_at").alias("last_altered"),
        )
        kept = [F.col("layer").eqNullSafe(layer) & F.col("name").isin(names) for layer, names in layers.items()]
        some = kept[0]
        for one in kept[1:]:
            some = some | one
        found = sums.filter(some).select(
            F.upper("layer").alias("table_schema"), F.upper("name").alias("table_name"), "row_count", "bytes", "last_altered"
        )
        for layer, name in sorted(wanted - known):
            df = self.find(layer, name)
            if df is not None:
                found = found.unionByName(self._measured(df, layer, name))
        if not known and found.isEmpty():
            raise ValueError(f"no tables below {self.root}")
        return found.orderBy("table_schema", "table_name")

    @staticmethod
    def _measured(df: DataFrame, layer: str, name: str) -> DataFrame:
        """Of a table without a history, from row counts and file metadata."""
        files = df.groupBy(F.col("_metadata.file_path").alias("file_path")).agg(
            F.count("*").alias("rows"),
            F.max("_metadata.file_size").alias("size"),
            F.max("_metadata.file_modification_time").alias("changed"),
        )
        return files.agg(
            F.coalesce(F.sum("rows"), F.lit(0)).alias("row_count"), F.sum("size").alias("bytes"),
            F.max("changed").cast("timestamp_ntz").alias("last_altered"),
        ).select(
            F.lit(layer.upper()).alias("table_schema"), F.lit(name.upper()).alias("table_name"),
            "row_count", "bytes", "last_altered",
        )
