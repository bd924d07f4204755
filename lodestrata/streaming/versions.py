"""Change feed of rows that are changed and removed, from a stream of row versions.

A source sends versions of rows: the row as it now is, or that it is gone.  Versions may repeat what is
known and may come late.  A state holds the last version of each row, by shares of the keys, so the feed
says what each batch changed: INSERT, UPDATE or DELETE, and nothing for a row that
stayed the same or came and went within the batch.  State and progress are kept in
the checkpoint; a restart goes on where the last run stopped.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from lodestrata.schemas import BRONZE

VERSION, GONE = "_version", "_deleted"
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# Rows travel as text: every field, times to the microsecond.
AS_TEXT = {"ignoreNullFields": "false", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
CHANGE_DDL = "action string, version long, row string"
# Shares of the keys.  A share's rows are in one task's memory: some MB for 50 million rows of 150 bytes.
SHARES = 4096


def _pack(known: dict) -> bytes:
    """Keys with their last version as Arrow columns, compressed."""
    numbers, rows = zip(*known.values())
    table = pa.table({"key": list(known), "version": pa.array(numbers, pa.int64()), "row": pa.array(rows, pa.string())})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpack(state: bytes) -> dict:
    keys, numbers, rows = (column.to_pylist() for column in pa.ipc.open_stream(state).read_all().columns)
    return dict(zip(keys, zip(numbers, rows)))


class LastVersions(StatefulProcessor):
    """Holds the last version of each row of a share of the keys, and says what a batch made of them.

    The state of a share is read and written as a whole, once for each batch: asking the state store for
    every key costs far more than what is done with the answer.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "rows binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        state = self.last.get()
        known = {} if state is None else _unpack(bytes(state[0]))
        newest: dict = {}
        for part in rows:
            # Of versions with one number the greatest text counts, so the order of rows doesn't.
            for name, number, row in zip(part["key"].tolist(), part["number"].tolist(), part["row"].tolist()):
                row = row if isinstance(row, str) else None
                last = newest.get(name) or known.get(name)
                if last is None or (number, row or "") > (last[0], last[1] or ""):
                    newest[name] = number, row
        if not newest:
            return
        # What is gone is remembered, too: a late version must not bring it back.
        self.last.update((_pack({**known, **newest}),))
        found = []
        for name, (number, after) in newest.items():
            before = known[name][1] if name in known else None
            if after != before:
                action = "INSERT" if before is None else "DELETE" if after is None else "UPDATE"
                found.append((action, number, before if after is None else after))
        if found:
            yield pd.DataFrame(found, columns=["action", "version", "row"])


def row_versions(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """The row versions of one feed as an unbounded table: its columns, ``_version`` and ``_deleted``."""
    schema = T.StructType([*BRONZE[table].fields, T.StructField(VERSION, T.LongType()),
                           T.StructField(GONE, T.BooleanType())])
    return spark.readStream.schema(schema).parquet(folder)


def land_versions(df: DataFrame, folder: str, version: int, before: DataFrame | None = None, key: str | None = None) -> None:
    """Write a table as versions of its rows; rows of ``before`` whose ``key`` it lacks are marked as gone."""
    rows = df.withColumns({VERSION: F.lit(version).cast("long"), GONE: F.lit(False)})
    if before is not None:
        lost = before.join(df, key, "left_anti").select(*df.columns)
        rows = rows.unionByName(lost.withColumns({VERSION: F.lit(version).cast("long"), GONE: F.lit(True)}))
    rows.write.mode("append").parquet(folder)


def net_changes(versions: DataFrame, key: str, shares: int = SHARES) -> DataFrame:
    """``action``, ``_version`` and the row's columns for each row that a batch has changed.

    ``versions`` is a stream with the row's columns, ``_version`` (greater is later) and ``_deleted``.  A deleted
    row carries its last values.  Rows without a key take no part.  Keys are dealt by hash to ``shares``, each
    with a state of its own, so a task holds one share at a time.  A feed must keep the number it began with.
    """
    spark = versions.sparkSession
    spark.conf.set(STATE_STORE, ROCKS_DB)
    fields = [f for f in versions.schema.fields if f.name not in (VERSION, GONE)]
    row = F.to_json(F.struct(*[F.col(f.name) for f in fields]), AS_TEXT)
    changes = versions.filter(F.col(key).isNotNull()).select(
        F.pmod(F.xxhash64(key), F.lit(shares)).alias("share"), F.col(key).alias("key"),
        F.col(VERSION).alias("number"), F.when(~F.coalesce(F.col(GONE), F.lit(False)), row).alias("row")
    ).groupBy("share").transformWithStateInPandas(
        LastVersions(), outputStructType=CHANGE_DDL, outputMode="Update", timeMode="None"
    )
    return changes.select(
        "action", F.col("version").alias(VERSION), F.from_json("row", T.StructType(fields), AS_TEXT).alias("r")
    ).select("action", VERSION, "r.*")
