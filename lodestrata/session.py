"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import threading
import uuid
import weakref
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# What the operators rely on.  Hot join keys: adaptive execution splits an
# oversized shuffle partition among several tasks, from the measured sizes, even
# where the aggregate behind the join then needs a shuffle of its own.  Overflow
# of a number is an error and not a NULL.
RELIED_ON = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.ansi.enabled": "true",
}

SETTINGS = {
    **RELIED_ON,
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def build_session(app: str, master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Give a session from elsewhere the settings the operators rely on.

    They stay set: frames are lazy, so they must hold when a result is computed.
    """
    for key, value in RELIED_ON.items():
        spark.conf.set(key, value)
    return spark


# Deletes the shuffle files of a query when it has ended.
FREES_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_freeing: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()
_entering = threading.Lock()


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Queries that are planned inside leave no shuffle files behind.

    Otherwise these stay until the JVM happens to collect the plan, so a run of many writes keeps most of
    them to its end.  A frame that is planned inside and executed twice shuffles twice, so frames that
    are handed out should be made outside.  May be entered again, and by several threads.
    """
    with _entering:
        depth, before = _freeing.get(spark, (0, spark.conf.get(FREES_SHUFFLES, None)))
        _freeing[spark] = depth + 1, before
        spark.conf.set(FREES_SHUFFLES, "true")
    try:
        yield
    finally:
        with _entering:
            depth, before = _freeing[spark]
            _freeing[spark] = depth - 1, before
            if depth == 1:
                del _freeing[spark]
                spark.conf.unset(FREES_SHUFFLES) if before is None else spark.conf.set(FREES_SHUFFLES, before)


# Bytes one task should read from a table, and receive from a shuffle at most.
SCAN_BYTES = 512 * 1024 * 1024
SHUFFLE_BYTES = 1024 * 1024 * 1024
FEWEST, MOST_PARTITIONS = 200, 100_000


def sized_for(input_bytes: int) -> dict[str, str]:
    """Settings for a given input size, in bytes of the columns that are read.

    Shuffles start with a partition for each GB, 100,000 at most, as blocks grow with
    the product of map and reduce tasks; adaptive execution merges the ones that
    turn out small and splits those of joins that turn out large.
    """
    partitions = min(MOST_PARTITIONS, max(FEWEST, -(-input_bytes // SHUFFLE_BYTES)))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(SHUFFLE_BYTES // 4),
        "spark.sql.files.maxPartitionBytes": str(SCAN_BYTES),
    }


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it.

    Only a local session that names none gets a temporary folder.
    """
    conf = spark.sparkContext.getConf()
    named = conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return tempfile.mkdtemp(prefix="lodestrata-")


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, not yet existing folder below the shared one."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"
