"""Helpers that the operators of this folder share."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
import zipfile

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructField, StructType

from lodestrata.session import fresh_dir

# A batch handed to Python stays small even where texts are very long.
BATCH_SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "512",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
}


_SHIPPED: set[str] = set()


def prepare(spark: SparkSession) -> SparkSession:
    """Bound the batches that Spark hands to Python, and give the workers this library.

    The settings stay on the session.  The library goes to the workers as a zip
    once per application, so they need not have it installed.
    """
    for key, value in BATCH_SETTINGS.items():
        spark.conf.set(key, value)
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        _SHIPPED.add(app)
        root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        packed = os.path.join(tempfile.mkdtemp(), "lodestrata.zip")
        with zipfile.ZipFile(packed, "w") as out:
            for folder, _, names in os.walk(os.path.join(root, "lodestrata")):
                for name in sorted(names):
                    if name.endswith(".py"):
                        path = os.path.join(folder, name)
                        out.write(path, os.path.relpath(path, root))
        spark.sparkContext.addPyFile(packed)
    return spark


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a frame below the shared folder and read it again: computed once, lineage cut."""
    spark, path, schema = df.sparkSession, fresh_dir(df.sparkSession, label), df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def open_store(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI or of an absolute path."""
    return fs.FileSystem.from_uri(uri)


def write_file(uri: str, parts: list[bytes]) -> None:
    """Write a file under another name and rename it; a repeated task leaves the same file.

    Two attempts of one task may run at a time (speculation), so each writes
    under a name of its own.
    """
    store, path = open_store(uri)
    store.create_dir(path.rsplit("/", 1)[0], recursive=True)
    beside = f"{path}.{uuid.uuid4().hex}.tmp"
    with store.open_output_stream(beside) as out:
        for part in parts:
            out.write(part)
    store.move(beside, path)


def read_file(uri: str, start: int = 0, length: int | None = None) -> bytes:
    store, path = open_store(uri)
    with store.open_input_file(path) as file:
        file.seek(start)
        return file.read(length) if length is not None else file.read()


def column_bytes(array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column as one array, and the n + 1 offsets; null counts as empty."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    if not len(array):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if array.null_count:
        array = pc.fill_null(array, b"" if pa.types.is_binary(array.type) else "")
    array = array.cast(pa.large_binary())
    _, spots, data = array.buffers()
    offsets = np.frombuffer(spots, np.int64)[array.offset: array.offset + len(array) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]: offsets[-1]], offsets - offsets[0]


# Arrow's own pool keeps what it has freed; a worker lives on between tasks.
pa.set_memory_pool(pa.system_memory_pool())


# Fixed values of the C library: the option for the size from which a block is mapped on its own.
M_MMAP_THRESHOLD = -3
MAPPED_BYTES = 1 << 20

try:
    _LIBC = ctypes.CDLL("libc.so.6")
    # Arrays go back to the system as soon as they are freed.  Left alone, the C library raises the
    # size to 32 MB and keeps what is below, in pieces, as long as the worker lives.
    _LIBC.mallopt(M_MMAP_THRESHOLD, MAPPED_BYTES)
except (OSError, AttributeError):
    _LIBC = None


def give_back() -> None:
    """Return freed memory to the system, where the C library can."""
    if _LIBC is not None:
        _LIBC.malloc_trim(0)


def halved(batch: pa.RecordBatch, size: int):
    """The batch in slices of at most ``size`` bytes, or of a single row that is larger."""
    if batch.nbytes <= size or batch.num_rows < 2:
        yield batch
        return
    half = batch.num_rows // 2
    yield from halved(batch.slice(0, half), size)
    yield from halved(batch.slice(half), size)


def bounded(batches, size: int):
    """The batches, large ones in slices of about ``size`` bytes; memory is given back when they are through."""
    for batch in batches:
        yield from halved(batch, size)
    give_back()


def joined(batches, size: int):
    """Batches joined up to about ``size`` bytes, so that work is done on many rows at once; none is cut.

    When they are through, the memory of the task is given back.
    """
    held, total = [], 0
    for batch in batches:
        held.append(batch)
        total += batch.nbytes
        if total >= size:
            yield pa.concat_batches(held)
            held, total = [], 0
    if held:
        yield pa.concat_batches(held)
    held = []
    give_back()


def grouped(batches, size: int = 4 << 20):
    """Batches of about ``size`` bytes, so that work is done on many rows, but not on too many, at once.

    Small batches are joined; large ones, which Spark fills up to ``maxBytesPerBatch``, are cut between rows.
    Less than ``2 * size`` bytes come at once, but for longer rows.
    """
    return joined((part for batch in batches for part in halved(batch, size)), size)


def spare_name(df: DataFrame, name: str) -> str:
    """A column name that the frame doesn't have."""
    while name in df.columns:
        name += "_"
    return name


def nullable(schema: StructType) -> StructType:
    """The schema of rows that went through Python."""
    return StructType([StructField(x.name, x.dataType) for x in schema])
