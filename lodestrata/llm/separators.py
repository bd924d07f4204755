"""Token counts of documents from flat token files that have no index.

A token file is nothing but unsigned little-endian ids, each document ended by
one id that no text can produce.  Files are scanned in blocks: every task looks
for the end id in its blocks with array comparisons, and each block reports the
places of its ends relative to the block.  A prefix scan over the blocks of a
file then gives each block the number of documents that ended before it and the
place of the last end before it, which stitches documents that cross blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestrata.llm.common import column_bytes, grouped, open_store, read_file, stored, write_file
from lodestrata.llm.tokens import encoder, with_end
from lodestrata.session import fresh_dir

END_ID = 49407           # the vocabulary's own end of text, which texts can't produce
BLOCK_TOKENS = 1 << 20   # tokens that are searched at once
FILE_TOKENS = 1 << 24    # tokens after which a file is closed


def write_flat(
    docs: DataFrame, vocabulary: str, folder: str, end_id: int = END_ID, width: int = 2,
    file_tokens: int = FILE_TOKENS,
) -> DataFrame:
    """Write the ids of all documents to flat files, one or more per task, without a shuffle.

    Names of special tokens in a text are ordinary text here, so the end id
    stands at ends only.  ``width`` is the bytes per id.  Returns which document is
    where: ``file ordinal doc_id``; the files hold ids alone.
    """
    if not 0 <= end_id < 1 << 8 * width:
        raise ValueError(f"ids of {width} bytes can't hold {end_id}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number, held = TaskContext.get().partitionId(), 0, 0
        code = encoder(vocabulary, special_as_text=True)
        kind, names, coded = f"<u{width}", [], []

        def flush() -> pa.RecordBatch:
            file = f"{part:08d}-{number:06d}.tokens"
            write_file(f"{folder}/{file}", coded)
            ids = pa.concat_arrays(names)
            return pa.RecordBatch.from_arrays(
                [pa.array([file] * len(ids)), pa.array(np.arange(len(ids))), ids],
                ["file", "ordinal", "doc_id"],
            )

        for batch in grouped(batches):
            ids, counts = code.encode(*column_bytes(batch["text"]))
            if len(ids) and int(ids.max()) >> 8 * width:
                raise ValueError(f"an id doesn't fit into {width} bytes")
            ids, _ = with_end(ids, counts, end_id)
            names.append(batch["doc_id"])
            coded.append(ids.astype(kind).tobytes())
            held += len(ids)
            if held >= file_tokens:
                yield flush()
                names, coded, held, number = [], [], 0, number + 1
        if names:
            yield flush()

    return stored(
        docs.select(F.col("doc_id").cast("long"), "text")
        .mapInArrow(run, "file string, ordinal long, doc_id long"), "flat-files",
    )


def list_files(folder: str) -> list[tuple[str, int]]:
    """Names and bytes of the token files of a folder."""
    from pyarrow import fs

    store, path = open_store(folder)
    found = store.get_file_info(fs.FileSelector(path, allow_not_found=True))
    return sorted((x.base_name, x.size) for x in found if x.base_name.endswith(".tokens"))


def count_tokens(
    spark: SparkSession, folder: str, end_id: int = END_ID, width: int = 2,
    block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """Documents of the token files of a folder: ``file ordinal start n_tokens ended``.

    ``start`` is the document's first id in its file, ``n_tokens`` leaves the end id
    out.  What follows the last end of a file is a document that hasn't
    ``ended``.  Names and sizes of files go through the driver, no more; a
    folder without files gives no rows.
    """
    files = list_files(folder)
    listed = spark.createDataFrame(files or [("", 0)], "file string, bytes long")
    size = block_tokens * width
    blocks = listed.filter("bytes > 0").select(
        "file", (F.col("bytes") / width).cast("long").alias("tokens"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(bytes - 1) div {size}"))).alias("block"),
    )
    many = max(1, -(-sum(x[1] for x in files) // (8 * size)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, tokens, block in zip(*(batch[i].to_pylist() for i in range(3))):
                raw = read_file(f"{folder}/{file}", block * size, size)
                ids = np.frombuffer(raw[: len(raw) // width * width], f"<u{width}")
                ends = np.flatnonzero(ids == end_id) + block * block_tokens
                yield pa.RecordBatch.from_arrays(
                    [pa.array([file]), pa.array([tokens]), pa.array([block]),
                     pa.array([ends.tolist()], pa.list_(pa.int64()))],
                    ["file", "tokens", "block", "ends"],
                )

    searched = blocks.repartition(many, "file", "block").mapInArrow(
        run, "file string, tokens long, block long, ends array<long>"
    )
    # The prefix scan: a few numbers for each block of a file.
    prior = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    last = F.when(F.size("ends") > 0, F.element_at("ends", -1))
    stitched = searched.select(
        "*",
        F.coalesce(F.sum(F.size("ends")).over(prior), F.lit(0)).alias("before"),
        F.coalesce(F.max(last).over(prior), F.lit(-1).cast("long")).alias("prior_end"),
        (F.col("block") == F.max("block").over(Window.partitionBy("file"))).alias("is_last"),
    )
    # Each end closes the document that began after the end before it; the last
    # block also has what no end closes.
    bounds = F.concat(F.array("prior_end"), "ends")
    closed = stitched.select(
        "file", "tokens", "before", "is_last", bounds.alias("bounds"),
        F.posexplode(F.concat(
            F.transform("ends", lambda x: F.struct(x.alias("end"), F.lit(True).alias("ended"))),
            F.when(F.col("is_last"), F.array(F.struct(F.col("tokens").alias("end"), F.lit(False).alias("ended"))))
            .otherwise(F.array().cast("array<struct<end:bigint,ended:boolean>>")),
        )).alias("pos", "stop"),
    )
    start = F.get("bounds", F.col("pos")) + 1
    return closed.select(
        "file", (F.col("before") + F.col("pos")).cast("long").alias("ordinal"),
        start.alias("start"), (F.col("stop.end") - start).alias("n_tokens"),
        F.col("stop.ended").alias("ended"),
    ).filter("ended or n_tokens > 0")


def op9_token_counts(spark: SparkSession, docs: DataFrame, vocabulary: str) -> DataFrame:
    """Token counts of all documents, found in the flat files they were written to.

    One row per document: ``doc_id n_tokens``, and its ``file ordinal start``.
    """
    folder = fresh_dir(spark, "flat-tokens")
    where = write_flat(docs, vocabulary, folder)
    # Estimates don't see how many rows a block's ends become; neither side may be broadcast.
    return count_tokens(spark, folder).join(where.hint("merge"), ["file", "ordinal"]).select(
        "doc_id", "n_tokens", "file", "ordinal", "start"
    )
