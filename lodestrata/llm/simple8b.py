"""Token ids in word-aligned binary files: Simple-8b with escapes and block offsets.

A 64-bit word holds a selector in its top four bits and, below it, as many ids
of one width as the selector says.  Ids are cut into blocks of ``BLOCK``; each
block begins a new word, and the file lists the first word of every block, so
all blocks are packed and unpacked side by side with array operations.  An id of
more than 60 bits becomes an escape: the word names its place in a table at the
end of the file.

File, little-endian: ``LSS8``, version, then the counts of documents, ids,
words and escapes (unsigned 64-bit); the document ids (signed 64-bit) and their
numbers of ids; the first word of each block; the words; the escapes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.llm.common import column_bytes, grouped, read_file, stored, write_file
from lodestrata.llm.tokens import encoder, with_end
from lodestrata.session import fresh_dir

# Fixed values of the coding: ids per word and their bits, by selector; 15 is the escape.
COUNTS = np.array([60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1, 1, 1], np.int64)
BITS = np.array([1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 32, 60, 0], np.int64)
ESCAPE = 15
SHORT_SELECTOR = 13  # up to here, ids of 32 bits at most
BLOCK = 1024
MAGIC, VERSION = b"LSS8", 1
FILE_IDS = 16_000_000   # ids after which a file is closed
SEGMENT = 512 * BLOCK   # ids that are packed or unpacked at once
BATCH_BYTES = 4 << 20   # of texts that are encoded at once
SHORT = np.frexp(np.arange(1 << 16, dtype=np.float64))[1].astype(np.uint8)


def _run_widths(widths: np.ndarray) -> dict[int, np.ndarray]:
    """For each count, the greatest width among so many ids from each place on."""
    most = {1: widths}

    def ahead(array, by):
        return np.concatenate([array[by:], np.zeros(by, array.dtype)])

    # A maximum over more ids is one over fewer, and the ids (or runs) that follow.
    for count, (first, second) in {
        2: (1, 1), 3: (2, 1), 4: (2, 2), 5: (4, 1), 6: (4, 2), 7: (4, 3), 8: (4, 4), 10: (8, 2),
        12: (8, 4), 15: (8, 7), 20: (15, 5), 30: (15, 15), 60: (30, 30),
    }.items():
        most[count] = np.maximum(most[first], ahead(most[second], first))
    return most


def _widths(ids: np.ndarray) -> np.ndarray:
    """Bits that each id needs."""
    if int(ids.max()) < len(SHORT):
        return SHORT[ids.astype(np.uint32)]
    low = np.frexp((ids & np.uint64(0xFFFFFFFF)).astype(np.float64))[1]
    high = np.frexp((ids >> np.uint64(32)).astype(np.float64))[1]
    return np.where(high > 0, high + 32, low).astype(np.uint8)


def pack(ids: np.ndarray, escaped: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, the first word of each block and the escapes of unsigned 64-bit ids.

    ``escaped`` is the number of escapes that the file has already.
    """
    n = len(ids)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    blocks = -(-n // BLOCK)
    padded = np.zeros(blocks * BLOCK, np.uint64)
    padded[:n] = ids
    large = padded >> np.uint64(60) != 0
    escapes = padded[large]
    padded[large] = np.arange(escaped, escaped + len(escapes), dtype=np.uint64)
    widths = _widths(padded)
    widths[large] = 61  # fits no plain selector
    # Runs end with their block.
    grid = np.zeros((blocks, BLOCK + 60), np.uint8)
    grid[:, :BLOCK] = widths.reshape(blocks, BLOCK)
    most = _run_widths(grid.ravel())
    # What fits a selector fits all that follow it, so the first that fits is
    # the number of those that don't.
    chosen = np.zeros(grid.size, np.uint8)
    for selector in range(ESCAPE):
        chosen += most[int(COUNTS[selector])] > BITS[selector]
    chosen = chosen.reshape(blocks, BLOCK + 60)[:, :BLOCK].ravel()
    # All blocks step from word to word together.
    at = np.arange(blocks) * BLOCK
    ends = np.minimum(at + BLOCK, n)
    begins = np.zeros(blocks * BLOCK, bool)
    while len(at):
        begins[at] = True
        at = at + COUNTS[chosen[at]]
        going = at < ends
        at, ends = at[going], ends[going]
    spots = np.flatnonzero(begins)
    words = np.zeros(len(spots), np.uint64)
    # The last word of a block may hold fewer ids than its selector says.
    stops = np.minimum((spots // BLOCK + 1) * BLOCK, n)
    kind = chosen[spots]
    short = spots + COUNTS[kind] > stops
    room = np.concatenate([padded, np.zeros(60, np.uint64)])
    for selector in range(16):
        bits = int(BITS[selector])
        for cut in (False, True):
            mine = np.flatnonzero((kind == selector) & (short == cut))
            if not len(mine):
                continue
            first = spots[mine]
            word = room[first] | np.uint64(selector << 60)
            for k in range(1, int(COUNTS[selector])):
                value = room[first + k]
                if cut:
                    value[first + k >= stops[mine]] = 0
                word |= value << np.uint64(k * bits)
            words[mine] = word
    starts = np.searchsorted(spots, np.arange(blocks) * BLOCK)
    return words, starts.astype(np.uint64), escapes


def unpack(words: np.ndarray, starts: np.ndarray, escapes: np.ndarray, n: int) -> np.ndarray:
    """The ids that ``pack`` was given; ``starts`` counts from the first of these words."""
    if not n:
        return np.zeros(0, np.uint64)
    selector = (words >> np.uint64(60)).astype(np.int64)
    counts = COUNTS[selector]
    starts = starts.astype(np.int64)
    last = np.concatenate([starts[1:], [len(words)]]) - 1
    sums = np.concatenate([[0], np.cumsum(counts)])
    sizes = np.full(len(starts), BLOCK)
    sizes[-1] = n - BLOCK * (len(starts) - 1)
    counts[last] = sizes - (sums[last] - sums[starts])
    ends = np.cumsum(counts)
    within = np.arange(n) - np.repeat(ends - counts, counts)
    bits = BITS[selector]
    mask = (np.uint64(1) << bits.astype(np.uint64)) - np.uint64(1)
    mask[selector == ESCAPE] = (1 << 60) - 1
    shift = (within * np.repeat(bits, counts)).astype(np.uint64)
    ids = (np.repeat(words, counts) >> shift) & np.repeat(mask, counts)
    escaped = np.repeat(selector == ESCAPE, counts)
    if escaped.any():
        ids[escaped] = escapes[ids[escaped].astype(np.int64)]
    return ids


def unpack_all(words: np.ndarray, starts: np.ndarray, escapes: np.ndarray, n: int) -> np.ndarray:
    """As ``unpack``, some blocks at a time; 32-bit numbers where all ids fit."""
    wide = len(words) and int(words.max() >> np.uint64(60)) > SHORT_SELECTOR
    ids = np.empty(n, np.uint64 if wide else np.uint32)
    stops = np.append(starts, len(words)).astype(np.int64)
    for block in range(0, len(starts), SEGMENT // BLOCK):
        some = stops[block: block + SEGMENT // BLOCK + 1]
        first = block * BLOCK
        size = min(n - first, SEGMENT)
        ids[first: first + size] = unpack(
            words[some[0]: some[-1]], some[:-1] - some[0], escapes, size
        )
    return ids


class FilePacker:
    """Packs the ids of a file as they come, holding the packed words only."""

    def __init__(self):
        self.doc_ids, self.counts, self.ids = [], [], 0
        self._rest = np.zeros(0, np.uint64)
        self._words, self._starts, self._escapes = [], [], []
        self._sizes = [0, 0]

    def add(self, doc_ids: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> None:
        """Documents, their numbers of ids and all these ids in order."""
        self.doc_ids.append(doc_ids)
        self.counts.append(counts)
        self.ids += len(ids)
        room = np.concatenate([self._rest, ids.astype(np.uint64)])
        whole = len(room) // BLOCK * BLOCK
        self._pack(room[:whole])
        self._rest = room[whole:]

    def _pack(self, ids: np.ndarray) -> None:
        for spot in range(0, len(ids), SEGMENT):
            words, starts, escapes = pack(ids[spot: spot + SEGMENT], self._sizes[1])
            self._words.append(words)
            self._starts.append(starts + np.uint64(self._sizes[0]))
            self._escapes.append(escapes)
            self._sizes = [self._sizes[0] + len(words), self._sizes[1] + len(escapes)]

    def parts(self) -> list[bytes]:
        """The parts of the file, in order."""
        self._pack(self._rest)
        self._rest = self._rest[:0]
        docs = sum(map(len, self.doc_ids))
        head = np.array([VERSION, docs, self.ids, *self._sizes], "<u8")
        lists = [(self.doc_ids, "<i8"), (self.counts, "<u8"), (self._starts, "<u8"),
                 (self._words, "<u8"), (self._escapes, "<u8")]
        return [MAGIC, head.tobytes(), *(x.astype(kind).tobytes() for xs, kind in lists for x in xs)]


def parse_file(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document ids, their numbers of ids, and all ids of a file."""
    if raw[:4] != MAGIC:
        raise ValueError("not a file of packed ids")
    version, docs, n, n_words, n_escapes = np.frombuffer(raw, "<u8", 5, 4).astype(int).tolist()
    if version != VERSION:
        raise ValueError(f"unknown version {version}")
    at, parts = 44, []
    for kind, size in (
        ("<i8", docs), ("<u8", docs), ("<u8", -(-n // BLOCK)), ("<u8", n_words), ("<u8", n_escapes)
    ):
        parts.append(np.frombuffer(raw, kind, size, at))
        at += 8 * size
    doc_ids, counts, starts, words, escapes = parts
    return doc_ids, counts.astype(np.int64), unpack_all(words, starts, escapes, n)


def write_packed(
    docs: DataFrame, vocabulary: str, end_id: int, folder: str, file_ids: int = FILE_IDS,
) -> DataFrame:
    """Encode ``text`` of each document and write the ids in ascending ``doc_id`` order.

    Texts are shuffled once, into ranges of ``doc_id``; each task writes the
    files of its range, of about ``file_ids`` ids each (a document is never cut).  A
    repeated task writes the same files again.  Null text counts as empty, a
    null id comes first and is written as the smallest number; documents with
    one id stand side by side.  Returns one row per file, in order: name,
    documents and ids.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), 0
        code, file = encoder(vocabulary), FilePacker()

        def flush() -> pa.RecordBatch:
            name = f"{part:08d}-{number:06d}.s8b"
            write_file(f"{folder}/{name}", file.parts())
            docs = sum(map(len, file.doc_ids))
            return pa.RecordBatch.from_pydict({"file": [name], "docs": [docs], "ids": [file.ids]})

        for batch in grouped(batches, BATCH_BYTES):
            ids, counts = with_end(*code.encode(*column_bytes(batch["text"])), end_id)
            file.add(pc.fill_null(batch["doc_id"], -(1 << 63)).to_numpy(), counts, ids)
            if file.ids >= file_ids:
                yield flush()
                file, number = FilePacker(), number + 1
        if file.doc_ids:
            yield flush()

    ordered = docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange("doc_id")
    return stored(
        ordered.sortWithinPartitions("doc_id", "text")
        .mapInArrow(run, "file string, docs long, ids long"), "packed-files",
    )


def read_packed(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, ``start`` (ids of all before it), ``ids`` (array).

    Files are read one at a time.  Only the number of ids per file, a row for
    each file, goes through the driver, to say where each file starts.
    """
    return _decoded(spark, folder, manifest, "ids array<long>", lambda part: part.tolist())


def packed_digests(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """As ``read_packed``, with ``n_tokens`` and ``ids_crc32`` of the ids in place of them."""
    return _decoded(
        spark, folder, manifest, "ids_crc32 long",
        lambda part: zlib.crc32(part.astype("<u4").tobytes()),
    )


def _decoded(spark, folder, manifest, column: str, of_ids) -> DataFrame:
    files = [(x.file, x.ids) for x in manifest.orderBy("file").collect()]
    starts = np.concatenate([[0], np.cumsum([x[1] for x in files], dtype=np.int64)]).tolist()
    rows = [(name, start) for (name, _), start in zip(files, starts)]
    name = column.split()[0]
    schema = f"doc_id long, start long, n_tokens long, {column}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, start in zip(*(batch[x].to_pylist() for x in ("file", "start"))):
                doc_ids, counts, ids = parse_file(read_file(f"{folder}/{file}"))
                ends = np.cumsum(counts)
                for spot in range(0, len(counts), 512):
                    part = slice(spot, spot + 512)
                    begins = ends[part] - counts[part]
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": pa.array(doc_ids[part]),
                        "start": pa.array(begins + start),
                        "n_tokens": pa.array(counts[part]),
                        name: [of_ids(ids[b:e]) for b, e in zip(begins, ends[part])],
                    })

    listed = spark.createDataFrame(rows, "file string, start long")
    found = listed.repartition(max(1, len(rows))).mapInArrow(run, schema)
    return found.withColumn("doc_id", F.when(F.col("doc_id") != -(1 << 63), F.col("doc_id")))


def op7_token_output(spark: SparkSession, docs: DataFrame, vocabulary: str) -> DataFrame:
    """Write all documents with end id 2, read the files back, digest the ids."""
    folder = fresh_dir(spark, "packed")
    return packed_digests(spark, folder, write_packed(docs, vocabulary, 2, folder))
