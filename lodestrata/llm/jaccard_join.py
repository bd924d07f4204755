"""Jaccard join of word shingle sets with prefix filters under several global orders.

All shingles are ordered in several ways that every document agrees on: first by how
common their cell of a fixed table of counts is, then by a hash that differs
from order to order.  Two sets of Jaccard similarity ``t`` share a shingle among the
first ``n - ceil(t n) + 1`` of each, in every order.  The first order's prefixes
are grouped; what meets there must also pass a bound from parity bitmaps.  The prefixes
of the further orders are then joined to these pairs as narrow rows, and only pairs that
share a shingle of the prefix in every order have their texts fetched and compared.

Equal sets are one class from the start.  Then, so that a group of similar sets doesn't
become all its pairs, two passes find the links:

1. in each group of a prefix shingle, members are compared with a pivot only (one of
   ``PIVOTS`` ways to choose it, by shingle), and the links are joined to components; a
   second turn does so with other pivots, where groups still hold several components;
2. in groups that still hold several components, the members of different
   components are compared by their bitmaps, block against block, and the pairs
   that pass are verified.  No candidate is left out, so the components are exact.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.llm.common import bounded, column_bytes, grouped, spare_name, stored
from lodestrata.llm.components import connected
from lodestrata.llm.shingles import mixed, shingle_sets

NUMERATOR, DENOMINATOR = 4, 5   # the similarity, 0.8
CELL_BITS = 18                  # cells of the table of counts: its size is fixed
ORDERS = 3
FILTER_BITS = 23                # of the table that tells candidates' texts from others
TOKEN_BITS = 40                 # of a prefix shingle's name; two that clash only meet in vain
PIVOTS = 4
TURNS = 2                       # of comparing with pivots
CELLS_PER_SHINGLE = 8           # of the bitmaps of small sets
BITMAP_BITS = 2048              # beyond which a bitmap has a cell per shingle
SCAN_BYTES = 1 << 20            # bytes of texts, or of other columns, in work at once
BLOCK = 256                     # members of a group that are compared with as many at once


def prefix_length(n: np.ndarray) -> np.ndarray:
    return n - -(-n * NUMERATOR // DENOMINATOR) + 1


def reach(n: np.ndarray) -> np.ndarray:
    """Shingles of the longer prefix of the first order."""
    short = prefix_length(n)
    return np.minimum(n, short + short // 2)


def least_shared(n: Column) -> Column:
    """Shingles of its longer prefix that a set must share with others to be linked to any.

    A linked set of any size shares as many: of a prefix of ``p + c - 1`` shingles ``c``.  Only a set of
    5 has a partner (of 4, which has a prefix of one) that promises fewer.
    """
    short = n - F.ceil(n * NUMERATOR / DENOMINATOR) + 1
    return F.when(n <= 5, 1).otherwise(F.least(n, short + F.floor(short / 2)) - short + 1)


def order_keys(shingles: np.ndarray, bands: np.ndarray, order: int) -> np.ndarray:
    """Sort keys of one global order: rare cells first, then by the order's own hash."""
    band = bands[(shingles >> np.uint64(64 - CELL_BITS)).astype(np.int64)].astype(np.uint64)
    return band << np.uint64(58) | mixed(shingles, 2 + order) >> np.uint64(6)


def bands_of(counts: np.ndarray) -> np.ndarray:
    """By cell, how often its count is twice as great as the mean (0 up to there)."""
    mean = max(1.0, float(counts.mean()))
    return np.clip(np.floor(np.log2(np.maximum(counts, 1) / mean)), 0, 63).astype(np.uint8)


def prefixes(shingles: np.ndarray, offsets: np.ndarray, bands: np.ndarray, order: int, size=prefix_length):
    """The prefix shingles of sets (by their sort keys), and the set each is of."""
    keys, of, _ = ranked_prefixes(shingles, offsets, bands, order, size)
    return keys, of


def ranked_prefixes(shingles: np.ndarray, offsets: np.ndarray, bands: np.ndarray, order: int, size):
    """As ``prefixes``, with each shingle's rank in its set."""
    of = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    keys = order_keys(shingles, bands, order)
    sort = np.argsort(keys)
    kind = np.uint16 if len(offsets) <= 1 << 16 else np.int64
    sort = sort[np.argsort(of[sort].astype(kind), kind="stable")]
    rank = np.arange(len(keys)) - offsets[:-1][of]
    first = rank < size(np.diff(offsets))[of]
    return keys[sort][first], of[first], rank[first]


def parity_bitmap(shingles: np.ndarray) -> bytes:
    """A bit for each of a power of two of cells: whether it holds an odd number of shingles.

    Small sets have several cells per shingle, so that few shingles share one
    and the bound is close.
    """
    size = 1 << (len(shingles) - 1).bit_length()
    bits = max(64, min(CELLS_PER_SHINGLE * size, max(BITMAP_BITS, size)))
    cells = (mixed(shingles, 0) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits(np.bincount(cells, minlength=bits).astype(np.uint8) & 1, bitorder="little").tobytes()


def may_be_similar(a: int, b: int, n_a: int, n_b: int, bits_a: int, bits_b: int) -> bool:
    """Whether the bitmaps allow the similarity.

    Odd cells that differ each need a shingle that one set lacks; similar sets
    lack at most a ninth of the sum of their sizes.
    """
    while bits_a > bits_b:
        bits_a //= 2
        a = (a >> bits_a) ^ (a & ((1 << bits_a) - 1))
    while bits_b > bits_a:
        bits_b //= 2
        b = (b >> bits_b) ^ (b & ((1 << bits_b) - 1))
    part = DENOMINATOR - NUMERATOR
    return (a ^ b).bit_count() * (DENOMINATOR + NUMERATOR) <= part * (n_a + n_b)


def similar_sizes(small: int, large: int) -> bool:
    return DENOMINATOR * small >= NUMERATOR * large


# ------------------------------------------------------------------ the sets


def set_table(docs: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """``doc_id n k1 k2 bitmap`` of every document, and the band of each cell.

    ``k1`` and ``k2`` are the same for equal sets and for those alone (96 bits).  The
    cells' counts come as one fixed-size row per task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(1 << CELL_BITS, np.int64)
        kinds = pa.schema([
            ("doc_id", pa.int64()), ("n", pa.int64()), ("k1", pa.int64()), ("k2", pa.int32()),
            ("bitmap", pa.binary()), ("cells", pa.binary()),
        ])
        for batch in grouped(batches, SCAN_BYTES):
            sets, offsets = shingle_sets(*column_bytes(batch["text"]))
            cells += np.bincount((sets >> np.uint64(64 - CELL_BITS)).astype(np.int64), minlength=len(cells))
            k1, k2 = set_keys(sets, offsets)
            maps = [parity_bitmap(sets[a:b]) if b > a else None for a, b in zip(offsets[:-1], offsets[1:])]
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays([
                batch["doc_id"], pa.array(np.diff(offsets)), pa.array(k1), pa.array(k2),
                pa.array(maps, pa.binary()), pa.nulls(n, pa.binary()),
            ], schema=kinds)
        packed = zlib.compress(cells.tobytes(), 1)
        yield pa.RecordBatch.from_arrays([
            pa.array([x], k.type) for x, k in zip([None] * 5 + [packed], kinds)
        ], schema=kinds)

    rows = stored(
        docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
            run, "doc_id long, n long, k1 long, k2 int, bitmap binary, cells binary"
        ), "shingle-sets",
    )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << CELL_BITS, np.int64)
        for batch in bounded(batches, SCAN_BYTES):
            for packed in batch["cells"]:
                total += np.frombuffer(zlib.decompress(packed.as_py()), np.int64)
        yield pa.RecordBatch.from_pydict({"cells": pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())})

    # Added up in two steps, as there is a row for each task.
    parts = rows.filter("cells is not null").select("cells")
    sums = parts.repartition(16).mapInArrow(add, "cells binary").collect()
    counts = sum(
        (np.frombuffer(zlib.decompress(x.cells), np.int64) for x in sums),
        np.zeros(1 << CELL_BITS, np.int64),
    )
    return rows.filter("cells is null").drop("cells"), bands_of(counts)


def set_keys(sets: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two numbers for each set that don't depend on the order of its members."""
    size = np.diff(offsets)
    some = np.flatnonzero(size)
    k1, k2 = np.zeros(len(size), np.uint64), np.zeros(len(size), np.uint64)
    if len(some):
        k1[some] = np.add.reduceat(mixed(sets, 3), offsets[some])
        k2[some] = np.bitwise_xor.reduceat(mixed(sets, 5), offsets[some])
    return k1.view(np.int64), (k2 >> np.uint64(32)).astype(np.uint32).view(np.int32)


# ----------------------------------------------------- prefix groups and pivots


def shared_rows(docs: DataFrame, bands: np.ndarray) -> DataFrame:
    """Prefix shingles of the first order that two or more sets have, stored: ``token k1 short``.

    Rows are as narrow as can be, as there are many: a set goes by ``k1``, and should
    two sets share one, both are looked up and compared later.  ``short`` is 1 for those of the usual prefix, 0 for those that make it longer.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in grouped(batches, SCAN_BYTES):
            sets, offsets = shingle_sets(*column_bytes(batch["text"]))
            k1, k2 = set_keys(sets, offsets)
            size = np.diff(offsets)
            # Of equal sets in a batch only the first goes on.
            same = np.lexsort((np.arange(len(k1)), k2, k1))
            once = np.zeros(len(k1), bool)
            once[same] = np.append(True, (k1[same][1:] != k1[same][:-1]) | (k2[same][1:] != k2[same][:-1]))[: len(k1)]
            keys, of, rank = ranked_prefixes(sets, offsets, bands, 0, reach)
            keys, of, rank = keys[once[of]], of[once[of]], rank[once[of]]
            token = (mixed(keys, 4) >> np.uint64(64 - TOKEN_BITS)).astype(np.int64)
            short = (rank < prefix_length(size)[of]).astype(np.int8)
            yield pa.RecordBatch.from_arrays([pa.array(token), pa.array(k1[of]), pa.array(short)], NAMES)

    def drop_single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A row goes out when the next is known; the last one is held back, with
        # whether it continues its group.
        held, continues = None, False
        for batch in bounded(batches, SCAN_BYTES):
            if not batch.num_rows:
                continue
            columns = [batch[x].to_numpy() for x in NAMES]
            if held is not None:
                columns = [np.concatenate([[h], c]).astype(c.dtype) for h, c in zip(held, columns)]
            token, k1 = columns[:2]
            new = np.ones(len(token), bool)
            new[1:] = (token[1:] != token[:-1]) | (k1[1:] != k1[:-1])
            columns = [c[new] for c in columns]
            same = columns[0][1:] == columns[0][:-1]
            before = np.append(continues and held is not None, same)
            out = before[:-1] | same
            yield pa.RecordBatch.from_arrays([pa.array(c[:-1][out]) for c in columns], NAMES)
            held, continues = [c[-1] for c in columns], bool(before[-1])
        if held is not None and continues:
            yield pa.RecordBatch.from_arrays([pa.array(np.array([h])) for h in held], NAMES)

    rows = docs.select("text").mapInArrow(emit, ROW_DDL)
    sorted_ = rows.repartition(F.col("token")).sortWithinPartitions("token", "k1")
    return stored(sorted_.mapInArrow(drop_single, ROW_DDL), "shared-prefixes")


NAMES = ["token", "k1", "short"]
ROW_DDL = "token long, k1 long, short tinyint"


def able_rows(shared: DataFrame, classes: DataFrame) -> DataFrame:
    """Rows of the usual prefix of sets that may have a partner, stored: ``token rep k1 n``.

    A set must share ``least_shared`` shingles of its longer prefix with others.
    """
    need = least_shared(F.col("n").cast("long"))
    able = shared.groupBy("k1").count().join(classes.select("k1", "rep", "n"), "k1").filter(
        F.col("count") >= need).select("k1", "rep", "n")
    rows = shared.filter("short = 1").select("token", "k1").join(able, "k1")
    return stored(rows.select("token", "rep", "k1", "n"), "able-rows")


def mixed_rows(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """Rows with their component, of groups of more than two members that hold several components.

    Two members alone were compared with each other in the first round, one
    being the pivot.  Stored, as what follows reads it several times.
    """
    placed = rows.join(roots, F.col("rep") == F.col("node"), "left").select(
        "token", "rep", "k1", "n", F.coalesce("root", "rep").alias("root")
    )
    several = placed.groupBy("token").agg(
        F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("members")
    ).filter("low != high and members > 2").select("token", "members")
    return stored(placed.join(several, "token"), "mixed-rows")


def star_pairs(rows: DataFrame, turn: int) -> DataFrame:
    """Each member of a group with its pivot, where the components differ: ``a b a1 b1``.

    A group has a pivot for each range of sizes, and streams through sorted, its
    pivots being all that is held.  Which member comes first differs by shingle and
    turn, so that a member that is far from one pivot may be near another.
    """
    names = ["token", "rep", "k1", "n", "root"]

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots, current = [], None
        for batch in bounded(batches, SCAN_BYTES):
            out = []
            for token, rep, k1, size, root in zip(*(batch[x].to_pylist() for x in names)):
                if token != current:
                    current, pivots = token, []
                pivot = next((p for p in pivots if similar_sizes(min(size, p[2]), max(size, p[2]))), None)
                if pivot is None:
                    pivots.append((rep, k1, size, root))
                elif pivot[3] != root:
                    out.append((rep, pivot[0], k1, pivot[1]))
            columns = list(zip(*out)) or [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, pa.int64()) for x in columns], ["a", "b", "a1", "b1"]
            )

    ordered = rows.repartition(F.col("token")).withColumn(
        "turn", F.xxhash64("rep", "k1", F.col("token") % PIVOTS, F.lit(turn))
    ).sortWithinPartitions("token", "turn").select(*names)
    return ordered.mapInArrow(choose, "a long, b long, a1 long, b1 long").filter("a != b").distinct()


PAIR = ["a", "b", "a1", "b1", "n_a", "n_b", "map_a", "map_b"]


def bitmap_filter(pairs: DataFrame) -> DataFrame:
    """The pairs whose bitmaps and sizes allow the similarity: ``a b a1 b1``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, SCAN_BYTES):
            keep = [
                similar_sizes(min(x, y), max(x, y)) and may_be_similar(
                    int.from_bytes(p, "little"), int.from_bytes(q, "little"), x, y, 8 * len(p), 8 * len(q))
                for p, q, x, y in zip(*(batch[c].to_pylist() for c in ("map_a", "map_b", "n_a", "n_b")))
            ]
            yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b", "a1", "b1"])

    return pairs.mapInArrow(run, "a long, b long, a1 long, b1 long")


def id_filter(ids: DataFrame) -> np.ndarray:
    """A table of a fixed size that is true for the given ids, and for few others while they are few."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << FILTER_BITS, bool)
        for batch in bounded(batches, SCAN_BYTES):
            bits[_cell(batch["doc_id"].to_numpy())] = True
        packed = zlib.compress(np.packbits(bits).tobytes(), 1)
        yield pa.RecordBatch.from_pydict({"bits": pa.array([packed], pa.binary())})

    found = np.zeros(1 << FILTER_BITS, bool)
    for row in ids.select("doc_id").repartition(16).mapInArrow(run, "bits binary").collect():
        found |= np.unpackbits(np.frombuffer(zlib.decompress(row.bits), np.uint8)).astype(bool)
    return found


def _cell(ids: np.ndarray) -> np.ndarray:
    return (mixed(ids.astype(np.int64).view(np.uint64), 0) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def near_rows(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``doc_id text`` of the documents with the given ids, and of few others, without a shuffle."""
    bits = id_filter(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, SCAN_BYTES):
            keep = bits[_cell(batch["doc_id"].to_numpy())]
            yield batch.filter(pa.array(keep))

    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("doc_id is not null")
    return named.mapInArrow(run, "doc_id long, text string")


def further_prefixes(docs: DataFrame, ids: DataFrame, bands: np.ndarray) -> DataFrame:
    """Prefixes of the given documents under each order but the first, stored: ``doc_id k1 p1 p2``.

    A shingle goes by 32 bits; two that clash let a pair through, which is compared later.
    """
    further = range(1, ORDERS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in grouped(batches, SCAN_BYTES):
            sets, offsets = shingle_sets(*column_bytes(batch["text"]))
            lists = []
            for order in further:
                keys, of = prefixes(sets, offsets, bands, order)
                names = (mixed(keys, 4) >> np.uint64(32)).astype(np.uint32).view(np.int32)
                starts = np.searchsorted(of, np.arange(batch.num_rows + 1)).astype(np.int32)
                lists.append(pa.ListArray.from_arrays(pa.array(starts), pa.array(names)))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(set_keys(sets, offsets)[0]), *lists],
                ["doc_id", "k1", *(f"p{order}" for order in further)],
            )

    ddl = "doc_id long, k1 long, " + ", ".join(f"p{order} array<int>" for order in further)
    rows = near_rows(docs, ids).mapInArrow(run, ddl)
    return stored(rows.dropDuplicates(["doc_id", "k1"]), "further-prefixes")


def meeting(pairs: DataFrame, docs: DataFrame, bands: np.ndarray) -> DataFrame:
    """The pairs ``a b a1 b1`` that share a prefix shingle in every further order, too, stored."""
    table = further_prefixes(docs, ids_of(pairs), bands)
    further = range(1, ORDERS)
    sides = [
        table.select(F.col("doc_id").alias(x), F.col("k1").alias(f"{x}1"),
                     *(F.col(f"p{order}").alias(f"{x}_{order}") for order in further)) for x in ("a", "b")
    ]
    both = pairs.join(sides[0], ["a", "a1"]).join(sides[1], ["b", "b1"])
    for order in further:
        both = both.filter(F.arrays_overlap(f"a_{order}", f"b_{order}"))
    return stored(both.select("a", "b", "a1", "b1"), "meeting-pairs")


def ids_of(pairs: DataFrame) -> DataFrame:
    """``doc_id`` of the documents in pairs, each once."""
    return pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id"))).distinct()


def texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``doc_id text`` of the documents with the given ids, stored.

    Texts of other documents are left out before the shuffle, as far as the
    filter tells; the join decides.
    """
    return stored(near_rows(docs, ids).join(ids, "doc_id", "left_semi"), "candidate-texts")


def verified(pairs: DataFrame, docs: DataFrame, bands: np.ndarray) -> DataFrame:
    """The links among pairs ``a b a1 b1``: prefixes under every further order, then the sets.

    Whole texts of the documents in pairs that pass all filters come together; the set
    keys ``a1 b1`` tell rows that repeat an id with another text apart.
    """
    pairs = meeting(pairs, docs, bands)
    texts = texts_of(docs, ids_of(pairs))
    both = pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a").join(
        texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b"
    ).select("a", "b", "a1", "b1", "text_a", "text_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, SCAN_BYTES):
            sides = [shingle_sets(*column_bytes(batch[x])) for x in ("text_a", "text_b")]
            right = np.ones(batch.num_rows, bool)
            for (sets, offsets), key in zip(sides, ("a1", "b1")):
                right &= set_keys(sets, offsets)[0] == batch[key].to_numpy()
            keep = np.zeros(batch.num_rows, bool)
            for i in np.flatnonzero(right):
                x, y = (sets[offsets[i]: offsets[i + 1]] for sets, offsets in sides)
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep[i] = DENOMINATOR * common >= NUMERATOR * (len(x) + len(y) - common)
            yield batch.filter(pa.array(keep)).select(["a", "b"])

    return stored(both.mapInArrow(run, "a long, b long"), "links")


def _across(mixed: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs of different components that meet in a group and pass the bitmaps: ``a b a1 b1``.

    A group is cut into blocks of about ``BLOCK`` members by a hash; a block meets every
    block of its group (itself included) in a task of its own, and only pairs
    that pass leave it.
    """
    members = mixed.join(classes.select("rep", "k1", "bitmap"), ["rep", "k1"]).withColumn(
        "blocks", F.ceil(F.col("members") / BLOCK).cast("int")
    ).withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    placed = members.select(
        "token", "rep", "k1", "bitmap", "n", "root", "block",
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"),
    ).select(
        "token", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"),
        (F.col("block") > F.col("other")).alias("second"), "rep", "k1", "bitmap", "n", "root",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key = [], None

        def flush() -> list[tuple]:
            out = []
            (_, x, y) = key
            rows = sorted(set(held), key=lambda r: r[4])
            for i, p in enumerate(rows):
                for q in rows[i + 1:]:
                    if not similar_sizes(p[4], q[4]):
                        break  # all that follow are larger still
                    if p[5] != q[5] and p[1] != q[1] and (x == y or p[0] != q[0]) and may_be_similar(
                        p[3], q[3], p[4], q[4], p[6], q[6]
                    ):
                        a, b = (p, q) if p[1] < q[1] else (q, p)
                        out.append((a[1], b[1], a[2], b[2]))
            return out

        names = ["a", "b", "a1", "b1"]

        def batch_of(rows) -> pa.RecordBatch:
            columns = list(zip(*rows)) or [[]] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

        for batch in bounded(batches, SCAN_BYTES):
            out = []
            for t, x, y, second, rep, k1, bitmap, n, root in zip(*(c.to_pylist() for c in batch.columns)):
                if (t, x, y) != key:
                    if len(held) > 1:
                        out += flush()
                    held, key = [], (t, x, y)
                held.append((second, rep, k1, int.from_bytes(bitmap, "little"), n, root, 8 * len(bitmap)))
            yield batch_of(out)
        if len(held) > 1:
            yield batch_of(flush())

    sorted_ = placed.repartition("token", "x", "y").sortWithinPartitions("token", "x", "y")
    return sorted_.mapInArrow(run, "a long, b long, a1 long, b1 long").distinct()


def similar_documents(docs: DataFrame) -> DataFrame:
    """``doc_id n_shingles component_id`` of every document.

    ``component_id`` is the least id that is reachable by links of similarity 0.8 or more.  A text
    without words (or null) has no shingle and is a component of its own; equal
    sets are linked.  A row without an id belongs to the component of its set,
    null if no row with an id has it; rows that repeat an id are one node.
    """
    rows, bands = set_table(docs)
    some = rows.filter("n > 0")
    classes = stored(
        some.groupBy("k1", "k2").agg(F.min("doc_id").alias("rep"), F.any_value("n").alias("n"),
                                     F.any_value("bitmap").alias("bitmap"))
        .filter("rep is not null"),
        "classes",
    )
    table = able_rows(shared_rows(docs, bands), classes)
    left, right = (
        classes.select(F.col("rep").alias(x), F.col("k1").alias(f"{x}1"), F.col("n").alias(f"n_{x}"),
                       F.col("bitmap").alias(f"map_{x}")) for x in ("a", "b")
    )
    links, mixed = None, table.withColumn("root", F.col("rep"))
    for turn in range(TURNS):
        paired = star_pairs(mixed, turn).join(left, ["a", "a1"]).join(right, ["b", "b1"])
        found = verified(stored(bitmap_filter(paired.select(*PAIR)), "star-pairs"), docs, bands)
        links = found if links is None else links.unionByName(found)
        mixed = mixed_rows(table, connected(links))
    across = stored(_across(mixed, classes), "cross-pairs")
    final = connected(links.unionByName(verified(across, docs, bands)))
    named = classes.join(final, F.col("rep") == F.col("node"), "left").select(
        "k1", "k2", F.coalesce("root", "rep").alias("component")
    )
    return rows.join(named, ["k1", "k2"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.coalesce("component", "doc_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def op6_jaccard_join(spark, docs: DataFrame) -> DataFrame:
    """Components of five-word shingle sets at similarity 0.8 over all documents."""
    return similar_documents(docs)


def one_per_group(docs: DataFrame) -> DataFrame:
    """The documents without those that are linked to a smaller id, with all their columns.

    Documents without words stay, and so do rows without an id.
    """
    gone = spare_name(docs, "_gone")
    later = similar_documents(docs).filter("doc_id != component_id").select(F.col("doc_id").alias(gone)).distinct()
    known = docs.filter("doc_id is not null").join(later, F.col("doc_id") == F.col(gone), "left_anti")
    return known.unionByName(docs.filter("doc_id is null"))


# Shingles as text; components as the least id of all that is reached.
OP6_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) BETWEEN 1 AND 4 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END) AS shingle
  FROM w
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS both_have FROM s AS a JOIN s AS b
    ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM p JOIN n AS x ON x.doc_id = a JOIN n AS y ON y.doc_id = b
  WHERE 100 * both_have >= 80 * (x.n + y.n - both_have)
), e AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reached AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION
  SELECT reached.doc_id, e.b FROM reached JOIN e ON e.a = reached.other
)
SELECT r.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(other) AS component_id
FROM reached AS r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id
"""
