"""Best-fit packing of documents into sequences of a fixed number of tokens.

The plan is a linear grouping scheme over the counts of each length, of which
there are at most ``capacity`` however many documents there are:

1. pieces longer than a share of the capacity, ordered by length, are cut into
   groups of equal cardinality and rounded up to the longest of their group;
2. configurations of these few sizes are optimised one after the other: a
   knapsack finds the fullest one, which is used as often as the counts allow;
3. the actual pieces take the places of the rounded ones, which frees space;
4. the small pieces go, longest first, into the fullest sequence they fit in.

All four work on classes of equal sequences, so the plan's size depends on the
capacity and the number of groups alone.  Spark then ranks the pieces within
their length and looks their places up in the plan.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestrata.llm.common import column_bytes, grouped, stored
from lodestrata.llm.tokens import encoder, with_end

CAPACITY = 4096
GROUPS = 256          # sizes that stay after rounding
LARGE = 1 / 8         # share of the capacity above which a piece is large
RANKED_ROWS = 20_000  # pieces that one task ranks
SCAN_BYTES = 1 << 20  # bytes of texts that are encoded at once


def cut_pieces(
    docs: DataFrame, vocabulary: str, end_id: int, capacity: int = CAPACITY, ids: bool = False,
) -> DataFrame:
    """Token pieces of each document: ``doc_id piece start length ids_crc32`` (and ``ids``).

    A document is the ids of its text (null: none) and the end id; one longer
    than the capacity is cut into full pieces and a rest.
    """
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(vocabulary)
        for batch in grouped(batches, SCAN_BYTES):
            coded, counts = code.encode(*column_bytes(batch["text"]))
            coded, counts = with_end(coded, counts, end_id)
            # Each text's ids in steps of the capacity, the rest last.
            number = -(-counts // capacity)
            of = np.repeat(np.arange(len(counts)), number)
            piece = np.arange(len(of)) - np.repeat(np.cumsum(number) - number, number)
            start = piece * capacity
            length = np.minimum(counts[of] - start, capacity)
            first = np.repeat(np.cumsum(counts) - counts, number) + start
            raw = memoryview(coded).cast("B")
            cuts = list(zip((4 * first).tolist(), (4 * (first + length)).tolist()))
            columns = [
                batch["doc_id"].take(pa.array(of)), pa.array(piece.astype(np.int32)),
                pa.array(start), pa.array(length), pa.array([zlib.crc32(raw[a:b]) for a, b in cuts]),
            ]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if ids:
                bounds = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
                columns.append(pa.ListArray.from_arrays(bounds, pa.array(coded.astype(np.int64))))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, schema + (", ids array<long>" if ids else "")
    )


# ------------------------------------------------------------------- the plan


def _rounded(counts: list[tuple[int, int]], groups: int) -> list[list[list[int]]]:
    """Groups of equal cardinality of (length, number), longest first."""
    total = sum(n for _, n in counts)
    size, found, room = max(1, -(-total // groups)), [], 0
    for length, number in counts:
        while number:
            if not room:
                found.append([])
                room = size
            taken = min(number, room)
            found[-1].append([length, taken])
            number, room = number - taken, room - taken
    return found


def _fullest(sizes: list[int], left: list[int], capacity: int) -> list[int]:
    """How often to take each size so that they fill the capacity best.

    Reachable sums by dynamic programming; ``by[s]`` is the size that was added
    last on the way to the sum ``s``, ``used[s]`` how often by then.
    """
    by = np.full(capacity + 1, -1, np.int32)
    used = np.zeros(capacity + 1, np.int32)
    by[0] = len(sizes)
    for spot, size in enumerate(sizes):
        if not left[spot]:
            continue
        # Sums that this size is first added to, then once more from there.
        fresh, turn = np.flatnonzero(by >= 0), 0
        while turn < left[spot] and len(fresh):
            turn += 1
            fresh = fresh[fresh + size <= capacity] + size
            fresh = fresh[by[fresh] < 0]
            by[fresh], used[fresh] = spot, turn
        if by[capacity] >= 0:
            break
    taken = [0] * len(sizes)
    at = int(np.flatnonzero(by >= 0)[-1])
    while at:
        spot, turns = int(by[at]), int(used[at])
        taken[spot] += turns
        at -= sizes[spot] * turns
    return taken


class PackingPlan:
    """Places of ranked pieces: sorted runs of ranks within a length.

    The piece of rank ``r`` within its length, in the run that starts at rank
    ``f``, goes to sequence ``base + r - f`` at the run's offset.
    """

    def __init__(self, counts: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS):
        self.capacity = capacity
        self.sequences = 0
        self._next = dict.fromkeys(counts, 0)
        self._runs: list[tuple[int, int, int, int]] = []
        self._spare: dict[int, list[tuple[int, int]]] = {}
        self._spaces: list[int] = []
        limit = int(capacity * LARGE)
        ordered = sorted(counts.items(), reverse=True)
        self._place_large([x for x in ordered if x[0] > limit], groups)
        for length, number in ordered:
            if length <= limit:
                self._best_fit(length, number)
        runs = sorted(self._runs)
        self.keys = np.array([(x[0] << 44) + x[1] for x in runs], np.int64)
        self.first = np.array([x[1] for x in runs], np.int64)
        self.base = np.array([x[2] for x in runs], np.int64)
        self.offset = np.array([x[3] for x in runs], np.int64)

    def places(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of pieces."""
        spot = np.searchsorted(self.keys, (length << 44) + rank, "right") - 1
        return self.base[spot] + rank - self.first[spot], self.offset[spot]

    def _put(self, length: int, number: int, base: int, offset: int) -> None:
        self._runs.append((length, self._next[length], base, offset))
        self._next[length] += number

    def _keep(self, space: int, base: int, number: int) -> None:
        """Note ``number`` sequences from ``base`` on that have ``space`` tokens left."""
        if number and space:
            if space not in self._spare:
                self._spare[space] = []
            if not self._spare[space]:
                heappush(self._spaces, space)
            self._spare[space].append((base, number))

    def _place_large(self, counts: list[tuple[int, int]], groups: int) -> None:
        members = _rounded(counts, groups)
        sizes = [group[0][0] for group in members]
        left = [sum(n for _, n in group) for group in members]
        while any(left):
            taken = _fullest(sizes, left, self.capacity)
            times = min(n // k for n, k in zip(left, taken) if k)
            base, self.sequences = self.sequences, self.sequences + times
            slots = []
            for spot, number in enumerate(taken):
                left[spot] -= number * times
                slots += [self._take(members[spot], times) for _ in range(number)]
            self._substitute(slots, base)

    @staticmethod
    def _take(group: list[list[int]], number: int) -> list[list[int]]:
        """The next pieces of a group, as (length, number)."""
        found = []
        while number:
            length, there = group[0]
            taken = min(there, number)
            found.append([length, taken])
            number -= taken
            if taken == there:
                group.pop(0)
            else:
                group[0][1] -= taken
        return found

    def _substitute(self, slots: list[list[list[int]]], base: int) -> None:
        """Place the actual pieces of sequences with one configuration."""
        while slots[0]:
            number = min(slot[0][1] for slot in slots)
            offset = 0
            for slot in slots:
                self._put(slot[0][0], number, base, offset)
                offset += slot[0][0]
                slot[0][1] -= number
                if not slot[0][1]:
                    slot.pop(0)
            self._keep(self.capacity - offset, base, number)
            base += number

    def _best_fit(self, length: int, number: int) -> None:
        """Place pieces of one length, each in the fullest sequence it fits in."""
        passed = []
        while number:
            # The least space that fits; smaller ones fit only smaller lengths.
            while self._spaces and self._spaces[0] < length:
                passed.append(heappop(self._spaces))
            if not self._spaces:
                each = self.capacity // length
                opened = -(-number // each)
                self._keep(self.capacity, self.sequences, opened)
                self.sequences += opened
                continue
            space = self._spaces[0]
            base, there = self._spare[space].pop()
            if not self._spare[space]:
                heappop(self._spaces)
            each = min(space // length, number)
            full = min(there, number // each)
            for turn in range(each):
                self._put(length, full, base, self.capacity - space + turn * length)
            number -= full * each
            self._keep(space - each * length, base, full)
            self._keep(space, base + full, there - full)
        for space in passed:
            heappush(self._spaces, space)


# ------------------------------------------------------------- on the pieces


def best_fit_packing(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces with ``doc_id piece length``.

    ``pieces`` is read three times, so pass a stored table.  Pieces are ranked
    within their length in parts that are dealt by a hash of the piece, so a
    length that a third of them share is spread like any other.  The counts per
    length, at most ``capacity`` of them, go through the driver.  Pieces of no
    token get none of the two numbers.
    """
    counts = {x.length: x.n for x in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()
              if x.length}
    if counts and max(counts) > capacity:
        raise ValueError(f"a piece has more than {capacity} tokens")
    plan = PackingPlan(counts, capacity)
    parts = max(1, -(-sum(counts.values()) // RANKED_ROWS))
    dealt = pieces.withColumn(
        "_part", F.pmod(F.xxhash64("doc_id", "piece", "length"), F.lit(parts)).cast("int")
    )
    before = (
        dealt.groupBy("_part", "length").agg(F.count("*").alias("_n"))
        .withColumn("_before", F.sum("_n").over(
            Window.partitionBy("length").orderBy("_part")) - F.col("_n"))
        .select("_part", "length", "_before")
    )
    # One exchange by the part serves the numbering; the part's own numbers start at 0.
    numbered = dealt.repartition(F.col("_part")).withColumn("_rank", F.row_number().over(
        Window.partitionBy("_part", "length").orderBy("doc_id", "piece")) - 1)
    ranked = numbered.join(before, ["_part", "length"]).select(
        *pieces.columns, (F.col("_rank") + F.col("_before")).cast("long").alias("_rank")
    )
    names, kept = pieces.columns, pieces.schema.simpleString()[7:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch["length"].to_numpy(zero_copy_only=False).astype(np.int64)
            rank = batch["_rank"].to_numpy(zero_copy_only=False).astype(np.int64)
            if len(plan.keys):
                sequence, offset = plan.places(length, rank)
            else:
                sequence, offset = np.zeros_like(length), np.zeros_like(length)
            none = length == 0
            yield pa.RecordBatch.from_arrays(
                [batch[x] for x in names]
                + [pa.array(sequence, mask=none), pa.array(offset, mask=none)],
                [*names, "sequence_id", "offset"],
            )

    schema = kept.replace(":", " ") + ", sequence_id long, offset long"
    return ranked.mapInArrow(run, schema)


def pack_documents(
    docs: DataFrame, vocabulary: str, end_id: int = 1, capacity: int = CAPACITY,
) -> DataFrame:
    """Pieces of all documents with their sequence and the place in it.

    Null text is an empty one (just the end id); a null id and repeated rows
    are packed like any other; an empty table gives no pieces.
    """
    pieces = stored(cut_pieces(docs, vocabulary, end_id, capacity), "pieces")
    return best_fit_packing(pieces, capacity)


def packed_sequences(
    docs: DataFrame, vocabulary: str, end_id: int = 1, capacity: int = CAPACITY,
) -> DataFrame:
    """The sequences themselves: ``sequence_id ids`` (at most ``capacity`` ids)."""
    pieces = stored(cut_pieces(docs, vocabulary, end_id, capacity, ids=True), "pieces")
    return best_fit_packing(pieces, capacity).groupBy("sequence_id").agg(
        F.flatten(F.transform(
            F.sort_array(F.collect_list(F.struct("offset", "ids"))), lambda x: x["ids"]
        )).alias("ids")
    )


def op2_packing(spark: SparkSession, docs: DataFrame, vocabulary: str) -> DataFrame:
    """All documents in sequences of at most 4,096 tokens, end id 1."""
    return pack_documents(docs, vocabulary)
