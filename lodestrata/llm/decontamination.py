"""Benchmark decontamination: find passages of documents within an edit budget of a benchmark item.

Q-gram lemma: a passage within ``e`` edits of an item of ``n`` bytes shares at
least ``n + 1 - q (e + 1)`` of the item's q-grams, all on diagonals (place in the text
less place in the item) at most ``e`` apart.  Shared q-grams are counted in
overlapping bands of diagonals, so that each such passage lies wholly in one; bands that
reach the bound are verified by an alignment that stays within the band.

Q-grams of many items (a question's usual opening words) are not counted: the bound of an item is
lowered by the number of its places that hold one, as so many may be shared unseen.  Items that
consist of little else keep theirs.  Items of fewer than ``Q`` bytes have no q-gram: they are found as
they are, where they don't begin or end within a word.

Texts are compared in lower case with runs of white space as one space; places
are those of the original text, in bytes.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.llm.common import column_bytes, grouped, nullable, read_file, write_file
from lodestrata.session import fresh_dir

Q = 10
EDIT_RATE = 0.06           # edits allowed for each byte of an item
TABLE_BITS = 20            # of the first look-up
ITEM_BYTES = 2 << 20       # bytes of items of one index, at most; the index has about thirty times as many
SCAN_BYTES = 1 << 20       # bytes of text that are scanned at once; the scan takes some eighty times as many
COMMON = 64                # places in the items from which a q-gram is a common one
EXPANDED = 1 << 20         # shared places that are counted at once
ALIGNED = 256              # candidates that are aligned side by side
ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xD6E8FEB86659FD93))

OUTSIDE, FAR = -1, 1 << 20  # a place that matches nothing; a cost that is never paid

FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
FOLD[[9, 10, 11, 12, 13]] = 32
WORD = np.zeros(256, bool)
WORD[48:58] = WORD[65:91] = WORD[97:123] = WORD[128:] = True


def normalised(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Folded bytes, their offsets, and the place each had in the texts."""
    folded = FOLD[data]
    keep = np.ones(len(data), bool)
    keep[1:] = (folded[1:] != 32) | (folded[:-1] != 32)
    keep[offsets[:-1][offsets[:-1] < len(data)]] = True
    places = np.flatnonzero(keep)
    return folded[places], np.searchsorted(places, offsets), places


def gram_keys(text: np.ndarray) -> np.ndarray:
    """A 64-bit key for the q-gram at each place."""
    n = len(text) - Q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    eight = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(text, 8)[:n])
    keys = eight.view("<u8").ravel() * ODD[0]
    rest = text[8: 8 + n].astype(np.uint64) | text[9: 9 + n].astype(np.uint64) << np.uint64(8)
    keys ^= rest * ODD[1]
    keys ^= keys >> np.uint64(31)
    return keys * ODD[2]


def short_keys(text: np.ndarray, size: int) -> np.ndarray:
    """The bytes of each place and those behind it as one number (``size`` up to 8), or as two that are mixed."""
    room = np.concatenate([text, np.zeros(8, np.uint8)])
    n = max(len(text) - size + 1, 0)
    found = np.zeros(n, np.uint64)
    for k in range(size):
        found = (found << np.uint64(8) | room[k: k + n]) if k < 8 else found * ODD[0] + room[k: k + n]
    return found


@dataclass
class ItemIndex:
    """Benchmark items and where their q-grams are; its size follows from ``ITEM_BYTES``."""

    ids: np.ndarray        # of each item
    text: np.ndarray       # bytes of all items
    offsets: np.ndarray
    edits: np.ndarray      # budget of each item
    bound: np.ndarray      # q-grams that must be shared
    width: np.ndarray      # of a band
    keys: np.ndarray       # distinct keys, sorted
    starts: np.ndarray     # where each key's occurrences start (and the end)
    item_of: np.ndarray    # of each occurrence, ascending for each key
    place_of: np.ndarray
    table: np.ndarray
    short: list            # of items without a q-gram: (size, sorted keys, their items)

    @staticmethod
    def of(ids: list[int], texts: list[str]) -> ItemIndex:
        raw = [x.encode() for x in texts]
        data = np.frombuffer(b"".join(raw), np.uint8)
        text, offsets, _ = normalised(data, np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(int))
        size = np.diff(offsets)
        edits = np.minimum((size * EDIT_RATE).astype(np.int64), np.maximum(size // Q - 1, 0))
        bound = size + 1 - Q * (edits + 1)
        keys = gram_keys(text)
        item = np.repeat(np.arange(len(size)), size)[: len(keys)]
        place = np.arange(len(keys)) - offsets[item]
        inside = place + Q <= size[item]
        keys, item, place = keys[inside], item[inside], place[inside]
        order = np.argsort(keys, kind="stable")
        keys, item, place = keys[order], item[order], place[order]
        _, of, number = np.unique(keys, return_inverse=True, return_counts=True)
        common = number[of] > COMMON
        lost = np.bincount(item[common], minlength=len(size))
        kept = ~common | (bound <= lost)[item]
        bound = np.where(bound > lost, bound - lost, bound)
        keys, item, place = keys[kept], item[kept], place[kept]
        distinct, starts = np.unique(keys, return_index=True)
        table = np.zeros(1 << TABLE_BITS, bool)
        table[(distinct >> np.uint64(64 - TABLE_BITS)).astype(np.int64)] = True
        return ItemIndex(
            np.array(ids, np.int64), text, offsets, edits, bound,
            np.maximum(16, edits + 1), distinct, np.append(starts, len(keys)), item.astype(np.int32),
            place.astype(np.int32), table, ItemIndex._short(text, offsets),
        )

    @staticmethod
    def _short(text: np.ndarray, offsets: np.ndarray) -> list:
        by_size: dict[int, list] = {}
        for i in np.flatnonzero(np.diff(offsets) < Q).tolist():
            part = text[offsets[i]: offsets[i + 1]]
            solid = np.flatnonzero(part != 32)
            if len(solid):
                part = part[solid[0]: solid[-1] + 1]
                by_size.setdefault(len(part), []).append((int(short_keys(part, len(part))[0]), i))
        found = []
        for size, pairs in sorted(by_size.items()):
            pairs.sort()
            found.append((size, np.array([k for k, _ in pairs], np.uint64), np.array([i for _, i in pairs])))
        return found

    def short_passages(self, text: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(text, item, begin, end) of each place where an item without q-grams stands by itself."""
        if not self.short:
            return
        first = np.zeros(len(text) + 1, bool)
        first[offsets] = True
        word = WORD[text]
        # Between two word bytes of one text nothing begins or ends.
        tied = np.zeros(len(text) + 1, bool)
        tied[1:-1] = word[1:] & word[:-1] & ~first[1:-1]
        for size, keys, items in self.short:
            here = short_keys(text, size)
            at = np.flatnonzero(~tied[: len(here)] & ~tied[size: size + len(here)])
            at = at[np.isin(here[at], keys)]
            doc = np.searchsorted(offsets, at, "right") - 1
            inside = at + size <= offsets[doc + 1]
            for begin, d in zip(at[inside].tolist(), doc[inside].tolist()):
                low, high = np.searchsorted(keys, here[begin], "left"), np.searchsorted(keys, here[begin], "right")
                for i in items[low:high].tolist():
                    if np.array_equal(self._solid(i), text[begin: begin + size]):
                        yield d, i, begin, begin + size

    def _solid(self, item: int) -> np.ndarray:
        part = self.text[self.offsets[item]: self.offsets[item + 1]]
        solid = np.flatnonzero(part != 32)
        return part[solid[0]: solid[-1] + 1]

    def candidates(self, text: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
        """Document, item and first diagonal of the bands that reach their item's bound.

        Where texts and items share more than ``EXPANDED`` places, some items at a time are counted.
        """
        keys = gram_keys(text)
        near = np.flatnonzero(self.table[(keys >> np.uint64(64 - TABLE_BITS)).astype(np.int64)])
        spot = np.searchsorted(self.keys, keys[near])
        spot[spot == len(self.keys)] = 0
        same = self.keys[spot] == keys[near] if len(self.keys) else np.zeros(0, bool)
        near, spot = near[same], spot[same]
        doc = np.searchsorted(offsets, near, "right") - 1
        inside = near + Q <= offsets[doc + 1]
        near, spot, doc = near[inside], spot[inside], doc[inside]
        number = np.diff(self.starts)
        total = int(number[spot].sum()) if len(spot) else 0
        if total <= EXPANDED:
            return self._bands(near, spot, doc, offsets, self.starts[spot], self.starts[spot + 1])
        # Shared places by item, and ranges of items that have about as many as may be counted at once.
        rank = np.repeat(np.arange(len(self.keys)), number)
        uses = np.bincount(spot, minlength=len(self.keys))
        sums = np.cumsum(np.bincount(self.item_of, weights=uses[rank], minlength=len(self.ids)))
        cuts = np.flatnonzero(np.diff(np.concatenate([[-1], sums // EXPANDED]))).tolist()
        both = rank * len(self.ids) + self.item_of
        found = []
        for low, high in zip(cuts, [*cuts[1:], len(self.ids)]):
            begin = np.searchsorted(both, spot * len(self.ids) + low)
            end = np.searchsorted(both, spot * len(self.ids) + high)
            some = end > begin
            found.append(self._bands(near[some], spot[some], doc[some], offsets, begin[some], end[some]))
        return tuple(np.concatenate(x) for x in zip(*found))

    def _bands(self, near, spot, doc, offsets, begin, end) -> tuple[np.ndarray, ...]:
        """The bands that reach the bound, of the occurrences ``begin`` to ``end`` of each shared q-gram."""
        number = end - begin
        of = np.repeat(np.arange(len(near)), number)
        at = np.arange(len(of)) - np.repeat(np.cumsum(number) - number, number) + begin[of]
        item, place = self.item_of[at], self.place_of[at]
        doc, diagonal = doc[of], near[of] - offsets[doc[of]] - place
        # A band and, where the diagonal is near its beginning, the band before it.
        width = self.width[item]
        band = diagonal // width
        both = diagonal - band * width < self.edits[item]
        doc, item = np.concatenate([doc, doc[both]]), np.concatenate([item, item[both]]).astype(np.int64)
        band = np.concatenate([band, band[both] - 1])
        place = np.concatenate([place, place[both]])
        order = np.lexsort((place, band, item, doc))
        doc, item, band, place = doc[order], item[order], band[order], place[order]
        if not len(doc):
            return doc, item, band
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (band[1:] != band[:-1])
        distinct = new.copy()
        distinct[1:] |= place[1:] != place[:-1]
        first = np.flatnonzero(new)
        enough = first[np.add.reduceat(distinct.astype(np.int64), first) >= self.bound[item[first]]]
        return doc[enough], item[enough], band[enough] * self.width[item[enough]]


def banded_alignment(patterns, texts, start=None) -> tuple[np.ndarray, np.ndarray]:
    """Least edits of whole patterns against parts of texts, and where the part ends.

    Place ``r`` of a pattern may meet the places ``r`` to ``r + width - 1`` of its text: those
    diagonals alone are looked at.  A part may begin on any of them, or, with
    ``start``, on the given one of each pair.  All pairs go through their rows together.
    """
    rows = max(map(len, patterns))
    size = np.array([len(x) for x in patterns])
    length = np.array([len(x) for x in texts])
    width = int((length - size).max()) + 1
    text = np.full((len(patterns), rows + width), OUTSIDE, np.int16)
    pattern = np.full((len(patterns), rows), OUTSIDE - 1, np.int16)
    for i, (p, t) in enumerate(zip(patterns, texts)):
        pattern[i, : len(p)] = p
        text[i, : len(t)] = t
    step = np.arange(width, dtype=np.int32)
    cost = np.zeros((len(patterns), width), np.int32)
    if start is not None:
        cost += step - start[:, None]
        cost[cost < 0] = FAR
    final = cost.copy()
    for row in range(rows):
        best = cost + (text[:, row: row + width] != pattern[:, row: row + 1])
        best[:, :-1] = np.minimum(best[:, :-1], cost[:, 1:] + 1)
        # Bytes of the text that the pattern lacks: one more edit per step to the right.
        cost = np.minimum.accumulate(best - step, axis=1) + step
        done = size == row + 1
        final[done] = cost[done]
    final[size[:, None] + step > length[:, None]] = FAR
    end = final.argmin(axis=1)
    return final[np.arange(len(patterns)), end], size + end


def _region(text: np.ndarray, begin: int, end: int, low: int, high: int) -> np.ndarray:
    """Places ``begin`` to ``end`` of the text, those outside of ``low`` to ``high`` matching nothing."""
    found = np.full(end - begin, OUTSIDE, np.int16)
    first, last = max(begin, low), max(min(end, high), max(begin, low))
    found[first - begin: last - begin] = text[first:last]
    return found


def find_passages(index: ItemIndex, data: np.ndarray, offsets: np.ndarray) -> list[tuple]:
    """(text, item, start, length, distance) of every passage within its item's budget."""
    text, bounds, places = normalised(data, offsets)
    found = set()
    docs, items, diagonals = index.candidates(text, bounds)
    for spot in range(0, len(docs), ALIGNED):
        part = slice(spot, spot + ALIGNED)
        doc, item = docs[part], items[part]
        low, high, edits = bounds[doc], bounds[doc + 1], index.edits[item]
        patterns = [index.text[index.offsets[i]: index.offsets[i + 1]] for i in item]
        begin = low + diagonals[part] - edits
        end = begin + [len(x) for x in patterns] + index.width[item] + 3 * edits
        regions = [_region(text, *x) for x in zip(begin, end, low, high)]
        distance, stop = banded_alignment(patterns, regions)
        stop = np.minimum(begin + stop, high)
        good = np.flatnonzero(distance <= edits)
        if not len(good):
            continue
        # The start: the pattern backwards from where the passage ends.
        spare = distance[good].astype(np.int64)
        back = [
            _region(text, stop[k] - len(patterns[k]) - d, stop[k] + d, low[k], stop[k])[::-1]
            for k, d in zip(good, spare)
        ]
        _, length = banded_alignment([patterns[k][::-1] for k in good], back, spare)
        for k, size in zip(good, length - spare):
            first = places[max(stop[k] - size, low[k])] - offsets[doc[k]]
            last = places[stop[k] - 1] + 1 - offsets[doc[k]]
            found.add((int(doc[k]), int(item[k]), int(first), int(last - first), int(distance[k])))
    for doc, item, begin, end in index.short_passages(text, bounds):
        first = places[begin] - offsets[doc]
        found.add((doc, item, int(first), int(places[end - 1] + 1 - offsets[doc] - first), 0))
    return sorted(found)


def item_blocks(items: DataFrame, limit: int = ITEM_BYTES) -> Iterator[ItemIndex]:
    """Indexes over all items, each over at most about ``limit`` bytes of them; one at a time is held.

    Items without an id, and without text but white space, are left out.
    """
    usable = items.select(F.col("item_id").cast("long").alias("item_id"), "text").filter(
        F.col("item_id").isNotNull() & F.col("text").isNotNull()
    )
    total = usable.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    many = max(1, -(-total // limit))
    for block in range(many):
        rows = usable.filter(F.pmod(F.xxhash64("item_id"), F.lit(many)) == block).orderBy("item_id", "text").collect()
        if rows:
            yield ItemIndex.of([x.item_id for x in rows], [x.text for x in rows])


def stored_blocks(items: DataFrame) -> list[str]:
    """The files of all indexes below the shared folder, from which tasks load them one at a time."""
    folder, files = fresh_dir(items.sparkSession, "items"), []
    for index in item_blocks(items, ITEM_BYTES):
        files.append(f"{folder}/block-{len(files)}")
        write_file(files[-1], [pickle.dumps(index)])
    return files


@lru_cache(maxsize=1)
def load_index(file: str) -> ItemIndex:
    return pickle.loads(read_file(file))


PASSAGE_DDL = "doc_id long, item_id long, start long, length long, distance int, budget int"


def benchmark_passages(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row per document, item and passage: ``doc_id item_id start length distance budget``.

    A passage is a whole item within its budget: 6 of 100 bytes, none for items of fewer than 20.
    Every whole text is scanned once for each block of items, without a shuffle.
    Clean documents, and null or empty texts, give no row; repeated rows give
    theirs each.  Without items nothing is found.
    """
    found = docs.sparkSession.createDataFrame([], PASSAGE_DDL)
    for spot, file in enumerate(stored_blocks(items)):

        def run(batches: Iterator[pa.RecordBatch], file=file) -> Iterator[pa.RecordBatch]:
            index = load_index(file)
            for batch in grouped(batches, SCAN_BYTES):
                rows = find_passages(index, *column_bytes(batch["text"]))
                ids = batch["doc_id"]
                columns = [np.array([x[k] for x in rows], np.int64) for k in range(5)]
                yield pa.RecordBatch.from_arrays([
                    ids.take(pa.array(columns[0])), pa.array(index.ids[columns[1]]), pa.array(columns[2]),
                    pa.array(columns[3]), pa.array(columns[4].astype(np.int32)),
                    pa.array(index.edits[columns[1]].astype(np.int32)),
                ], ["doc_id", "item_id", "start", "length", "distance", "budget"])

        part = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PASSAGE_DDL)
        found = found.unionByName(part) if spot else part
    return found


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents without a passage of any item, with all their columns."""
    schema, names = nullable(docs.schema), docs.columns
    for file in stored_blocks(items):

        def run(batches: Iterator[pa.RecordBatch], file=file) -> Iterator[pa.RecordBatch]:
            index = load_index(file)
            for batch in grouped(batches, SCAN_BYTES):
                keep = np.ones(batch.num_rows, bool)
                keep[[x[0] for x in find_passages(index, *column_bytes(batch["text"]))]] = False
                yield batch.filter(pa.array(keep)).select(names)

        docs = docs.mapInArrow(run, schema)
    return docs


def op1_decontamination(spark, docs: DataFrame, items: DataFrame) -> DataFrame:
    """All passages of the benchmark in all documents."""
    return benchmark_passages(docs, items)
