"""Language identification with bit-sliced Bloom filters of n-grams.

One filter serves all languages: each cell is a mask with a bit per language,
and an n-gram's cells, combined by ``and``, give the mask of all languages that
contain it.  A text's masks are counted bit by bit; a language's share of hits
is corrected for the false positives that the filter's filling predicts, and
the language with the greatest corrected share is chosen.

Every n-gram of the sample is entered.  Corpora hold passages of other languages, so the more text is
learned the more languages share an n-gram; six bytes and a sample of a thousand rows keep
the shares apart.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.llm.common import column_bytes

GRAM = 6               # bytes of an n-gram
CELL_BITS = 20         # the filter has 2 ** CELL_BITS cells
HASHES = 3
SAMPLE_ROWS = 1_000    # labelled rows per language that are learned from, at most (about)
MULTIPLIERS = np.array([2654435761, 2246822519, 3266489917], np.uint32)
MIX = np.uint64(0x9E3779B97F4A7C15)
SPACE = 32

# Letters keep their byte (A-Z in lower case), all other signs become a space.
FOLD = np.full(256, SPACE, np.uint8)
FOLD[97:123] = FOLD[65:91] = np.arange(97, 123)
FOLD[128:] = np.arange(128, 256)


def grams_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All n-grams of texts, mixed to 32-bit numbers, and the number of them in each text.

    Runs of other signs count as one space; a text begins and ends with a space.
    """
    n = len(offsets) - 1
    # A space after each text separates it from the next.
    room = np.full(len(data) + n + 1, SPACE, np.uint8)
    text = np.repeat(np.arange(n), np.diff(offsets))
    room[np.arange(len(data)) + text + 1] = FOLD[data]
    of = np.empty(len(room), np.int64)
    of[np.arange(len(data)) + text + 1] = text
    of[0] = 0
    of[offsets[1:] + np.arange(1, n + 1)] = np.arange(n)
    keep = np.ones(len(room), bool)
    keep[1:] = (room[1:] != SPACE) | (room[:-1] != SPACE)
    room, of = room[keep], of[keep]
    if len(room) < GRAM:
        return np.zeros(0, np.uint32), np.zeros(n, np.int64)
    size = len(room) - GRAM + 1
    grams = np.zeros(size, np.uint64)
    for spot in range(GRAM):
        grams |= room[spot: size + spot].astype(np.uint64) << np.uint64(8 * spot)
    grams = (grams * MIX >> np.uint64(32)).astype(np.uint32)
    # A text's n-grams end with it, and may begin with the space before it.
    inside = of[1: size + 1] == of[GRAM - 1:]
    return grams[inside], np.bincount(of[GRAM - 1:][inside], minlength=n)


def cells_of(grams: np.ndarray, bits: int, hashes: int) -> list[np.ndarray]:
    return [(grams * MULTIPLIERS[i] ^ (grams >> np.uint32(15)) * MULTIPLIERS[i - 1]) >> np.uint32(32 - bits)
            for i in range(hashes)]


@dataclass
class LanguageFilter:
    """Cells (one row of masks for each 64 languages) and what the filling predicts."""

    languages: list[str]
    cells: np.ndarray       # uint64, (words, 2 ** bits)
    false_rate: np.ndarray  # by language
    bits: int
    hashes: int
    common: str             # the language learned from most rows

    def shares(self, grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Corrected share of each text's n-grams that are in each language."""
        found = np.zeros((len(counts), len(self.languages)))
        spots = cells_of(grams, self.bits, self.hashes)
        ends = np.cumsum(counts)
        for word in range(len(self.cells)):
            mask = self.cells[word][spots[0]]
            for spot in spots[1:]:
                mask = mask & self.cells[word][spot]
            for bit in range(min(64, len(self.languages) - 64 * word)):
                hit = ((mask >> np.uint64(bit)) & np.uint64(1)).astype(np.uint8)
                sums = np.concatenate([[0], np.cumsum(hit, dtype=np.int64)])
                found[:, 64 * word + bit] = sums[ends] - sums[ends - counts]
        share = found / np.maximum(counts, 1)[:, None]
        return np.clip((share - self.false_rate) / (1 - self.false_rate), 0, 1)


def learn_filter(
    docs: DataFrame, rows: int = SAMPLE_ROWS, folds: int = 4, held_out: int = 2,
    bits: int = CELL_BITS, hashes: int = HASHES,
) -> LanguageFilter | None:
    """Learn from text and language of a bounded sample of rows outside the held-out fold.

    Rows are chosen by a hash of their id at a rate by language, about ``rows`` for each.
    The filter has a fixed number of cells, so what is sent to the tasks has a
    bound.  None if there is no row to learn from.
    """
    fit = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang").filter(
        F.col("text").isNotNull() & F.col("lang").isNotNull()
        & (F.crc32(F.col("doc_id").cast("string")) % folds != held_out)
    )
    numbers = {x.lang: x["count"] for x in fit.groupBy("lang").count().collect()}
    if not numbers:
        return None
    languages = sorted(numbers)
    rates = F.create_map(*[
        F.lit(x) for lang in languages for x in (lang, int(min(1.0, rows / numbers[lang]) * (1 << 30)))
    ])
    sample = fit.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < rates[F.col("lang")])
    spot = {x: i for i, x in enumerate(languages)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = column_bytes(batch["text"])
            grams, counts = grams_of(data, offsets)
            of = np.array([spot[x] for x in batch["lang"].to_pylist()], np.uint64)
            both = (np.repeat(of, counts) << np.uint64(32)) | grams
            both = np.unique(both)
            yield pa.RecordBatch.from_arrays(
                [pa.array((both >> np.uint64(32)).astype(np.int32)),
                 pa.array((both & np.uint64(0xFFFFFFFF)).astype(np.int64))],
                ["language", "gram"],
            )

    own = sample.select("text", "lang").mapInArrow(count, "language int, gram long").distinct()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams = batch["gram"].to_numpy().astype(np.uint32)
            language = batch["language"].to_numpy()
            for cells in cells_of(grams, bits, hashes):
                yield pa.RecordBatch.from_arrays(
                    [pa.array((language // 64).astype(np.int32)), pa.array(cells.astype(np.int32)),
                     pa.array((np.uint64(1) << (language % 64).astype(np.uint64)).view(np.int64))],
                    ["word", "cell", "mask"],
                )

    placed = own.select("gram", "language").mapInArrow(place, "word int, cell int, mask long")
    got = placed.groupBy("word", "cell").agg(F.expr("bit_or(mask)").alias("mask")).toArrow()
    cells = np.zeros((-(-len(languages) // 64), 1 << bits), np.uint64)
    cells[got["word"].to_numpy(), got["cell"].to_numpy()] = got["mask"].to_numpy().view(np.uint64)
    filling = np.array([
        float(((cells[i // 64] >> np.uint64(i % 64)) & np.uint64(1)).mean()) for i in range(len(languages))
    ])
    common = min(numbers, key=lambda x: (-numbers[x], x))
    return LanguageFilter(languages, cells, np.minimum(filling**hashes, 0.99), bits, hashes, common)


def identify(docs: DataFrame, model: LanguageFilter | None) -> DataFrame:
    """``doc_id lang_pred score`` of every whole text.

    ``und`` with score 0 where a text is null or has no letter, and where nothing was
    learned; a text whose n-grams are in no language gets the most common
    language with score 0.  Equal shares go to the language that sorts first.
    The score is the language's part of all corrected shares.
    """
    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", lettered.alias("lettered"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            best, score = ["und"] * n, np.zeros(n)
            if model is not None:
                grams, counts = grams_of(*column_bytes(batch["text"]))
                shares = model.shares(grams, counts)
                first, total = shares.argmax(axis=1), shares.sum(axis=1)
                score = np.where(total > 0, shares.max(axis=1) / np.maximum(total, 1e-300), 0.0)
                lettered = batch["lettered"].to_pylist()
                score = np.where(lettered, score, 0.0)
                best = [
                    "und" if not ok else model.languages[i] if t > 0 else model.common
                    for ok, i, t in zip(lettered, first, total)
                ]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(best, pa.string()), pa.array(score)],
                ["doc_id", "lang_pred", "score"],
            )

    return known.mapInArrow(run, "doc_id long, lang_pred string, score double")


def op10_language_id(spark, docs: DataFrame) -> DataFrame:
    """Languages of all documents; learned outside fold 2 of 4."""
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(True))
    return identify(docs, learn_filter(docs)).select(
        "doc_id", held.alias("held_out"), "lang_pred", "score"
    )
