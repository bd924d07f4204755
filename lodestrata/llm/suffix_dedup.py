"""Removal of repeated passages: bytes covered by a string of 100 bytes that also starts earlier.

Each window of 100 bytes is named by its least gram (of ``K`` bytes, by hash), a
choice that depends on the window alone; the windows that share one such anchor
in a text form a context.  Equal windows have equal anchors, so:

1. contexts are grouped by their anchor.  Equal contexts of a group are combined:
   all but the first are repeats as a whole;
2. where a group holds several different contexts, their texts go to one task,
   which splits them into shards, builds the Burrows-Wheeler transform of each, merges
   the transforms by refining their interleave, and takes the intervals of
   suffixes with 100 bytes in common: all but the first window of each are repeats;
3. a group with more than ``MOST_CONTEXTS`` different contexts is not collected: its
   windows are compared by their digests in a plain aggregate instead.

The spans of both are joined to the texts again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.llm.bwt import GRAM, chains_of, gram_hashes, merged_order
from lodestrata.llm.common import bounded, column_bytes, joined, nullable, spare_name, stored
from lodestrata.llm.tokens import word_hashes

MATCH = 100                 # bytes of a match; a multiple of the gram of the transforms
K = 32                      # bytes of an anchor
BATCH_BYTES = 2 << 20       # bytes of texts among which copies are known at once
SCAN_BYTES = 1 << 20        # bytes of texts in work at once
CHUNK_BYTES = 1 << 19       # bytes of contexts whose transforms are merged at once
SHARDS = 2
MOST_CONTEXTS = 10_000      # different contexts of one anchor that are collected


def window_contexts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Contexts of texts: anchor, text, first window's place in all bytes, number of windows."""
    grams = gram_hashes(data, K)
    span = MATCH - K + 1
    if len(grams) < span:
        return tuple(np.zeros(0, t) for t in (np.uint64, np.int64, np.int64, np.int64))
    # Of equal keys the leftmost is least, as the place is in the low half.
    least = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    size = 1
    while 2 * size <= span:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < span:
        least = np.minimum(least[: size - span], least[span - size:])
    anchor = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    # Windows that lie within a text.
    inside = np.zeros(len(anchor) + 1, np.int64)
    length = np.diff(offsets)
    fits = length >= MATCH
    np.add.at(inside, offsets[:-1][fits], 1)
    np.add.at(inside, offsets[1:][fits] - MATCH + 1, -1)
    inside = np.cumsum(inside[:-1]) > 0
    new = inside.copy()
    new[1:] &= (anchor[1:] != anchor[:-1]) | ~inside[:-1]
    starts = offsets[:-1][fits]
    new[starts] = True
    first = np.flatnonzero(new)
    total = np.concatenate([[0], np.cumsum(inside)])
    number = np.diff(total[np.append(first, len(anchor))])
    text = np.searchsorted(offsets, first, "right") - 1
    return grams[anchor[first]], text, first, number


def contexts_of(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, ...]:
    """As ``window_contexts``, which takes some sixty times the bytes, over texts of about ``size`` bytes at a time."""
    cuts = np.flatnonzero(np.diff(offsets[:-1] // size, prepend=-1)).tolist() or [0]
    parts = []
    for low, high in zip(cuts, [*cuts[1:], len(offsets) - 1]):
        begin = offsets[low]
        anchor, text, first, number = window_contexts(data[begin: offsets[high]], offsets[low: high + 1] - begin)
        parts.append((anchor, text + low, first + begin, number))
    return tuple(np.concatenate(x) for x in zip(*parts))


CONTEXT_DDL = "anchor long, digest long, doc_id long, start int, windows int"


def contexts(docs: DataFrame) -> DataFrame:
    """All contexts of all texts.

    What repeats within a batch is known at once and needs no comparing: copies of a text
    as a whole, and runs of contexts that are equal to earlier ones, give one row each
    (digest null, dealt by document).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in joined(batches, BATCH_BYTES):
            data, offsets = column_bytes(batch["text"])
            ids = batch["doc_id"].to_numpy()
            whole = word_hashes(data, offsets[:-1], offsets[1:])
            # The first of equal texts is the one with the least id; rows that
            # repeat an id with its text are one document.
            order = np.lexsort((ids, whole))
            copy = np.zeros(len(ids), bool)
            same = whole[order][1:] == whole[order][:-1]
            copy[order[1:]] = same
            lead = np.empty(len(ids), np.int64)
            if len(ids):
                starts = np.maximum.accumulate(np.where(np.append(True, ~same), np.arange(len(ids)), 0))
                lead[order] = ids[order][starts]
            repeats = copy & (lead != ids) & (np.diff(offsets) >= MATCH)
            anchor, text, first, number = contexts_of(data, offsets, SCAN_BYTES)
            kept = ~copy[text]
            anchor, text, first, number = anchor[kept], text[kept], first[kept], number[kept]
            digest = word_hashes(data, first, first + number + MATCH - 1)
            start = first - offsets[text]
            order = np.lexsort((start, ids[text], digest, anchor))
            new = np.ones(len(order), bool)
            new[1:] = (digest[order][1:] != digest[order][:-1]) | (anchor[order][1:] != anchor[order][:-1])
            again = np.zeros(len(order), bool)
            again[order] = ~new
            # Contexts of a text follow one another, so a run of repeats is one span.
            at = np.flatnonzero(again)
            begins = np.ones(len(at), bool)
            begins[1:] = (np.diff(at) > 1) | (text[at][1:] != text[at][:-1])
            begins = np.flatnonzero(begins)
            windows = np.add.reduceat(number[at], begins) if len(at) else at
            lead = at[begins]
            whole = np.flatnonzero(repeats)
            spans = [
                (ids[text[lead]], start[lead], windows),
                (ids[whole], np.zeros(len(whole), np.int64), np.diff(offsets)[whole] - MATCH + 1),
            ]
            names = ["anchor", "digest", "doc_id", "start", "windows"]
            fresh = ~again
            yield pa.RecordBatch.from_arrays([
                pa.array(anchor[fresh].view(np.int64)), pa.array(digest[fresh].view(np.int64)),
                pa.array(ids[text[fresh]]), pa.array(start[fresh].astype(np.int32)),
                pa.array(number[fresh].astype(np.int32)),
            ], names)
            for doc, begin, size in spans:
                yield pa.RecordBatch.from_arrays([
                    pa.array(doc), pa.nulls(len(doc), pa.int64()), pa.array(doc),
                    pa.array(begin.astype(np.int32)), pa.array(size.astype(np.int32)),
                ], names)

    return docs.mapInArrow(run, CONTEXT_DDL)


def sort_out(rows: DataFrame) -> DataFrame:
    """Contexts that are repeats as a whole (``repeat``), and those to be compared with others.

    Groups stream through in order of anchor, digest, id and place; what is held is one row.
    """
    names = ["anchor", "digest", "doc_id", "start", "windows"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None        # the last context that was new, and whether its group has another
        alone = True
        last = None        # anchor and digest of the last row

        def out(columns, repeat: bool) -> pa.RecordBatch:
            columns = [pa.array(c) for c in columns]
            return pa.RecordBatch.from_arrays(
                [*columns, pa.array(np.full(len(columns[0]), repeat))], [*names, "repeat"]
            )

        for batch in bounded(batches, SCAN_BYTES):
            none = batch["digest"].is_null().to_numpy(zero_copy_only=False)
            columns = [batch[x].fill_null(0).to_numpy() for x in names]
            if none.any():
                yield out([c[none] for c in columns], True)
                columns = [c[~none] for c in columns]
            anchor, digest = columns[:2]
            if not len(anchor):
                continue
            new = np.ones(len(anchor), bool)
            new[1:] = (anchor[1:] != anchor[:-1]) | (digest[1:] != digest[:-1])
            if last == (anchor[0], digest[0]):
                new[0] = False
            last = (anchor[-1], digest[-1])
            yield out([c[~new] for c in columns], True)
            # Different contexts: whether a neighbour has the same anchor.
            distinct = [c[new] for c in columns]
            if held is not None:
                distinct = [np.concatenate([[h], c]).astype(c.dtype) for h, c in zip(held, distinct)]
            if not len(distinct[0]):
                continue
            same = distinct[0][1:] == distinct[0][:-1]
            before = np.append(held is not None and not alone, same)
            yield out([c[:-1][before[:-1] | same] for c in distinct], False)
            held, alone = [c[-1] for c in distinct], not before[-1]
        if held is not None and not alone:
            yield out([np.array([h]) for h in held], False)

    ordered = rows.repartition(F.col("anchor")).sortWithinPartitions("anchor", "digest", "doc_id", "start")
    return stored(ordered.mapInArrow(run, CONTEXT_DDL + ", repeat boolean"), "contexts")


def repeated_windows(data: np.ndarray, offsets: np.ndarray, shards: int = SHARDS) -> tuple[np.ndarray, np.ndarray]:
    """String and place of each window of ``MATCH`` bytes that an earlier string or place also has."""
    chains = chains_of(data, offsets)
    order, common = merged_order(chains, len(offsets) - 1, shards, MATCH // GRAM)
    # An interval of suffixes with all of a match in common is one window.
    border = common < MATCH // GRAM
    first = np.minimum.reduceat(order, np.flatnonzero(border))[np.cumsum(border) - 1]
    later = np.sort(order[order > first])
    return chains.string[later], chains.place[later]


def compared(found: DataFrame, texts: DataFrame, limit: int = MOST_CONTEXTS) -> DataFrame:
    """Spans ``doc_id start length`` of repeats among different contexts of one anchor."""
    several = found.filter("not repeat").select("anchor", "doc_id", "start", "windows")
    crowded = several.groupBy("anchor").count().filter(F.col("count") > limit).select(
        "anchor", F.lit(True).alias("crowded"))
    marked = several.join(crowded, "anchor", "left")
    places = marked.groupBy("doc_id").agg(F.collect_list(
        F.struct("anchor", "start", "windows", F.coalesce("crowded", F.lit(False)).alias("crowded"))
    ).alias("places"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, SCAN_BYTES):
            data, offsets = column_bytes(batch["text"])
            raw, flat = data.tobytes(), batch["places"].flatten()
            text = np.repeat(np.arange(batch.num_rows), np.diff(batch["places"].offsets.to_numpy()))
            start = flat.field("start").to_numpy()
            begin = offsets[text] + start
            end = begin + flat.field("windows").to_numpy() + MATCH - 1
            # A text that another row gives the same id may be shorter.
            fits = pa.array(end <= offsets[text + 1])
            parts = [raw[b:e] for b, e in zip(begin.tolist(), end.tolist())]
            yield pa.RecordBatch.from_arrays([
                flat.field("anchor"), batch["doc_id"].take(pa.array(text)), flat.field("start"),
                pa.array(parts, pa.binary()), flat.field("crowded"),
            ], ["anchor", "doc_id", "start", "part", "crowded"]).filter(fits)

    parts = texts.join(places, "doc_id").select("doc_id", "text", "places").mapInArrow(
        cut, "anchor long, doc_id long, start int, part binary, crowded boolean"
    )

    def spans(ids, starts, strings, places) -> pa.RecordBatch:
        """Runs of repeated windows, each as the bytes it covers."""
        new = np.ones(len(strings), bool)
        new[1:] = (strings[1:] != strings[:-1]) | (places[1:] != places[:-1] + 1)
        first = np.flatnonzero(new)
        number = np.diff(np.append(first, len(strings)))
        string = strings[first]
        return pa.RecordBatch.from_arrays([
            pa.array(ids[string]), pa.array((starts[string] + places[first]).astype(np.int32)),
            pa.array((number + MATCH - 1).astype(np.int32)),
        ], ["doc_id", "start", "length"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, last = [], 0, None

        def flush() -> pa.RecordBatch:
            table = pa.concat_batches(held)
            data, offsets = column_bytes(table["part"])
            return spans(
                table["doc_id"].to_numpy(), table["start"].to_numpy(), *repeated_windows(data, offsets)
            )

        for batch in bounded(batches, SCAN_BYTES):
            if not batch.num_rows:
                continue
            anchors = batch["anchor"].to_numpy()
            if size >= CHUNK_BYTES:
                # Close the chunk where its last group ends.
                same = np.flatnonzero(anchors != last)
                stop = int(same[0]) if len(same) else len(anchors)
                held.append(batch.slice(0, stop))
                batch, anchors = batch.slice(stop), anchors[stop:]
                if len(anchors):
                    yield flush()
                    held, size = [], 0
            if len(anchors):
                held.append(batch)
                size += batch.nbytes
                last = anchors[-1]
        if held:
            yield flush()

    span_ddl = "doc_id long, start int, length int"
    usual = parts.filter("not crowded").select("anchor", "doc_id", "start", "part")
    merged = usual.repartition(F.col("anchor")).sortWithinPartitions("anchor", "doc_id", "start").mapInArrow(
        merge, span_ddl
    )

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, SCAN_BYTES):
            data, offsets = column_bytes(batch["part"])
            number = np.diff(offsets) - MATCH + 1
            row = np.repeat(np.arange(len(number)), number)
            place = np.arange(len(row)) - np.repeat(np.cumsum(number) - number, number)
            begin = offsets[row] + place
            yield pa.RecordBatch.from_arrays([
                pa.array(gram_hashes(data, MATCH)[begin].view(np.int64)),
                pa.array(word_hashes(data, begin, begin + MATCH).view(np.int64)),
                batch["doc_id"].take(pa.array(row)),
                pa.array((batch["start"].to_numpy()[row] + place).astype(np.int32)),
            ], ["w1", "w2", "doc_id", "start"])

    one = parts.filter("crowded").select("doc_id", "start", "part").mapInArrow(
        windows, "w1 long, w2 long, doc_id long, start int"
    )
    firsts = one.groupBy("w1", "w2").agg(F.min(F.struct("doc_id", "start")).alias("first"))
    split = one.join(firsts, ["w1", "w2"]).filter(
        F.struct("doc_id", "start") > F.col("first")
    ).select("doc_id", "start", F.lit(MATCH).alias("length"))
    return merged.unionByName(split)


def repeat_spans(texts: DataFrame, limit: int = MOST_CONTEXTS) -> DataFrame:
    """``doc_id spans``: for each document with repeats, arrays of their start and length (may overlap)."""
    found = sort_out(contexts(texts))
    whole = found.filter("repeat").select(
        "doc_id", "start", (F.col("windows") + MATCH - 1).alias("length")
    )
    every = whole.unionByName(compared(found, texts, limit))
    return every.groupBy("doc_id").agg(F.collect_list(F.struct("start", "length")).alias("spans"))


def runs_by_text(spans: pa.ListArray) -> Iterator[list[tuple[int, int]]]:
    """For each text, the maximal runs of covered bytes as (begin, end)."""
    number = np.diff(spans.offsets.to_numpy())
    number[spans.is_null().to_numpy(zero_copy_only=False)] = 0
    flat = spans.flatten()
    if not len(flat):
        yield from ([] for _ in number)
        return
    text = np.repeat(np.arange(len(number)), number)
    start = flat.field("start").to_numpy().astype(np.int64)
    end = start + flat.field("length").to_numpy()
    order = np.lexsort((start, text))
    # Texts lie far apart on one line, so that runs never join across them.
    far = int(end.max()) + 1
    start, end = start[order] + text[order] * far, end[order] + text[order] * far
    reach = np.maximum.accumulate(end)
    new = np.ones(len(start), bool)
    new[1:] = start[1:] > reach[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    of = start[first] // far
    begins, ends = (start[first] - of * far).tolist(), (reach[last] - of * far).tolist()
    bounds = np.searchsorted(of, np.arange(len(number) + 1)).tolist()
    for low, high in zip(bounds[:-1], bounds[1:]):
        yield list(zip(begins[low:high], ends[low:high]))


def known_texts(docs: DataFrame) -> DataFrame:
    """Rows that take part: those with an id."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("doc_id is not null")


def repeat_digests(docs: DataFrame, limit: int = MOST_CONTEXTS) -> DataFrame:
    """``doc_id n_bytes n_removed n_spans kept_sha256`` of every document.

    Null text is empty.  A row without an id takes no part: nothing of it is removed and
    nothing is removed because of it.  Rows that repeat an id with the same text
    are one document and get the same result; if the texts differ, spans of any of them
    apply to all, as far as they reach.
    """
    texts = known_texts(docs)
    joined = texts.join(repeat_spans(texts, limit), "doc_id", "left").select("doc_id", "text", "spans")
    nameless = docs.filter("doc_id is null").select(
        F.lit(None).cast("long").alias("doc_id"), "text",
        F.lit(None).cast("array<struct<start:int,length:int>>").alias("spans"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, SCAN_BYTES):
            sizes, removed, number, digests = [], [], [], []
            for text, runs in zip(batch["text"], runs_by_text(batch["spans"])):
                raw = text.as_buffer() if text.is_valid else pa.py_buffer(b"")
                runs = [(begin, min(end, raw.size)) for begin, end in runs if begin < raw.size]
                digest, at, view = hashlib.sha256(), 0, memoryview(raw)
                for begin, end in runs:
                    digest.update(view[at:begin])
                    at = end
                digest.update(view[at:])
                sizes.append(raw.size)
                removed.append(sum(e - b for b, e in runs))
                number.append(len(runs))
                digests.append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays([
                batch["doc_id"], pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()),
                pa.array(number, pa.int64()), pa.array(digests, pa.string()),
            ], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return joined.unionByName(nameless).mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )


def without_repeats(docs: DataFrame) -> DataFrame:
    """The documents with repeated passages taken out of ``text``, and ``n_chars`` of those set anew.

    Of a character only part of which is covered all is kept, so texts stay valid.  A
    document of which nothing is left is dropped; one that was empty stays.
    """
    texts = known_texts(docs)
    key, cover = spare_name(docs, "_id"), spare_name(docs, "_spans")
    spans = repeat_spans(texts).select(F.col("doc_id").alias(key), F.col("spans").alias(cover))
    joined = docs.join(spans, F.col("doc_id") == F.col(key), "left").drop(key)
    names, schema = docs.columns, nullable(docs.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, SCAN_BYTES):
            kept, keep, sizes = [], [], []
            before = batch["n_chars"].to_pylist() if "n_chars" in names else [None] * batch.num_rows
            for text, runs, size in zip(batch["text"], runs_by_text(batch[cover]), before):
                if not runs or not text.is_valid:
                    kept.append(text.as_py())
                    keep.append(True)
                    sizes.append(size)
                    continue
                raw = text.as_buffer().to_pybytes()
                parts, at = [], 0
                for begin, end in runs:
                    end = min(end, len(raw))
                    while begin < end and raw[begin] & 0xC0 == 0x80:
                        begin += 1
                    while end < len(raw) and end > begin and raw[end] & 0xC0 == 0x80:
                        end -= 1
                    parts.append(raw[at:begin])
                    at = end
                left = (b"".join(parts) + raw[at:]).decode("utf-8", "replace")
                kept.append(left)
                keep.append(bool(left))
                sizes.append(len(left))
            columns = []
            for name in names:
                if name == "text":
                    columns.append(pa.array(kept, batch["text"].type))
                elif name == "n_chars":
                    columns.append(pa.array(sizes, batch["n_chars"].type))
                else:
                    columns.append(batch[name])
            yield pa.RecordBatch.from_arrays(columns, names).filter(pa.array(keep, pa.bool_()))

    return joined.mapInArrow(run, schema)


def op3_suffix_dedup(spark, docs: DataFrame) -> DataFrame:
    """Repeated strings of 100 bytes over all documents."""
    return repeat_digests(docs)


# Bytes as hexadecimal text; a window is repeated if it isn't the first of its kind.
OP3_SQL = """
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), w AS (
  SELECT doc_id, j, substr(h, 2 * j - 1, 200) AS bytes
  FROM (SELECT doc_id, h, unnest(range(1, length(h) // 2 - 98)) AS j FROM d)
), f AS (
  SELECT bytes, min(struct_pack(doc_id := doc_id, j := j)) AS first FROM w GROUP BY bytes HAVING count(*) > 1
), r AS (
  SELECT w.doc_id, w.j FROM w JOIN f ON w.bytes = f.bytes
  WHERE struct_pack(doc_id := w.doc_id, j := w.j) > f.first
), g AS (
  SELECT doc_id, j, sum(apart) OVER (PARTITION BY doc_id ORDER BY j) AS run
  FROM (SELECT doc_id, j, (j > coalesce(lag(j) OVER (PARTITION BY doc_id ORDER BY j), -1000) + 100)::int AS apart FROM r)
), spans AS (
  SELECT doc_id, min(j) AS b, max(j) + 99 AS e FROM g GROUP BY doc_id, run
), cuts AS (
  SELECT doc_id, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY b), 0) + 1 AS b, b - 1 AS e FROM spans
  UNION ALL
  SELECT d.doc_id, coalesce(max(spans.e), 0) + 1, any_value(length(d.h)) // 2
  FROM d LEFT JOIN spans ON spans.doc_id = d.doc_id GROUP BY d.doc_id
), kept AS (
  SELECT d.doc_id, string_agg(CASE WHEN c.e >= c.b THEN substr(d.h, 2 * c.b - 1, 2 * (c.e - c.b + 1)) ELSE '' END, ''
    ORDER BY c.b) AS h
  FROM d JOIN cuts AS c ON c.doc_id = d.doc_id GROUP BY d.doc_id
), sums AS (
  SELECT doc_id, sum(e - b + 1) AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id
)
SELECT d.doc_id, length(d.h) // 2 AS n_bytes, cast(coalesce(s.n_removed, 0) AS bigint) AS n_removed,
  coalesce(s.n_spans, 0) AS n_spans, sha256(unhex(kept.h)) AS kept_sha256
FROM d JOIN kept ON kept.doc_id = d.doc_id LEFT JOIN sums AS s ON s.doc_id = d.doc_id
"""
