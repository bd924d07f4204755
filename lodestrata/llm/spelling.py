"""Spelling variants: words that differ by one sign, found through pairs of trie nodes.

Two words differ by one replaced sign exactly if, the sign at one place skipped, what is before
and what is behind are the same; they differ by one inserted sign exactly if one of them,
a sign skipped, is the other cut in two at that place.  What is before is a node of
the trie of all words, what is behind a node of the trie of all words read backwards, so each is
an integer, and a place of a word is a pair of integers whatever its length.

1. The words are counted in one pass over the texts.
2. They are dealt by ranges in order, so each task holds one stretch of the trie and numbers its nodes
   while the words stream by; the node in which two stretches meet gets the number it has in the
   first of them.  The same for the reversed words.
3. Each word gives a pair for every skipped place, and one for every cut.  The words of one pair differ in
   one sign, so there are no more of them than letters; each takes from its
   group how many others are near and which is most frequent, and no pair of words is ever written.
4. The most frequent near word, if at least twice as frequent, is the form of a word; roots
   follow by doubling the steps.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.llm.common import column_bytes, grouped, stored
from lodestrata.llm.tokens import LETTER, LOWER

SLIP = 97                   # one of so many words of a text loses a sign
LEAST_SIGNS, LEAST_COUNT = 5, 3
RATIO = 2                   # a form is so many times as frequent as its variant
SCAN_BYTES = 4 << 20
LONG = 64                   # bytes from which a word's checksum is taken on its own
LEAD = 0xC3                 # first byte of U+00C0 to U+00FF


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


CRC = _crc_table()


def letter_runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of A-Z, a-z and U+00C0 to U+00FF begin and end; none crosses from one text to the next."""
    lead = data == LEAD
    letter = LETTER[data] | lead
    letter[1:] |= lead[:-1]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    begin, end = letter.copy(), letter.copy()
    begin[1:] &= ~letter[:-1] | first[1:-1]
    end[:-1] &= ~letter[1:] | first[1:-1]
    return np.flatnonzero(begin), np.flatnonzero(end) + 1


def checksums(data: np.ndarray, begins: np.ndarray, ends: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """CRC-32 of byte ranges, each going on from a checksum of what comes before it."""
    found = seeds.astype(np.uint32) ^ np.uint32(0xFFFFFFFF)
    size = ends - begins
    order = np.argsort(-size, kind="stable")
    long = int(np.count_nonzero(size > LONG))
    state, at = found[order], begins[order]
    reach = np.searchsorted(-size[order], -np.arange(LONG + 1), "left")
    for k in range(min(LONG, int(size.max(initial=0)))):
        rest = slice(long, int(reach[k]))
        part = state[rest]
        state[rest] = CRC[(part ^ data[at[rest] + k]) & np.uint32(0xFF)] ^ (part >> np.uint32(8))
    state ^= np.uint32(0xFFFFFFFF)
    raw = memoryview(data)
    for i in range(long):
        w = order[i]
        state[i] = zlib.crc32(raw[begins[w]: ends[w]], int(seeds[w]))
    found[order] = state
    return found


def word_counts(docs: DataFrame) -> DataFrame:
    """``word n`` of all words of all texts, a sign lost where the checksum says so.

    Words of fewer than ``LEAST_SIGNS`` signs, and rarer ones than ``LEAST_COUNT``, are left out.
    Counted per batch, then per task, then over all.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in grouped(batches, SCAN_BYTES):
            data, offsets = column_bytes(batch["text"])
            data = LOWER[data]
            begins, ends = letter_runs(data, offsets)
            # Signs of two bytes count once.
            leads = np.concatenate([[0], np.cumsum(data == LEAD)])
            signs = ends - begins - (leads[ends] - leads[begins])
            enough = signs >= LEAST_SIGNS
            begins, ends, signs = begins[enough], ends[enough], signs[enough]
            seeds = np.array(
                [zlib.crc32(f"{x if x is not None else ''}:".encode()) for x in batch["doc_id"].to_pylist()], np.uint32
            )
            sums = checksums(data, begins, ends, seeds[np.searchsorted(offsets, begins, "right") - 1])
            slips = sums % SLIP == 0
            size = ends - begins
            kept = ~slips
            stops = np.concatenate([[0], np.cumsum(size[kept])])
            spots = np.repeat(begins[kept] - stops[:-1], size[kept]) + np.arange(stops[-1])
            words = pa.Array.from_buffers(pa.large_string(), len(stops) - 1, [
                None, pa.py_buffer(stops.astype(np.int64).tobytes()), pa.py_buffer(data[spots].tobytes())
            ])
            raw, short = memoryview(data), []
            for begin, end, total, h in zip(
                begins[slips].tolist(), ends[slips].tolist(), signs[slips].tolist(), sums[slips].tolist()
            ):
                if total > LEAST_SIGNS:
                    word, gone = str(raw[begin:end], "utf-8"), h % total
                    short.append(word[:gone] + word[gone + 1:])
            counts = pa.chunked_array([words, pa.array(short, pa.large_string())]).value_counts()
            yield pa.RecordBatch.from_arrays(
                [counts.field("values").cast(pa.string()), counts.field("counts")], ["word", "n"]
            )

    rows = docs.select("doc_id", "text").filter("text is not null").mapInArrow(run, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_COUNT)


def _one_byte(column) -> tuple[np.ndarray, np.ndarray]:
    """Signs of words as one byte each: all are below U+0100."""
    data, offsets = column_bytes(column)
    keep = data != LEAD
    sign = np.where(data >= 128, data | 0x40, data)[keep]
    return sign, np.concatenate([[0], np.cumsum(keep)])[offsets]


class TrieNumbers:
    """Numbers of the trie nodes of words that come in order: from 0 on, as nodes are first met."""

    def __init__(self):
        self.total = 0
        self.last = np.zeros(0, np.uint8), np.zeros(0, np.int64)

    def of(self, sign: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """For each sign of each word the node reached by it."""
        # The last word of the batch before stands in front, its nodes known.
        held, known = self.last
        sign = np.concatenate([held, sign])
        offsets = np.concatenate([[0], offsets + len(held)])
        size = np.diff(offsets)
        row = np.repeat(np.arange(len(size)), size)
        depth = np.arange(len(sign)) - offsets[row]
        # What a word has in common with the one before it.
        above = offsets[np.maximum(row - 1, 0)] + depth
        same = (row > 0) & (depth < size[row - 1])
        same &= sign[np.where(same, above, 0)] == sign
        common = np.full(len(size), np.iinfo(np.int64).max)
        np.minimum.at(common, row[~same], depth[~same])
        new = depth >= common[row]
        new[: len(held)] = False
        node = np.full(len(sign), -1)
        node[: len(held)] = known
        node[new] = self.total + np.arange(np.count_nonzero(new))
        # A node that is not new is the last one met at its depth.
        order = np.argsort(depth, kind="stable")
        apart = depth[order] << 40
        node[order] = np.maximum.accumulate(node[order] + apart) - apart
        self.total += int(np.count_nonzero(new))
        if len(size) > 1:
            at = int(offsets[-2])
            self.last = sign[at:].copy(), node[at:].copy()
        return node[len(held):]


def numbered(words: DataFrame, backwards: bool = False) -> DataFrame:
    """``word n nodes``: the trie nodes that a word passes, one for each sign.

    Each task numbers its own stretch of the sorted words.  Where the first word of a
    stretch begins like the last one of the stretch before, those nodes take the numbers
    they have there.  Numbers grow in the order of the words; 0 is the root.
    """
    key = F.reverse("word") if backwards else F.col("word")
    ordered = words.select("word", "n", key.alias("key")).repartitionByRange("key").sortWithinPartitions("key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, names = TrieNumbers(), ["word", "n", "part", "nodes", "edge", "total"]
        first = last = None

        def edge(row, total) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([
                pa.array([row[0]], pa.string()), pa.nulls(1, pa.int64()), pa.array([row[1]], pa.int32()),
                pa.array([row[2]], pa.list_(pa.int64())), pa.array([row[3]], pa.string()), pa.array([total], pa.int64()),
            ], names)

        for batch in grouped(batches, SCAN_BYTES):
            if not batch.num_rows:
                continue
            sign, offsets = _one_byte(batch["key"])
            nodes = trie.of(sign, offsets)
            part, count = batch["part"][0].as_py(), batch.num_rows
            if first is None:
                first = batch["key"][0].as_py(), part, nodes[: offsets[1]].tolist(), "first"
            last = batch["key"][count - 1].as_py(), part, nodes[offsets[-2]:].tolist(), "last"
            yield pa.RecordBatch.from_arrays([
                batch["word"], batch["n"], batch["part"],
                pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(nodes)),
                pa.nulls(count, pa.string()), pa.nulls(count, pa.int64()),
            ], names)
        if first is not None:
            yield edge(first, trie.total)
            yield edge(last, trie.total)

    found = stored(
        ordered.withColumn("part", F.spark_partition_id()).mapInArrow(
            run, "word string, n long, part int, nodes array<long>, edge string, total long"
        ),
        "trie-back" if backwards else "trie",
    )
    # Two rows for each partition.
    ends = {(x.part, x.edge): x for x in found.filter("edge is not null").collect()}
    shifts, before, at = [], ("", []), 1
    for part in sorted({part for part, _ in ends}):
        head, tail = ends[part, "first"], ends[part, "last"]
        meet = 0
        while meet < min(len(head.word), len(before[0])) and head.word[meet] == before[0][meet]:
            meet += 1
        shared = before[1][:meet]
        shifts.append((part, at, shared))
        before = tail.word, [shared[x] if x < meet else x + at for x in tail.nodes]
        at += tail.total
    moved = words.sparkSession.createDataFrame(shifts, "part int, shift long, shared array<long>")
    # The first word's nodes are the first numbers, so a number below the length of what it shares is one of these.
    whole = F.transform("nodes", lambda x: F.when(
        x < F.size("shared"), F.get("shared", x.cast("int"))).otherwise(x + F.col("shift")))
    return found.filter("edge is null").join(moved, "part").select("word", "n", whole.alias("nodes"))


PAIR_DDL = "front long, back long, kind byte, id long, n long"
CUT, SKIP, SKIP_FIRST = 0, 1, 2     # a cut; a skipped sign; one that is the first of equal signs


def node_pairs(words: DataFrame) -> DataFrame:
    """``front back kind id n``: the pairs of nodes around each skipped sign and each cut.

    ``words`` have ``front`` and ``back`` nodes.  A word's number is its last node, so numbers
    go in the order of the words.  If equal signs follow one another, skipping any of them
    gives the same word; only the first then counts as an insertion.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in grouped(batches, 1 << 20):
            if not batch.num_rows:
                continue
            sign, offsets = _one_byte(batch["word"])
            size = np.diff(offsets)
            front, back = (batch[x].flatten().to_numpy() for x in ("front", "back"))
            ids, n = front[offsets[1:] - 1], batch["n"].to_numpy()
            # Both kinds of nodes by the number of signs before a place, the root for none and for all.
            row = np.repeat(np.arange(len(size)), size + 1)
            stop = np.cumsum(size + 1)
            place = np.arange(stop[-1]) - (stop - size - 1)[row]
            head = np.where(place > 0, front[offsets[row] + np.maximum(place, 1) - 1], 0)
            left = size[row] - place
            tail = np.where(left > 0, back[offsets[row] + np.maximum(left, 1) - 1], 0)
            skip = np.flatnonzero(left > 0)
            at = offsets[row[skip]] + place[skip]
            again = (place[skip] > 0) & (sign[at] == sign[at - 1])
            for rows, ends, kind in (
                (np.arange(len(row)), tail, np.zeros(len(row), np.int8)),
                (skip, tail[skip + 1], np.where(again, SKIP, SKIP_FIRST).astype(np.int8)),
            ):
                yield pa.RecordBatch.from_arrays([
                    pa.array(head[rows]), pa.array(ends), pa.array(kind),
                    pa.array(ids[row[rows]]), pa.array(n[row[rows]]),
                ], ["front", "back", "kind", "id", "n"])

    return words.select("word", "n", "front", "back").mapInArrow(run, PAIR_DDL)


def near_words(pairs: DataFrame) -> DataFrame:
    """``id n_near best_n best``: how many words are near, and the most frequent (of several the least id).

    Groups of one pair stream through in order; a group has at most one cut, and as many skips as
    there are letters.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        names = ["front", "back", "kind", "id", "n"]

        def best_of(group, rows, n, ids, count):
            """The best and second best row of each group, -1 for none."""
            order = rows[np.lexsort((ids[rows], -n[rows], group[rows]))]
            of = group[order]
            new = np.ones(len(order), bool)
            new[1:] = of[1:] != of[:-1]
            first, second = np.full(count, -1), np.full(count, -1)
            first[of[new]] = order[new]
            follows = np.zeros(len(order), bool)
            follows[1:] = new[:-1] & ~new[1:]
            second[of[follows]] = order[follows]
            return first, second

        def solve(columns):
            front, back, kind, ids, n = columns
            new = np.ones(len(front), bool)
            new[1:] = (front[1:] != front[:-1]) | (back[1:] != back[:-1])
            group = np.cumsum(new) - 1
            size = np.bincount(group)
            several = size[group] > 1
            if not several.any():
                return None
            group, kind, ids, n = np.unique(group[several], return_inverse=True)[1], kind[several], ids[several], n[several]
            count = int(group[-1]) + 1
            skips, cuts = np.flatnonzero(kind != CUT), np.flatnonzero(kind == CUT)
            heads = np.flatnonzero(kind == SKIP_FIRST)
            cut = np.full(count, -1)
            cut[group[cuts]] = cuts
            replaced = np.bincount(group[skips], minlength=count)
            longer = np.bincount(group[heads], minlength=count)
            first, second = best_of(group, skips, n, ids, count)
            longest, _ = best_of(group, heads, n, ids, count)
            near, best = np.zeros(len(ids), np.int64), np.full(len(ids), -1)
            near[cuts], best[cuts] = longer[group[cuts]], longest[group[cuts]]
            near[skips] = replaced[group[skips]] - 1
            best[skips] = np.where(first[group[skips]] == skips, second[group[skips]], first[group[skips]])
            shorter = cut[group[heads]]
            near[heads] += shorter >= 0
            other = best[heads]
            wins = (shorter >= 0) & (
                (other < 0) | (n[shorter] > n[other]) | ((n[shorter] == n[other]) & (ids[shorter] < ids[other])))
            best[heads] = np.where(wins, shorter, other)
            some = np.flatnonzero(near > 0)
            return pa.RecordBatch.from_arrays([
                pa.array(ids[some]), pa.array(near[some]), pa.array(n[best[some]]), pa.array(ids[best[some]])
            ], ["id", "n_near", "best_n", "best"])

        for batch in grouped(batches, SCAN_BYTES):
            if not batch.num_rows:
                continue
            columns = [batch[x].to_numpy() for x in names]
            if held is not None:
                columns = [np.concatenate(x) for x in zip(held, columns)]
            # The last group may go on in the next batch.
            last = (columns[0] == columns[0][-1]) & (columns[1] == columns[1][-1])
            at = len(last) - int(np.argmin(last[::-1])) if not last.all() else 0
            held = [x[at:].copy() for x in columns]
            if at and (found := solve([x[:at] for x in columns])) is not None:
                yield found
        if held is not None and (found := solve(held)) is not None:
            yield found

    parts = pairs.repartition("front", "back").sortWithinPartitions("front", "back").mapInArrow(
        run, "id long, n_near long, best_n long, best long"
    )
    # The greatest count, of several the least number.
    best = F.max(F.struct("best_n", (-F.col("best")).alias("best")))
    return parts.groupBy("id").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select(
        "id", "n_near", F.col("best.best_n").alias("best_n"), (-F.col("best.best")).alias("best")
    )


def roots_of(steps: DataFrame) -> DataFrame:
    """``id root`` for steps ``id form`` without circles: the end of each way, its steps doubled until none is left."""
    ways = stored(steps.select("id", F.col("form").alias("root")), "ways")
    while True:
        on = ways.select(F.col("id").alias("at"), F.col("root").alias("further"))
        further = stored(ways.join(on, F.col("root") == F.col("at"), "left").select(
            "id", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")
        ), "ways")
        ways = further.drop("moved")
        if further.filter("moved").isEmpty():
            return ways


def spelling_variants(docs: DataFrame) -> DataFrame:
    """``word form root n n_near form_n`` of every word of the texts, as the module describes.

    Words are runs of A-Z, a-z and U+00C0 to U+00FF, A-Z in lower case.  Where ``SLIP`` divides the
    checksum of the document's id and the word, that word of that document loses a sign.  Null and empty texts
    have no words.  Rows that repeat an id are read each; the checksum of a row without an
    id has nothing before the colon.  Other columns are left out.  Of an empty table nothing is returned.
    """
    words = stored(word_counts(docs), "words")
    front = numbered(words).select("word", "n", F.col("nodes").alias("front"))
    back = numbered(words, backwards=True).select("word", F.col("nodes").alias("back"))
    both = stored(front.join(back, "word"), "nodes")
    known = both.select(F.element_at("front", -1).alias("id"), "word", "n")
    near = stored(near_words(node_pairs(both)), "near")
    rows = known.join(near, "id", "left")
    steps = stored(
        rows.filter(F.col("best_n") >= RATIO * F.col("n")).select("id", F.col("best").alias("form"), "best_n"), "steps"
    )
    names = known.select("id", "word")
    ends = roots_of(steps).join(names.withColumnsRenamed({"id": "root", "word": "root_word"}), "root").select("id", "root_word")
    forms = steps.join(names.withColumnsRenamed({"id": "form", "word": "form_word"}), "form").select(
        "id", "form_word", F.col("best_n").alias("form_n")
    ).join(ends, "id")
    return rows.join(forms, "id", "left").select(
        "word", F.col("form_word").alias("form"), F.coalesce("root_word", "word").alias("root"),
        "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n",
    )


def op12_spelling(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Spelling variants of all words of all documents."""
    return spelling_variants(docs)


# Checksums by table; neighbours by their texts without a sign.
OP12_SQL = r"""
WITH RECURSIVE table8 AS MATERIALIZED (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) ORDER BY i) AS crc
  FROM (SELECT unnest(range(256)) AS i)
), runs AS MATERIALIZED (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents)
  WHERE length(run) >= 5 GROUP BY 1, 2
), hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(range(1, length(h) // 2 + 1),
      lambda i: (('0x' || substr(h, 2 * i - 1, 2))::BIGINT))),
    lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1]))) AS h
  FROM (SELECT run, n, hex(encode(doc_id || ':' || run)) AS h FROM runs), table8
), slipped AS (
  SELECT CASE WHEN h % 97 = 0 THEN left(run, (h % length(run))::int) || substr(run, (h % length(run))::int + 2)
    ELSE run END AS word, n FROM hashed
), words AS MATERIALIZED (
  SELECT word, sum(n)::bigint AS n FROM slipped WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), skips AS MATERIALIZED (
  SELECT word, n, left(word, i::int) AS a, substr(word, i::int + 2) AS b
  FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)
), near AS MATERIALIZED (
  SELECT x.word, y.word AS other, y.n AS other_n FROM skips AS x JOIN skips AS y USING (a, b) WHERE x.word <> y.word
  UNION SELECT x.word, y.word, y.n FROM skips AS x JOIN words AS y ON x.a || x.b = y.word
  UNION SELECT y.word, x.word, x.n FROM skips AS x JOIN words AS y ON x.a || x.b = y.word
), best AS (
  SELECT word, count(*) AS n_near, max(other_n) AS most FROM near GROUP BY word
), forms AS MATERIALIZED (
  SELECT word, min(other) AS form, any_value(most) AS form_n
  FROM near JOIN best USING (word) JOIN words USING (word) WHERE other_n = most AND most >= 2 * n GROUP BY word
), ways AS (
  SELECT word, word AS root, 0 AS steps FROM words
  UNION ALL SELECT ways.word, forms.form, steps + 1 FROM ways JOIN forms ON ways.root = forms.word
), roots AS (
  SELECT word, arg_max(root, steps) AS root FROM ways GROUP BY word
)
SELECT word, form, root, n, coalesce(n_near, 0) AS n_near, form_n
FROM words LEFT JOIN best USING (word) LEFT JOIN forms USING (word) JOIN roots USING (word)
"""
