"""Toxicity: a logistic classifier kept from leaning on identity terms.

Features are the words of a text and the first letters of its words, present or
not.  The classifier is fitted on a bounded sample of labelled rows.  Sentences
of that sample that name a term are written again with another of its kind in its
place, one term at a time, and the fit is charged for every difference between the
scores of the two (counterfactual logit pairing), so a neutral mention doesn't raise
a score.  Kinds are fixed lists of groups of people, and words that the sample itself
shows to be neutral: common in clean documents, and not much commoner in toxic ones.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.llm.common import bounded, nullable, stored

SAMPLE_ROWS = 20_000   # labelled rows that the classifier is fitted on, at most (about)
FEATURES = 2048        # features that it may use, at most
LEAST_DOCS = 4         # documents of the sample that a feature must stand in
PREFIXES = (4, 5, 6)   # lengths of word beginnings that are features of their own
PAIR_WEIGHT = 5.0      # charge for score differences between counterfactual pairs
NEUTRAL_TERMS = 512    # learned neutral terms, at most: the commonest
NEUTRAL_SHARE = 0.005  # of the clean documents that a learned term stands in, at least
NEUTRAL_RATE = 0.5     # of a term's rate in toxic documents that its rate in clean ones is, at least
RIDGE = 1e-4
STEPS = 500
SCAN_BYTES = 1 << 20   # bytes of texts in work at once

# Groups of people by kind.  A term is swapped with the next of its kind.
IDENTITY_TERMS = {
    "gender": "woman man transgender nonbinary",
    "gender plural": "women men",
    "religion": "christian muslim jewish hindu buddhist atheist sikh",
    "religion plural": "christians muslims jews hindus buddhists atheists sikhs",
    "origin": "african american asian european mexican arab latino indian chinese",
    "origin plural": "africans americans asians europeans mexicans arabs latinos indians",
    "colour": "black white brown",
    "orientation": "gay straight lesbian bisexual heterosexual homosexual queer",
    "ability": "disabled blind deaf autistic",
    "age": "young old elderly teenage",
    "standing": "immigrant refugee citizen migrant",
    "standing plural": "immigrants refugees citizens migrants",
}
WORD = re.compile(r"[^\W\d_]+")
SENTENCE_END = re.compile(r"[.!?\n]+")


def next_terms(kinds: dict[str, str]) -> dict[str, str]:
    """Each identity term's counterfactual."""
    swaps = {}
    for terms in kinds.values():
        listed = terms.split()
        swaps.update(zip(listed, listed[1:] + listed[:1]))
    return swaps


def learned_kinds(terms: list[tuple[str, int]]) -> dict[str, str]:
    """Kinds of neutral terms: alike in their ending and in how many documents (by powers of two) name them."""
    kinds: dict[str, list[str]] = {}
    for term, documents in sorted(terms):
        kinds.setdefault(f"neutral {term[-2:]} {documents.bit_length()}", []).append(term)
    return {kind: " ".join(x) for kind, x in kinds.items()}


def all_swaps(kinds: dict[str, str], terms: list[tuple[str, int]]) -> dict[str, str]:
    """Counterfactuals of the fixed and of the learned terms; a term alone in its kind has none."""
    fixed = next_terms(kinds)
    learned = next_terms(learned_kinds([x for x in terms if x[0] not in fixed]))
    return {a: b for a, b in {**learned, **fixed}.items() if a != b}


def swapped_sentences(text: str | None, swaps: dict[str, str]) -> Iterator[tuple[set[str], str, str]]:
    """Each sentence's words once per term that it names, the term, and what takes its place."""
    for sentence in SENTENCE_END.split((text or "").lower()):
        words = set(WORD.findall(sentence))
        for term in words & swaps.keys():
            yield words, term, swaps[term]


def words_of(text: str | None) -> set[str]:
    return set(WORD.findall((text or "").lower()))


def features_of(words: set[str]) -> set[str]:
    """The words, marked ``=``, and their beginnings."""
    found = {"=" + x for x in words}
    for size in PREFIXES:
        found.update({x[:size] for x in words if len(x) >= size})
    return found


@dataclass
class Classifier:
    """Weights by feature, at most ``FEATURES`` of them, the bias, and the swaps that the fit was charged for."""

    weights: dict[str, float]
    bias: float
    swaps: dict[str, str] = field(default_factory=dict)
    n_pairs: int = 0   # counterfactual sentences of the sample whose features differ

    def logit(self, words: set[str]) -> float:
        """Whole texts are looked up by sets, one per kind of feature."""
        known = self.weights
        total = self.bias + sum(known["=" + x] for x in words & self._whole)
        for size, starts in self._starts.items():
            total += sum(known[x] for x in {w[:size] for w in words if len(w) >= size} & starts)
        return total

    def __post_init__(self):
        self._whole = {x[1:] for x in self.weights if x.startswith("=")}
        self._starts = {
            size: {x for x in self.weights if len(x) == size and not x.startswith("=")}
            for size in PREFIXES
        }


def labelled_sample(
    docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, folds: int = 5, held_out: int = 0,
) -> DataFrame:
    """``doc_id text toxic`` of about ``rows`` labelled rows, never of the held-out fold.

    Rows are chosen by a hash of their id at the rate that the number of labels
    gives, so the sample, and the broadcast of its labels, has a bound whatever
    the table's size.  Rows whose label, id or text is null are left out.
    """
    fit = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).filter(
        F.col("toxic").isin(0, 1) & (F.crc32(F.col("doc_id").cast("string")) % folds != held_out)
    ).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    count = fit.count()
    if count > rows:
        share = int(rows / count * (1 << 30))
        fit = fit.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < share)
    return stored(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("text is not null")
        .join(F.broadcast(fit), "doc_id"), "toxic-sample",
    )


def _associated(sample: DataFrame, features: int) -> tuple[list[str], list[tuple[str, int]]]:
    """The features that go with the label most, by the chi-squared statistic, and neutral terms.

    A neutral term comes with the number of clean documents that name it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, Counter] = {0: Counter(), 1: Counter()}

        def flush() -> pa.RecordBatch:
            names = list(held[0].keys() | held[1].keys())
            out = pa.RecordBatch.from_pydict({
                "feature": pa.array(names, pa.string()),
                "clean": pa.array([held[0][x] for x in names], pa.int64()),
                "toxic": pa.array([held[1][x] for x in names], pa.int64()),
            })
            held[0].clear()
            held[1].clear()
            return out

        for batch in bounded(batches, SCAN_BYTES):
            for text, toxic in zip(batch["text"].to_pylist(), batch["toxic"].to_pylist()):
                held[toxic].update(features_of(words_of(text)))
                if len(held[0]) + len(held[1]) > 300_000:
                    yield flush()
        yield flush()

    sums = sample.groupBy("toxic").count().collect()
    n = {x.toxic: x["count"] for x in sums}
    if len(n) < 2:
        return [], []
    a, b = F.col("toxic"), F.col("clean")
    c, d = F.lit(n[1]) - a, F.lit(n[0]) - b
    counted = stored(sample.select("text", "toxic").mapInArrow(
        run, "feature string, clean long, toxic long"
    ).groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).filter(
        a + b >= LEAST_DOCS), "toxic-features")
    chi = (a * d - b * c).cast("double") ** 2 / ((a + b) * (c + d) + F.lit(1)).cast("double")
    best = counted.select("feature", chi.alias("chi")).orderBy(
        F.desc("chi"), "feature"
    ).limit(features).collect()
    neutral = counted.filter(
        F.col("feature").startswith("=") & (F.length("feature") > 2) & (b >= NEUTRAL_SHARE * n[0])
        & (b / n[0] >= NEUTRAL_RATE * a / n[1])
    ).orderBy(F.desc("clean"), "feature").limit(NEUTRAL_TERMS).collect()
    return [x.feature for x in best], [(x.feature[1:], x.clean) for x in neutral]


def fit_classifier(
    docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, features: int = FEATURES,
    kinds: dict[str, str] = IDENTITY_TERMS, folds: int = 5, held_out: int = 0,
) -> Classifier:
    """Fit on a bounded sample of the labelled rows.

    Without rows of both labels the score is the share of toxic rows, one half
    if there are none at all.
    """
    sample = labelled_sample(docs, labels, rows, folds, held_out)
    names, neutral = _associated(sample, features)
    spot, swaps = {x: i for i, x in enumerate(names)}, all_swaps(kinds, neutral)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, SCAN_BYTES):
            present = [
                sorted(spot[x] for x in features_of(words_of(text)) & spot.keys()) for text in batch["text"].to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["toxic"], pa.array(present, pa.list_(pa.int32()))],
                ["doc_id", "toxic", "present"],
            )

    got = sample.mapInArrow(
        run, "doc_id long, toxic int, present array<int>"
    ).orderBy("doc_id", "toxic", "present").collect()
    labels_of = np.array([x.toxic for x in got], float)
    if not names:
        share = float(labels_of.mean()) if len(labels_of) else 0.5
        share = min(max(share, 1e-3), 1 - 1e-3)
        return Classifier({}, float(np.log(share / (1 - share))), swaps)
    pairs = counterfactual_pairs(sample, spot, swaps)
    weights, bias = _fit([x.present for x in got], labels_of, pairs, len(names))
    return Classifier({x: float(w) for x, w in zip(names, weights)}, bias, swaps, sum(x[2] for x in pairs))


def counterfactual_pairs(sample: DataFrame, spot: dict[str, int], swaps: dict[str, str]) -> list[tuple]:
    """Known features that a swap takes from a sentence, those it brings, and how many sentences it does so in.

    Equal differences are one row, so there are about as many as terms and not as many as sentences.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, frozenset] = {}

        def of(word: str) -> frozenset:
            if word not in known:
                if len(known) > 300_000:
                    known.clear()
                known[word] = frozenset(spot[x] for x in features_of({word}) & spot.keys())
            return known[word]

        for batch in bounded(batches, SCAN_BYTES):
            found: Counter = Counter()
            for text in batch["text"].to_pylist():
                for words, term, other in swapped_sentences(text, swaps):
                    if of(term) == of(other):
                        continue
                    rest = frozenset().union(*(of(x) for x in words if x != term))
                    gone, new = of(term) - of(other) - rest, of(other) - of(term) - rest
                    if gone or new:
                        found[tuple(sorted(gone)), tuple(sorted(new))] += 1
            kind = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays([
                pa.array([list(x) for x, _ in found], kind), pa.array([list(x) for _, x in found], kind),
                pa.array(list(found.values()), pa.int64()),
            ], ["gone", "new", "n"])

    if not spot or not swaps:
        return []
    rows = sample.select("text").mapInArrow(run, "gone array<int>, new array<int>, n long").groupBy("gone", "new").agg(
        F.sum("n").alias("n")
    )
    return [(x.gone, x.new, x.n) for x in rows.orderBy("gone", "new").collect()]


def _fit(rows, labels, pairs, size: int) -> tuple[np.ndarray, float]:
    """Minimise log loss + ridge + pair charge, by full steps of adaptive size.

    The charge is the mean, over counterfactual sentences, of the squared difference of the two logits.
    """
    at = np.repeat(np.arange(len(rows)), [len(x) for x in rows])
    cols = np.array([c for x in rows for c in x], np.int64)
    sign = np.concatenate([[0.0], *([1.0] * len(p) + [-1.0] * len(q) for p, q, _ in pairs)])[1:]
    pat = np.repeat(np.arange(len(pairs)), [len(p) + len(q) for p, q, _ in pairs])
    pcols = np.array([c for p, q, _ in pairs for c in (*p, *q)], np.int64)
    often = np.array([n for *_, n in pairs], float) / max(1, sum(n for *_, n in pairs))
    w, first, second = np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1)
    share = np.clip(labels.mean(), 1e-3, 1 - 1e-3)
    w[size] = np.log(share / (1 - share))
    for step in range(1, STEPS + 1):
        z = w[size] + np.bincount(at, w[cols], len(rows))
        error = (1 / (1 + np.exp(-z)) - labels) / len(rows)
        slope = np.append(np.bincount(cols, error[at], size), error.sum())
        slope[:size] += RIDGE * w[:size]
        if pairs:
            apart = np.bincount(pat, sign * w[pcols], len(pairs)) * often
            slope[:size] += 2 * PAIR_WEIGHT * np.bincount(pcols, sign * apart[pat], size)
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope**2
        w -= 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-9)
    return w[:size], float(w[size])


def score_shift(docs: DataFrame, model: Classifier) -> DataFrame:
    """One row ``n_swaps shift``: swapped sentences of all texts, and the mean absolute change of their scores.

    ``shift`` is null where no text names a term; null and empty texts name none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, SCAN_BYTES):
            moved = [
                abs(1 / (1 + np.exp(-model.logit(words))) - 1 / (1 + np.exp(-model.logit(words - {term} | {other}))))
                for text in batch["text"].to_pylist() for words, term, other in swapped_sentences(text, model.swaps)
            ]
            yield pa.RecordBatch.from_pydict({"n": pa.array([len(moved)]), "moved": pa.array([float(sum(moved))])})

    total = docs.select("text").mapInArrow(run, "n long, moved double")
    return total.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_swaps"),
        F.try_divide(F.sum("moved"), F.sum("n")).alias("shift"),
    )


def score_toxicity(docs: DataFrame, model: Classifier) -> DataFrame:
    """``doc_id score`` of every whole text; an empty or null one gets the bias alone.

    A row without an id is scored like any other, and rows that repeat are each scored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, SCAN_BYTES):
            z = np.array([model.logit(words_of(x)) for x in batch["text"].to_pylist()], float)
            score = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(score)], ["doc_id", "score"]
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, score double"
    )


def drop_toxic(docs: DataFrame, model: Classifier, limit: float = 0.5) -> DataFrame:
    """The documents that score below the limit, with all their columns."""
    schema, names = nullable(docs.schema), docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, SCAN_BYTES):
            z = np.array([model.logit(words_of(x)) for x in batch["text"].to_pylist()], float)
            keep = 1 / (1 + np.exp(-np.clip(z, -40, 40))) < limit
            yield batch.filter(pa.array(keep)).select(names)

    return docs.mapInArrow(run, schema)


def op8_toxicity(spark, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores of all documents; learned from labelled rows outside fold 0 of 5."""
    model = fit_classifier(docs, labels)
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(True))
    return score_toxicity(docs, model).select(
        "doc_id", held.alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )
