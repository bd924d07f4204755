"""Quality rules: an ordered list of threshold conjunctions learned from labelled rows.

Statistics of each text are plain column expressions.  Sequential covering
learns from the statistics of labelled rows: a rule grows by the threshold of
greatest information gain on two thirds of the rows, is pruned on the last third, and the
rows it covers leave before the next rule is grown.  What a step needs are
counts by statistic and bin, so each is one aggregate in Spark, whatever the number of
labelled rows.  The list becomes one ordered ``CASE`` expression.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.llm.common import stored

# A word, and the signs that count as symbols.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

LEAST_WORDS = 50
MOST_REPEATED = 50     # per cent of the words
QUANTILES = [0.005, 0.01, 0.02, 0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 0.95, 0.98, 0.99, 0.995]
MOST_RULES = 8
MOST_LITERALS = 4
LEAST_PRECISION = 0.9  # of a rule, on the rows it is pruned on
LEAST_COVER = 10       # labelled rows that a rule must reject, at least

FEATURES = [
    "n_words", "mean_word", "symbol_share", "dup_line_share", "repeat_share", "distinct_share",
    "digit_share", "upper_share", "line_words",
]


def repeated_words(words: Column) -> Column:
    """Words that lie in a window of three words found twice or more in the text.

    Windows are hashed, sorted with their places, and compared with their
    neighbours: no step looks at more than a text.  The argument must be a
    column of a frame, not an expression.
    """
    size = F.size(words)
    windows = F.when(size >= 3, F.transform(
        F.sequence(F.lit(0), size - 3),
        lambda i: F.struct(
            F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("h"),
            i.alias("i"),
        ),
    ))
    return F.sort_array(windows)


def text_statistics(docs: DataFrame) -> DataFrame:
    """``doc_id``, the base counts and the statistics that rules may use.

    Null text has no words and all counts 0; shares of nothing are 0.  Each row
    gives a row, so repeated and null ids do, too.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    split = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text.alias("_text"),
        F.regexp_extract_all(text, F.lit(WORD), 0).alias("_words"),
        F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORD)).alias("_lines"),
    )
    sorted_ = split.select(
        "*", F.size("_words").cast("long").alias("n_words"),
        repeated_words(F.col("_words")).alias("_windows"),
    )
    again = F.zip_with(
        F.slice("_windows", 1, F.greatest(F.size("_windows") - 1, F.lit(0))),
        F.slice("_windows", 2, F.greatest(F.size("_windows") - 1, F.lit(0))),
        lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])),
    )
    places = F.flatten(F.filter(again, lambda x: x.isNotNull()))
    found = sorted_.select("*", F.array_distinct(places).alias("_places"))
    covered = F.size(F.array_distinct(F.flatten(
        F.transform("_places", lambda i: F.array(i, i + 1, i + 2))
    )))
    size = F.length("_text")

    def without(signs: str) -> Column:
        return F.length(F.translate("_text", signs, ""))

    counted = found.select(
        "doc_id", "n_words", without(BLANKS).cast("long").alias("word_chars"),
        (size - without(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.size("_windows") > 1, covered).otherwise(0).cast("long").alias("n_repeat_words"),
        F.size("_lines").alias("n_lines"), F.size(F.array_distinct("_words")).alias("n_distinct"),
        (size - without("0123456789")).alias("n_digits"),
        (size - without("ABCDEFGHIJKLMNOPQRSTUVWXYZ")).alias("n_upper"),
    )

    def share(part: str, whole: str) -> Column:
        return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(F.lit(0.0))

    return counted.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        share("word_chars", "n_words").alias("mean_word"),
        share("n_symbols", "word_chars").alias("symbol_share"),
        share("n_dup_lines", "n_lines").alias("dup_line_share"),
        share("n_repeat_words", "n_words").alias("repeat_share"),
        share("n_distinct", "n_words").alias("distinct_share"),
        share("n_digits", "word_chars").alias("digit_share"),
        share("n_upper", "word_chars").alias("upper_share"),
        share("n_words", "n_lines").alias("line_words"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")
    )


@dataclass(frozen=True)
class Literal:
    """``feature <= limit``, or above it."""

    feature: str
    limit: float
    above: bool

    def column(self) -> Column:
        value = F.col(self.feature)
        return value > F.lit(self.limit) if self.above else value <= F.lit(self.limit)

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.limit:.6g}"


@dataclass(frozen=True)
class DecisionList:
    """Rules in order; a row that none covers is kept."""

    rules: tuple[tuple[Literal, ...], ...]

    def keep(self) -> Column:
        if not self.rules:
            return F.lit(True)
        verdict = None
        for rule in self.rules:
            when = F.when if verdict is None else verdict.when
            verdict = when(_all(rule), F.lit(False))
        return verdict.otherwise(F.lit(True))

    def __str__(self) -> str:
        lines = [f"drop if {' and '.join(map(str, rule))}" for rule in self.rules]
        return "\n".join([*lines, "else keep"])


def _all(rule: tuple[Literal, ...]) -> Column:
    found = F.lit(True)
    for literal in rule:
        found = found & literal.column()
    return found


def _any(rules) -> Column:
    found = F.lit(False)
    for rule in rules:
        found = found | _all(rule)
    return found


def learn_list(
    rows: DataFrame, features: list[str] = FEATURES, label: str = "quality",
    rules: int = MOST_RULES, literals: int = MOST_LITERALS, precision: float = LEAST_PRECISION,
    cover: int = LEAST_COVER,
) -> DecisionList:
    """Learn which rows to drop (label 0) from a stored table of statistics and labels.

    Without rows, or with one label only, the list is empty: everything is kept.
    """
    bad = (F.col(label) == 0).cast("long")
    quantiles = rows.agg(*[
        F.percentile_approx(x, QUANTILES, 10_000).alias(x) for x in features
    ]).first()
    limits = {x: sorted(set(quantiles[x] or ())) for x in features}
    # A row's bin is the number of limits below its value: "<= limit i" are the bins up to i.
    binned = rows.select(
        *features, bad.alias("_bad"), (F.lit(1) - bad).alias("_good"),
        (F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0).alias("_prune"),
        *[_bin(x, limits[x]).alias(f"_bin_{x}") for x in features],
    )
    binned = stored(binned, "binned")
    found: list[tuple[Literal, ...]] = []
    while len(found) < rules:
        rule = _grow(binned.filter(~F.col("_prune") & ~_any(found)), features, limits, literals)
        rule = _pruned(binned.filter(F.col("_prune") & ~_any(found)), rule, precision, cover / 3)
        if not rule:
            break
        found.append(rule)
    return DecisionList(tuple(found))


def _bin(feature: str, limits: list[float]) -> Column:
    if not limits:
        return F.lit(0)
    return F.size(F.filter(F.array(*map(F.lit, limits)), lambda t: t < F.col(feature)))


def _grow(rows: DataFrame, features, limits, literals: int) -> tuple[Literal, ...]:
    """Add the literal of greatest gain until no good row is covered or nothing gains."""
    rule: tuple[Literal, ...] = ()
    pairs = ", ".join(f"'{x}', `_bin_{x}`" for x in features)
    while len(rule) < literals:
        counts = rows.filter(_all(rule)).select(
            "_bad", "_good", F.expr(f"stack({len(features)}, {pairs}) AS (feature, bin)")
        ).groupBy("feature", "bin").agg(F.sum("_bad").alias("bad"), F.sum("_good").alias("good")).collect()
        table = {(x.feature, x.bin): (x.bad, x.good) for x in counts}
        bad = sum(v[0] for (f, _), v in table.items() if f == features[0])
        good = sum(v[1] for (f, _), v in table.items() if f == features[0])
        if not bad or not good:
            break
        before, best = math.log2(bad / (bad + good)), (0.0, None)
        for feature in features:
            low_bad = low_good = 0
            for spot, limit in enumerate(limits[feature]):
                here = table.get((feature, spot), (0, 0))
                low_bad, low_good = low_bad + here[0], low_good + here[1]
                for above in (False, True):
                    b, g = (bad - low_bad, good - low_good) if above else (low_bad, low_good)
                    if b:
                        gain = b * (math.log2(b / (b + g)) - before)
                        if gain > best[0] + 1e-9:
                            best = (gain, Literal(feature, float(limit), above))
        if best[1] is None:
            break
        rule += (best[1],)
    return rule


def _pruned(rows: DataFrame, rule, precision: float, cover: float) -> tuple[Literal, ...]:
    """The beginning of the rule that does best on rows it was not grown on; () if none is good."""
    if not rule:
        return ()
    sums = [
        F.sum(F.when(_all(rule[:size]), F.col(x)).otherwise(0)).alias(f"{x}{size}")
        for size in range(1, len(rule) + 1) for x in ("_bad", "_good")
    ]
    row, best = rows.agg(*sums).first(), ((-1.0, 0), ())
    for size in range(1, len(rule) + 1):
        b, g = row[f"_bad{size}"] or 0, row[f"_good{size}"] or 0
        if b >= cover and b >= precision * (b + g):
            best = max(best, (((b - g) / (b + g), b), rule[:size]), key=lambda x: x[0])
    return best[1]


def labelled(statistics: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    """Statistics of the rows with a label of 0 or 1 that pass the base rules."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias(label)).filter(
        F.col(label).isin(0, 1)
    ).groupBy("doc_id").agg(F.min(label).alias(label))
    return statistics.filter(~base_failed()).join(known, "doc_id")


def op4_quality(spark, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Base counts and the verdict of a list learned from all labelled documents."""
    statistics = stored(text_statistics(docs), "text-statistics")
    learned = learn_list(stored(labelled(statistics, labels), "labelled-statistics"))
    failed = base_failed()
    return statistics.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), F.when(failed, False).otherwise(learned.keep()).alias("kept"),
    )
