from __future__ import annotations

import random

import pytest

from lodestrata.llm.common import prepare

# Columns that the operators use inside, too.
CLASHING = "lang string, source string, n_chars int, n int, token long, k1 long, spans string, piece int, " \
    "length long, start long, _words string, n_words int, score double, digest string, rep long, root long, " \
    "a long, b long, anchor long, _spans int, _gone int, _id int, ids string, sequence_id int, `offset` int"


@pytest.fixture(scope="session")
def session(spark):
    return prepare(spark)


def documents(session, rows, parts: int = 3):
    """Documents with id and text of ``rows``, and columns with clashing names."""
    df = session.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    for column in CLASHING.split(", "):
        name, kind = column.replace("`", "").split(" ")
        df = df.withColumn(name, F_value(kind))
    return df


def F_value(kind):
    from pyspark.sql import functions as F

    return F.lit(None).cast(kind) if kind != "int" else F.lit(7)


def made_texts(seed: int, n: int) -> list[tuple[int, str | None]]:
    """Texts with shared passages, copies and near copies, ties, empty and null ones."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(50)] + ["é", "Ünder", "x,", "y."]

    def some(size):
        return " ".join(rng.choice(words) for _ in range(size))

    bases, passage, rows = [some(rng.choice([2, 5, 20, 80])) for _ in range(15)], some(60), []
    for i in range(n):
        text = rng.choice(bases).split(" ")
        for _ in range(rng.choice([0, 0, 1, 2, 5])):
            text[rng.randrange(len(text))] = rng.choice(words)
        text = " ".join(text)
        if rng.random() < 0.3:
            text += "\n" + passage
        rows.append((i, rng.choice([None, "", " \n\t "]) if rng.random() < 0.08 else text))
    return rows


def edge_rows() -> list[tuple[int | None, str | None]]:
    long = " ".join(f"word{i % 997} and{i}." for i in range(12_000))
    return [
        (None, "a text without an id, " * 20), (None, None), (1, None), (2, ""), (3, " \n\t\r"),
        (4, "a"), (5, long), (6, long), (7, "same row " * 30), (7, "same row " * 30),
        (8, "ééé 日本語 \U0001f600 " * 40), (9, "x" * 5000), (10, "\x00 nul and \x1c more"),
    ]
