"""Spelling variants against a brute-force search of all pairs."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from lodestrata.llm import spelling
from lodestrata.llm.common import column_bytes
from tests.llm.conftest import documents, edge_rows

LETTERS = "abcdeéÀÿ×"


def rows_of(seed: int, n: int, count: int = 40):
    """Texts over few words and their slips, so that many are near one another."""
    rng = random.Random(seed)
    bases = ["".join(rng.choice(LETTERS) for _ in range(rng.choice([4, 5, 5, 6, 9]))) for _ in range(count)]
    bases += ["aaaaa", "aaaaaa", "aaaaaaa", "baaaa", "abababab", "babababa"]
    rows = []
    for i in range(n):
        words = []
        for _ in range(rng.choice([0, 1, 30, 200])):
            word = bases[int(len(bases) * rng.random() ** 2)]
            if rng.random() < 0.4:
                at = rng.randrange(len(word))
                word = word[:at] + rng.choice(["", rng.choice(LETTERS), word[at] * 2]) + word[at + 1:]
            words.append(word if rng.random() < 0.9 else word.upper() if word.isascii() else word.capitalize())
        rows.append((i, rng.choice([" ", ", ", "\n", "1", "Ā"]).join(words)))
    # One that leads on to another.
    rows.append((n, " ".join(["linkz"] * 64 + ["linkzy"] * 24 + ["linkzyx"] * 8)))
    return rows


def near(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(rows):
    lower, counts = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    n = {word: k for word, k in counts.items() if len(word) >= 5 and k >= 3}
    by_length, links = {}, {word: [] for word in n}
    for word in n:
        by_length.setdefault(len(word), []).append(word)
    for word in n:
        for size in (len(word) - 1, len(word), len(word) + 1):
            links[word] += [x for x in by_length.get(size, []) if near(word, x)]
    forms = {}
    for word, others in links.items():
        best = min(others, key=lambda x: (-n[x], x), default=None)
        forms[word] = best if best and n[best] >= 2 * n[word] else None
    found = set()
    for word in n:
        root = word
        while forms[root]:
            root = forms[root]
        found.add((word, forms[word], root, n[word], len(links[word]), n.get(forms[word])))
    return found


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_variants(session, seed):
    rows = rows_of(seed, 150)
    got = [tuple(x) for x in spelling.op12_spelling(session, documents(session, rows)).collect()]
    want = brute(rows)
    assert set(got) == want and len(got) == len(want)
    assert any(x[1] and x[2] != x[1] for x in want) and len(want) > 60


def test_many_small_batches_and_stretches(session, monkeypatch):
    """Groups and stretches of the trie that go on in the next batch and the next task."""
    monkeypatch.setattr(spelling, "SCAN_BYTES", 200)
    session.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    session.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    session.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        rows = rows_of(5, 120)
        got = [tuple(x) for x in spelling.op12_spelling(session, documents(session, rows)).collect()]
    finally:
        session.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "512")
        session.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        session.conf.set("spark.sql.shuffle.partitions", "4")
    assert sorted(got, key=str) == sorted(brute(rows), key=str)


def test_numbers_are_those_of_a_trie(session):
    words = sorted({word for _, text in rows_of(7, 80) for word in text.split() if re.fullmatch("[a-zà-ÿ×]+", word)})
    df = session.createDataFrame([(word, 1) for word in words], "word string, n long")
    for backwards in (False, True):
        got = {x.word: x.nodes for x in spelling.numbered(df, backwards).collect()}
        seen = {}
        for word, nodes in got.items():
            word = word[::-1] if backwards else word
            assert len(nodes) == len(word)
            for i, node in enumerate(nodes):
                assert seen.setdefault(word[: i + 1], node) == node
        assert len(set(seen.values())) == len(seen) and 0 not in seen.values()
        if not backwards:
            assert sorted(got, key=lambda x: got[x][-1]) == words


def test_checksums():
    rng = random.Random(1)
    parts = [bytes(rng.randrange(256) for _ in range(rng.choice([0, 1, 7, 63, 64, 65, 300]))) for _ in range(90)]
    data, offsets = np.frombuffer(b"".join(parts), np.uint8), np.cumsum([0] + [len(x) for x in parts])
    seeds = np.array([zlib.crc32(str(i).encode()) for i in range(90)], np.uint32)
    got = spelling.checksums(data, offsets[:-1], offsets[1:], seeds)
    assert got.tolist() == [zlib.crc32(str(i).encode() + x) for i, x in enumerate(parts)]


def test_runs_stay_within_their_text():
    import pyarrow as pa

    data, offsets = column_bytes(pa.array(["abc", None, "", "dÿ×eĀfĀ", "g", "1h", "i-j"]))
    found = [bytes(data[b:e]).decode() for b, e in zip(*spelling.letter_runs(data, offsets))]
    assert found == ["abc", "dÿ×e", "f", "g", "h", "i", "j"]


def test_edges(session):
    rows = edge_rows() + [
        (None, "nameless nameless nameless"), (20, "q" * 5000), (21, "q" * 5000), (22, "q" * 4999 + " " + "q" * 5000),
        (23, "tieda tieda tieda tiedb tiedb tiedb tiedc"), (24, "tiedc " * 6 + "tiedd " * 6), (24, "tiedc"), (24, "tiedc"),
    ]
    got = [tuple(x) for x in spelling.op12_spelling(session, documents(session, rows)).collect()]
    assert sorted(got, key=str) == sorted(brute(rows), key=str)
    assert spelling.op12_spelling(session, documents(session, [])).count() == 0
    assert spelling.op12_spelling(session, documents(session, [(1, None), (2, "one two three")])).count() == 0
