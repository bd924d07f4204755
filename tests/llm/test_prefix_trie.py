"""The conversation trie against one built turn by turn."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestrata.llm import prefix_trie


def frame(session, rows):
    df = session.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    for name in ("path", "token", "known", "opener", "taken", "key", "range", "shard", "depth", "n", "least", "ends"):
        df = df.withColumn(name, F.lit("clash"))
    return df


def rows_of(seed: int, n: int, first: int = 0):
    rng, rows = random.Random(seed), []
    texts = ["a", "bb", "ccc", "é", "", None, "日本語"]
    for conv in range(first, first + n):
        if rng.random() < 0.05:
            continue
        shared = rng.choice([0, 0, 1, 3, 9])
        for turn in range(rng.choice([1, 2, 3, 5, 8, 14])):
            text = "abcdefghi"[turn] if turn < shared else rng.choice(texts)
            rows.append((conv, turn if turn or rng.random() < 0.8 else None, rng.choice(["user", "user", None, "x"])
                         if turn >= shared else "user", text))
    return rows


def brute(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            token = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32]
            own[conv].append((turn is not None, turn or 0, role, token, text))
    turns = {conv: [(x[2], x[4]) for x in sorted(found)] for conv, found in own.items()}
    members = defaultdict(list)
    ends = defaultdict(list)
    for conv in turns:
        h = zlib.crc32(str(conv).encode()) % 6
        opener = conv - int(np.fmod(conv, 100))
        path = tuple(turns.get(opener, [])[:h] + turns[conv][h:])
        for d in range(len(path) + 1):
            members[path[:d]].append(conv)
        ends[path].append(conv)
    children = defaultdict(set)
    for path in members:
        if path:
            children[path[:-1]].add(path)
    leaves, saved = defaultdict(int), defaultdict(int)
    for path, found in members.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += not children[path]
            saved[path[:d]] += (len(found) - 1) * len(path[-1][1]) if path else 0
    return sorted(
        (min(found), len(path), min(members[path[:-1]]) if path else None, len(found), len(children[path]), leaves[path],
         saved[path], hashlib.sha256(",".join(map(str, sorted(ends.get(path, [])))).encode()).hexdigest())
        for path, found in members.items())


def nodes_of(df):
    return sorted(tuple(x) for x in df.collect())


# Shards of a few turns are split again and again; chunks of a few hold one shard each.
@pytest.mark.parametrize("seed, shard, chunk", [(1, 10**6, 10**6), (2, 40, 30), (3, 1, 1), (4, 12, 500)])
def test_nodes(session, seed, shard, chunk):
    rows = rows_of(seed, 230) + rows_of(seed, 30, -40)
    got = nodes_of(prefix_trie.conversation_trie(frame(session, rows), shard, chunk))
    assert got == brute(rows)
    assert max(x[1] for x in got) > 8 and max(x[4] for x in got) > 5


def test_many_copies_of_one_conversation(session):
    """Over several ranges of ids and several batches; a conversation that ends where others go on."""
    rows = [(conv, turn, "user", f"t{turn}") for conv in range(0, 9000 * 7, 7) for turn in range(2)]
    rows += [(5 + 100 * i, turn, "user", f"t{turn}") for i in range(3) for turn in range(4)]
    assert nodes_of(prefix_trie.op13_prefix_trie(session, frame(session, rows))) == brute(rows)


def test_a_long_shared_start_splits_at_its_end(session):
    rows = [(conv, turn, "user", f"t{turn}" if turn < 40 else f"{conv}-{turn}")
            for conv in range(30) for turn in range(45 if conv % 3 else 38)]
    assert nodes_of(prefix_trie.conversation_trie(frame(session, rows), 100, 100)) == brute(rows)


def test_edges(session):
    rows = [
        (1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, None, None), (2, None, "user", ""), (None, 0, "user", "a"),
        (-250, 0, "user", "a"), (2**62, 0, "user", "x" * 5_000_000), (101, 0, "u", "ser"), (102, 0, "us", "er"),
    ] + [(300, i, "user", f"turn {i}") for i in range(2000)]
    assert nodes_of(prefix_trie.op13_prefix_trie(session, frame(session, rows))) == brute(rows)
    assert nodes_of(prefix_trie.op13_prefix_trie(session, frame(session, []))) == []
    # Nothing but a conversation whose turns all give way to an absent one's.
    conv = next(x for x in range(1, 99) if zlib.crc32(str(x).encode()) % 6 > 1)
    empty = hashlib.sha256(str(conv).encode()).hexdigest()
    assert nodes_of(prefix_trie.op13_prefix_trie(session, frame(session, [(conv, 0, "user", "a")]))) == [
        (conv, 0, None, 1, 0, 1, 0, empty)]


@pytest.mark.parametrize("seed", range(6))
def test_double_array(seed):
    rng = np.random.default_rng(seed)
    trie, want, frontier, turns = prefix_trie.DoubleArray(50), {}, [0], 50
    for _ in range(6):
        pairs = sorted({(int(node), int(turn)) for node in frontier
                        for turn in rng.choice(turns, rng.choice([0, 1, 1, 2, 12, 40]), replace=False)})
        if not pairs:
            break
        nodes, codes = (np.array(x) for x in zip(*pairs))
        trie.add(nodes, codes)
        slots = trie.step(nodes, codes)
        assert (slots > 0).all()
        want.update(zip(pairs, slots.tolist()))
        frontier = rng.permutation(slots)[:25]
    assert len(set(want.values())) == len(want) == trie.used - 1
    every = [(node, turn) for node in {x for x, _ in want} | set(want.values()) for turn in range(turns)]
    got = trie.step(*(np.array(x) for x in zip(*every)))
    assert got.tolist() == [want.get(x, -1) for x in every]
