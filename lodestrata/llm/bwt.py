"""Burrows-Wheeler transforms of string collections, and merging them.

A collection is cut into chains of symbols, each symbol the number of a gram of
``GRAM`` bytes and the next one beginning where it ends, so that a few symbols cover
the length of a match.  Each shard's transform lists, for its suffixes in sorted
order, the symbol before the suffix.  Two transforms are merged without sorting
suffixes again: an interleave says from which shard each suffix comes; mapping
it through the symbols sorts the suffixes by one symbol more, so after ``h`` rounds
they stand in order of their first ``h`` symbols.  The round in which a border
between two neighbours first appears gives the prefix that they have in common.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

GRAM = 25
ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of the ``size`` bytes at each place, for all that fit."""
    n = len(data) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    room = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ascontiguousarray(
        np.lib.stride_tricks.sliding_window_view(room, 8)[: len(data)]
    ).view(np.uint64).ravel()
    found = np.full(n, size, np.uint64)
    for at in range(0, size, 8):
        part = eight[at: at + n]
        if size - at < 8:
            part = part & np.uint64((1 << 8 * (size - at)) - 1)
        found = (found ^ part) * ODD[0]
        found ^= found >> np.uint64(29)
    found *= ODD[1]
    return found ^ found >> np.uint64(32)


@dataclass
class Chains:
    """All suffixes of a collection, by number.

    Suffix ``i`` begins with ``symbol[i]`` (0: the end of a chain, and nothing else) and
    goes on as suffix ``after[i]``; ``before[i]`` is -1 where a chain begins.  ``string`` and ``place`` say where it
    stands.  Numbers grow with string and place.
    """

    symbol: np.ndarray
    after: np.ndarray
    before: np.ndarray
    string: np.ndarray
    place: np.ndarray


def chains_of(data: np.ndarray, offsets: np.ndarray, gram: int = GRAM) -> Chains:
    """The chains of strings of at least ``gram`` bytes each."""
    size = np.diff(offsets)
    # A suffix for each place where a gram fits, and the ends of up to ``gram`` chains.
    grams = size - gram + 1
    total = grams + np.minimum(gram, grams)
    first = np.cumsum(total) - total
    string = np.repeat(np.arange(len(size), dtype=np.int32), total)
    number = np.arange(len(string), dtype=np.int32)
    place = number - first.astype(np.int32)[string]
    real = place < grams[string]
    symbol = np.zeros(len(string), np.int32)
    hashes = gram_hashes(data, gram)[offsets[:-1][string[real]] + place[real]]
    symbol[real] = np.unique(hashes, return_inverse=True)[1] + 1
    # The suffix ``gram`` places on: a gram, or the end of this chain.
    after = np.where(real, number + np.int32(gram), np.int32(-1))
    short = real & (grams[string] < gram)
    # Strings with fewer grams than chains could be: one end for each gram.
    after[short] = first[string[short]] + grams[string[short]] + place[short]
    before = np.full(len(string), -1, np.int32)
    before[after[real]] = number[real]
    return Chains(symbol, after, before, string, place)


def sort_suffixes(chains: Chains, members: np.ndarray) -> np.ndarray:
    """The suffixes of whole strings in order, by doubling ranks.

    Ends of chains are all different and come first, in the order of their numbers.
    """
    spot = np.full(len(chains.symbol), -1, np.int32)
    spot[members] = np.arange(len(members), dtype=np.int32)
    symbol = chains.symbol[members]
    after = np.where(symbol > 0, spot[chains.after[members]], np.arange(len(members), dtype=np.int32))
    ends = symbol == 0
    rank = symbol.astype(np.int64) + int(ends.sum())
    rank[ends] = np.arange(int(ends.sum()))
    while True:
        then = rank[after]
        then[ends] = 0
        key = (rank << 32) | then
        order = np.argsort(key)
        key = key[order]
        new = np.ones(len(order), bool)
        new[1:] = key[1:] != key[:-1]
        if new.all():
            return members[order]
        rank[order] = np.cumsum(new) - 1
        after = after[after]


def transform(chains: Chains, order: np.ndarray) -> np.ndarray:
    """The symbol before each suffix of a sorted list; 0 where a chain begins."""
    before = chains.before[order]
    return np.where(before >= 0, chains.symbol[before], 0)


def _stable_order(values: np.ndarray) -> np.ndarray:
    """A stable sort of numbers below 2 ** 32, by their two halves."""
    low = np.argsort((values & 0xFFFF).astype(np.uint16), kind="stable")
    if len(values) and int(values.max()) >> 16:
        return low[np.argsort((values[low] >> 16).astype(np.uint16), kind="stable")]
    return low


def merge(first: np.ndarray, second: np.ndarray, rounds: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The interleave of two transforms, and common prefixes, in symbols.

    The interleave is False for a suffix of the first.  The second array gives for
    each suffix how many symbols it shares with the one before it; with ``rounds``
    it is cut at that number, as the suffixes are only sorted by so many symbols.
    Without, rounds go on until nothing changes.
    """
    n = len(first) + len(second)
    ends = [int((x == 0).sum()) for x in (first, second)]
    top = np.concatenate([np.zeros(ends[0], bool), np.ones(ends[1], bool)])
    mix = np.concatenate([np.zeros(len(first), bool), np.ones(len(second), bool)])
    known = np.full(n, -1)
    known[:1] = 0
    block = np.zeros(n, np.int32)
    done = 0
    while rounds is None or done < rounds:
        symbols = np.empty(n, np.int32)
        symbols[~mix], symbols[mix] = first, second
        going = np.flatnonzero(symbols)
        order = going[_stable_order(symbols[going])]
        new_mix = np.concatenate([top, mix[order]])
        border = np.ones(n, bool)
        at = len(top)
        if n > at:
            border[at + 1:] = (symbols[order[1:]] != symbols[order[:-1]]) | (block[order[1:]] != block[order[:-1]])
        fresh = border & (known < 0)
        known[fresh] = done
        done += 1
        settled = not fresh.any() and bool((new_mix == mix).all())
        mix, block = new_mix, np.cumsum(border, dtype=np.int32)
        if settled:
            break
    known[known < 0] = done
    return mix, known


def merged_order(chains: Chains, strings: int, shards: int, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of a collection in order of their first ``rounds`` symbols, and common prefixes.

    Strings are dealt to shards in turn.  Shards are merged two by two; only the last merge
    may stop after ``rounds``, as a merged transform must be sorted wholly to be merged again.
    """
    parts = []
    for shard in range(min(shards, max(1, strings))):
        parts.append(sort_suffixes(chains, np.flatnonzero(chains.string % shards == shard)))
    if len(parts) == 1:
        parts.append(np.zeros(0, np.int64))
    common = None
    while len(parts) > 1:
        last = len(parts) == 2
        joined = []
        for left, right in zip(parts[::2], parts[1::2]):
            mix, common = merge(transform(chains, left), transform(chains, right), rounds if last else None)
            both = np.empty(len(mix), np.int64)
            both[~mix], both[mix] = left, right
            joined.append(both)
        parts = joined + parts[len(parts) // 2 * 2:]
    return parts[0], common
