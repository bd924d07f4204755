"""Sets of word shingles of whole texts, as arrays of 64-bit hashes."""

from __future__ import annotations

import numpy as np

from lodestrata.llm.tokens import BLANK, LOWER, word_hashes

WORDS = 5
STEP = np.uint64(0x9E3779B97F4A7C15)
MIXERS = np.array(
    [0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F,
     0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53], np.uint64,
)


def mixed(values: np.ndarray, number: int) -> np.ndarray:
    """One of several unrelated permutations of 64-bit numbers."""
    found = (values ^ (values >> np.uint64(31))) * MIXERS[number]
    return (found ^ (found >> np.uint64(29))) * MIXERS[number - 1] ^ found >> np.uint64(32)


def shingle_sets(
    data: np.ndarray, offsets: np.ndarray, words: int = WORDS,
) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each text, one text after the other, and n + 1 offsets.

    A-Z count as a-z; words are what white space separates; a text with fewer
    words than a shingle has one shingle of them all, one without words none.
    """
    n = len(offsets) - 1
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(n + 1, np.int64)
    low = LOWER[data]
    blank = BLANK[low]
    first = np.zeros(len(low) + 1, bool)
    first[offsets] = True
    begin, end = ~blank, ~blank
    begin[1:] &= blank[:-1] | first[1:-1]
    end[:-1] &= blank[1:] | first[1:-1]
    begins, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    hashes = word_hashes(low, begins, ends)
    bounds = np.searchsorted(begins, offsets)
    count = np.diff(bounds)
    text = np.repeat(np.arange(n), count)
    size = len(hashes)
    found = np.zeros(max(0, size - words + 1), np.uint64)
    for k in range(words if len(found) else 0):
        found = found * STEP + hashes[k: k + len(found)]
    whole = text[: len(found)] == text[words - 1:] if len(found) else np.zeros(0, bool)
    of, found = text[: len(found)][whole], found[whole]
    few = np.flatnonzero((count > 0) & (count < words))
    if len(few):
        short = np.zeros(len(few), np.uint64)
        for k in range(words - 1):
            more = count[few] > k
            at = bounds[few[more]] + k
            short[more] = short[more] * STEP + hashes[at]
        of = np.concatenate([of, few])
        found = np.concatenate([found, mixed(short + count[few].astype(np.uint64), 0)])
    found = mixed(found, 1)
    order = np.argsort(found)
    if n <= 1 << 16:  # a stable sort of short numbers takes one pass
        order = order[np.argsort(of[order].astype(np.uint16), kind="stable")]
    else:
        order = order[np.argsort(of[order], kind="stable")]
    of, found = of[order], found[order]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (of[1:] != of[:-1])
    of, found = of[new], found[new]
    return found, np.searchsorted(of, np.arange(n + 1))
