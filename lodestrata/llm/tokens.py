"""Token ids of whole texts, each distinct word being encoded once per worker."""

from __future__ import annotations

import json
import os
import unicodedata
from functools import lru_cache

import numpy as np

# Fixed value: the pattern of tokenizers that drop white space and cut letters
# from other signs, so that the ids of a text are those of its words in order.
WORD_SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BLANK = np.zeros(256, bool)
BLANK[[32, 9, 10, 11, 12, 13]] = True
LETTER = np.zeros(256, bool)
LETTER[65:91] = LETTER[97:123] = True
STOP = np.zeros(256, bool)
STOP[[44, 46]] = True
LOW_BYTES = np.array([(1 << 8 * k) - 1 for k in range(8)] + [(1 << 64) - 1], np.uint64)
ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
SECOND = (np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F))


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words begin and end; none crosses from one text to the next.

    Words are what white space separates; a full stop or comma after a letter
    begins a new one, as letters and such signs never share a token.
    """
    n = len(data)
    blank = BLANK[data]
    first = np.zeros(n + 1, bool)
    first[offsets[:-1]] = True
    first[n] = True
    begin = ~blank
    cut = STOP[data[1:]] & LETTER[data[:-1]]
    begin[1:] &= blank[:-1] | first[1:n] | cut
    end = ~blank
    end[:-1] &= blank[1:] | first[1:n] | begin[1:]
    return np.flatnonzero(begin), np.flatnonzero(end) + 1


def word_hashes(data: np.ndarray, begins: np.ndarray, ends: np.ndarray, odd=ODD) -> np.ndarray:
    """64-bit hashes of byte ranges, eight bytes at a time; other ``odd`` numbers give another hash."""
    room = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.lib.stride_tricks.sliding_window_view(room, 8)
    size = ends - begins
    found = size.astype(np.uint64) * odd[1]
    rest, at = np.arange(len(begins)), begins
    left = size
    while len(rest):
        part = eight[at].view(np.uint64).ravel() & LOW_BYTES[np.minimum(left, 8)]
        mixed = (found[rest] ^ part) * odd[0]
        found[rest] = (mixed ^ (mixed >> np.uint64(29))) * odd[1]
        more = left > 8
        rest, at, left = rest[more], at[more] + 8, left[more] - 8
    return found ^ (found >> np.uint64(32))


def lowered(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The bytes with A-Z in lower case, but for words with bytes beyond ASCII.

    The normal form comes before the lower case: a capital and the mark after it may
    compose in lower case only, and other marks may stand between the two.
    """
    low = LOWER[data]
    beyond = np.flatnonzero(data >= 128)
    if len(beyond):
        odd = np.zeros(len(begins), bool)
        odd[np.searchsorted(begins, beyond, "right") - 1] = True
        begins, size = begins[odd], (ends - begins)[odd]
        stop = np.cumsum(size)
        spots = np.repeat(begins - (stop - size), size) + np.arange(stop[-1])
        low[spots] = data[spots]
    return low


class TextEncoder:
    """Ids of texts, no special tokens added.

    For tokenizers that drop white space, a text's ids are the ids of its words.
    The words of a batch are told apart by their hashes, each distinct one is
    looked up, and only those not met before are encoded.  The store of words is sorted
    arrays of some 40 bytes a word (two independent hashes, both of which must agree, and
    where the ids are); it is emptied when it holds ``max_words``.  Any other tokenizer,
    and any text that may hold the name of a special token, is encoded directly.
    """

    def __init__(self, path: str, special_as_text: bool = False, max_words: int = 1_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = special_as_text
        self._max_words = max_words
        self._forget()
        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        kinds = (parts.get("normalizer") or {}).get("normalizers", [])
        splits = (parts.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
        self._special = [x["content"].encode()[:2].lower() for x in parts.get("added_tokens", [])]
        self._by_word = (
            [x["type"] for x in kinds] == ["NFC", "Replace", "Lowercase"]
            and splits[0].get("pattern", {}).get("Regex") == WORD_SPLIT
            and splits[0].get("behavior") == "Removed"
            and [x["type"] for x in splits] == ["Split", "ByteLevel"]
            and parts["model"].get("end_of_word_suffix") == "</w>"
        )
        if self._by_word:
            names = self._tokenizer.get_vocab()
            self._is_end = np.zeros(max(names.values()) + 1, bool)
            self._is_end[[i for x, i in names.items() if x.endswith("</w>")]] = True
            # For words of letters, which the normal form and the pattern leave as they are.
            self._plain = Tokenizer(self._tokenizer.model)
            self._plain.pre_tokenizer = pre_tokenizers.Sequence([
                pre_tokenizers.Split(" ", "removed"),
                pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
            ])

    def _forget(self) -> None:
        """Empty the store: hashes in order, second hashes, first ids and numbers of ids; all ids."""
        self._keys, self._checks = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self._starts, self._sizes = np.zeros(0, np.int64), np.zeros(0, np.int32)
        self._flat = np.zeros(0, "<u4")

    def _direct(self, texts: list[bytes]) -> list[bytes]:
        found = []
        for spot in range(0, len(texts), 4096):
            part = [x.decode("utf-8", "replace") for x in texts[spot: spot + 4096]]
            coded = self._tokenizer.encode_batch_fast(part, add_special_tokens=False)
            found += [np.array(x.ids, "<u4").tobytes() for x in coded]
        return found

    def _learn(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word.

        Words of letters alone are encoded many at a time: each ends with an id
        that ends a word, and holds no other such id.
        """
        letters, names, rest, found = [], [], [], {}
        for word in words:
            text = word.decode("utf-8", "replace")
            if word.isalpha() or (
                text.isalpha() and text == text.lower() and unicodedata.is_normalized("NFC", text)
            ):
                letters.append(text)
                names.append(word)
            else:
                rest.append(word)
        for spot in range(0, len(letters), 4096):
            part = slice(spot, spot + 4096)
            coded = self._plain.encode_batch_fast([" ".join(letters[part])], add_special_tokens=False)
            ids = np.array(coded[0].ids, "<u4")
            ends = (np.flatnonzero(self._is_end[ids]) + 1) * 4
            if len(ends) != len(names[part]):
                rest += names[part]
                continue
            raw, ends = ids.tobytes(), ends.tolist()
            found.update(zip(names[part], [raw[a:b] for a, b in zip([0, *ends], ends)]))
        found.update(zip(rest, self._direct(rest)))
        return [found[x] for x in words]

    def _look_up(
        self, raw: bytes, begins: np.ndarray, ends: np.ndarray, keys: np.ndarray, checks: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Where in the store the ids of words begin, and how many each has.

        Words are ranges of ``raw`` in the order of their hashes, all different; unknown ones are learned.
        """
        at = np.searchsorted(self._keys, keys)
        known = np.zeros(len(keys), bool)
        inside = at < len(self._keys)
        held = at[inside]
        known[inside] = self._keys[held] == keys[inside]
        free = ~known
        known[inside] &= self._checks[held] == checks[inside]
        starts, sizes = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int32)
        starts[known], sizes[known] = self._starts[at[known]], self._sizes[at[known]]
        new = np.flatnonzero(~known)
        if len(new):
            coded = self._learn([raw[a:b] for a, b in zip(begins[new].tolist(), ends[new].tolist())])
            sizes[new] = np.fromiter(map(len, coded), np.int64, len(coded)) // 4
            starts[new] = len(self._flat) + np.cumsum(sizes[new]) - sizes[new]
            self._flat = np.concatenate([self._flat, np.frombuffer(b"".join(coded), "<u4")])
            # A word whose hash another word has is learned each time.
            spot = at[free]
            self._keys = np.insert(self._keys, spot, keys[free])
            self._checks = np.insert(self._checks, spot, checks[free])
            self._starts = np.insert(self._starts, spot, starts[free])
            self._sizes = np.insert(self._sizes, spot, sizes[free])
        return starts, sizes

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other (unsigned 32-bit), and how many each has.

        Texts are given as all their bytes and n + 1 offsets.
        """
        texts = len(offsets) - 1
        if not len(data):
            return np.zeros(0, "<u4"), np.zeros(texts, np.int64)
        low = data.tobytes().lower()
        if self._by_word and not any(mark in low for mark in self._special):
            return self._encode_words(data, offsets)
        raw, bounds = data.tobytes(), list(zip(offsets[:-1].tolist(), offsets[1:].tolist()))
        direct = [not self._by_word or any(m in low[a:b] for m in self._special) for a, b in bounds]
        coded = iter(self._direct([raw[a:b] for (a, b), x in zip(bounds, direct) if x]))
        others = [raw[a:b] for (a, b), x in zip(bounds, direct) if not x]
        ids, counts = self._encode_words(
            np.frombuffer(b"".join(others), np.uint8), np.cumsum([0, *map(len, others)]))
        ends = np.cumsum(counts)
        rest = iter([ids[b - n: b].tobytes() for b, n in zip(ends.tolist(), counts.tolist())])
        parts = [next(coded) if x else next(rest) for x in direct]
        return np.frombuffer(b"".join(parts), "<u4"), np.array([len(x) // 4 for x in parts])

    def _encode_words(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As ``encode``, for texts whose ids are those of their words."""
        if not len(data):
            return np.zeros(0, "<u4"), np.zeros(len(offsets) - 1, np.int64)
        begins, ends = word_bounds(data, offsets)
        low = lowered(data, begins, ends)
        hashes = word_hashes(low, begins, ends)
        order = np.argsort(hashes)
        hashes = hashes[order]
        new = np.ones(len(hashes), bool)
        new[1:] = hashes[1:] != hashes[:-1]
        first, which = order[new], np.empty(len(order), np.int64)
        which[order] = np.cumsum(new) - 1
        if len(self._keys) > self._max_words:
            self._forget()
        starts, sizes = self._look_up(
            low.tobytes(), begins[first], ends[first], hashes[new],
            word_hashes(low, begins[first], ends[first], SECOND),
        )
        count = sizes[which].astype(np.int64)
        stop = np.cumsum(count)
        spots = np.repeat(starts[which] - (stop - count), count) + np.arange(stop[-1] if len(stop) else 0)
        before = np.concatenate([[0], stop])
        return self._flat[spots], np.diff(before[np.searchsorted(begins, offsets)])


def with_end(ids: np.ndarray, counts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Put the end id after each text."""
    out = np.full(len(ids) + len(counts), end_id, "<u4")
    out[np.arange(len(ids)) + np.repeat(np.arange(len(counts)), counts)] = ids
    return out, counts + 1


@lru_cache(maxsize=4)
def encoder(path: str, special_as_text: bool = False) -> TextEncoder:
    """The encoder of this worker."""
    return TextEncoder(path, special_as_text)


def word_vocabulary() -> str:
    """The file of the public word tokenizer with 49,408 ids."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
