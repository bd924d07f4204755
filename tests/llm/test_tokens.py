"""Encoding, packed files, flat files and packing."""

from __future__ import annotations

import random
import string
import unicodedata
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from lodestrata.llm import packing, separators, simple8b
from lodestrata.llm.common import stored
from lodestrata.llm.tokens import TextEncoder, with_end, word_vocabulary
from lodestrata.session import fresh_dir
from tests.llm.conftest import documents, edge_rows, made_texts

ODD = ["It's, the..", "don't.'s, l'été ÉTÉ ét a", "\x1c\x1d a.b,c., '. ,", "", " ", "ﬁ ǅ ß İ ΑΣ, Σ. ς",
       "a\u0085b\x0c 12,3.5 x1.", "'s 'S. 'll, we'LL.", "x" * 3000 + " é" * 900, "日本語。テスト, a,.b é, É."]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(word_vocabulary())


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def column(texts):
    raw = [x.encode() for x in texts]
    bounds = np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64)
    return np.frombuffer(b"".join(raw), np.uint8), bounds


@pytest.mark.parametrize("texts", [ODD, ODD + ["a <|endoftext|> b <|ENDOFTEXT|>"], [], [""], ["", "a"]])
def test_encoder_equals_the_tokenizer(tokenizer, texts):
    ids, counts = TextEncoder(word_vocabulary()).encode(*column(texts))
    parts = np.split(ids, np.cumsum(counts)[:-1]) if len(counts) else []
    assert [x.tolist() for x in parts] == [ids_of(tokenizer, x) for x in texts]


@pytest.mark.parametrize("base", ["J\u030c", "H\u0331", "T\u0308", "W\u030a", "Y\u030a"])
def test_encoder_with_marks_that_compose_in_lower_case_only(tokenizer, base):
    texts = [base, f"{base}ad and {base.lower()}ad", f"x. {base}an,{base}an É{base}", "plain Words only",
             base[0] + "\u0323" + base[1:] + "q", base[0] + "\u20d2" + base[1:] + "q", base[0] + "\u05b0" + base[1:]]
    ids, counts = TextEncoder(word_vocabulary()).encode(*column(texts))
    parts = np.split(ids, np.cumsum(counts)[:-1])
    assert [x.tolist() for x in parts] == [ids_of(tokenizer, x) for x in texts]


def test_encoder_with_every_mark_after_every_letter(tokenizer):
    marks = [chr(x) for x in range(0x110000) if unicodedata.combining(chr(x))]
    texts = [" ".join(f"{letter}{mark}a" for mark in marks) for letter in string.ascii_letters]
    ids, counts = TextEncoder(word_vocabulary()).encode(*column(texts))
    parts = np.split(ids, np.cumsum(counts)[:-1])
    assert [x.tolist() for x in parts] == [ids_of(tokenizer, x) for x in texts]


def test_encoder_that_forgets(tokenizer):
    code = TextEncoder(word_vocabulary(), max_words=3)
    for text in ODD:
        assert code.encode(*column([text]))[0].tolist() == ids_of(tokenizer, text)


def test_encoder_learns_a_word_once(tokenizer, monkeypatch):
    code, learned, learn = TextEncoder(word_vocabulary()), [], TextEncoder._learn
    monkeypatch.setattr(TextEncoder, "_learn", lambda self, words: learned.append(len(words)) or learn(self, words))
    letters = string.ascii_lowercase[:22]
    # 468,512 different words, each text with some of its own.
    texts = [" ".join(a + b + c + d + e for b in letters for c in letters for d in letters for e in "xy") for a in letters]
    first = [code.encode(*column([x]))[0].tolist() for x in texts]
    assert sum(learned) == 2 * len(letters) ** 4
    assert [code.encode(*column([x]))[0].tolist() for x in texts] == first
    assert sum(learned) == 2 * len(letters) ** 4
    assert first[0] == ids_of(tokenizer, texts[0])


def test_encoder_with_words_of_one_hash(tokenizer):
    code, texts = TextEncoder(word_vocabulary()), ["one word and another one", "another word"]
    code.encode(*column(texts))
    # As if other words with these hashes had come first.
    code._checks ^= np.uint64(1)
    code._flat = code._flat * 0
    for _ in range(2):
        assert code.encode(*column(texts))[0].tolist() == [i for x in texts for i in ids_of(tokenizer, x)]


def test_encoder_with_special_names_between_texts(tokenizer):
    texts = ["plain text", "a <|endoftext|> b", "", "ends with <", "| begins", "more <", "|plain text"]
    ids, counts = TextEncoder(word_vocabulary()).encode(*column(texts))
    parts = np.split(ids, np.cumsum(counts)[:-1])
    assert [x.tolist() for x in parts] == [ids_of(tokenizer, x) for x in texts]


def test_with_end():
    ids, counts = with_end(np.array([5, 6, 7], "<u4"), np.array([0, 2, 1, 0]), 1)
    assert ids.tolist() == [1, 5, 6, 1, 7, 1, 1] and counts.tolist() == [1, 3, 2, 1]


@pytest.mark.parametrize("high", [1, 2, 300, 49_408, 2**33, 2**63])
@pytest.mark.parametrize("size", [0, 1, 1023, 1024, 1025, 5000])
def test_packing_words_round_trip(high, size):
    rng = np.random.default_rng(size)
    ids = rng.integers(0, high, size).astype(np.uint64)
    ids[size // 3: size // 2] = 0
    words, starts, escapes = simple8b.pack(ids)
    assert (simple8b.unpack(words, starts, escapes, size) == ids).all()
    assert (simple8b.unpack_all(words, starts, escapes, size) == ids).all()


def test_files_in_segments():
    rng, file, given = np.random.default_rng(3), simple8b.FilePacker(), []
    for _ in range(4):
        counts = rng.integers(0, 150_000, 3)
        ids = rng.integers(0, 2**62, counts.sum()).astype(np.uint64)
        given.append((rng.integers(-9, 9, 3), counts, ids))
        file.add(*given[-1])
    for got, want in zip(simple8b.parse_file(b"".join(file.parts())), zip(*given)):
        assert (got == np.concatenate(want)).all()


@pytest.mark.parametrize("file_ids", [50, 10**6])
def test_packed_files(session, tokenizer, file_ids):
    rows = [x for x in edge_rows() if x[0] is not None] + [(100 + i, x) for i, x in made_texts(1, 60)]
    folder = fresh_dir(session, "packed")
    manifest = simple8b.write_packed(documents(session, rows), word_vocabulary(), 2, folder, file_ids)
    got = simple8b.packed_digests(session, folder, manifest).orderBy("start").collect()
    start = 0
    for row, (doc, text) in zip(got, sorted(rows, key=lambda x: (x[0], x[1] or "")), strict=True):
        ids = np.array([*ids_of(tokenizer, text), 2], "<u4")
        assert tuple(row) == (doc, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    whole = simple8b.read_packed(session, folder, manifest).filter("doc_id = 4").first()
    assert whole.ids == [*ids_of(tokenizer, "a"), 2]


def test_packed_null_id_and_empty_table(session):
    got = simple8b.op7_token_output(session, documents(session, [(None, "a"), (3, "b")]), word_vocabulary())
    assert [x.doc_id for x in got.orderBy("start").collect()] == [None, 3]
    assert simple8b.op7_token_output(session, documents(session, []), word_vocabulary()).count() == 0


def test_flat_files(session, tokenizer):
    rows = edge_rows() + [(100 + i, x) for i, x in made_texts(2, 40)] + [(900, "a <|endoftext|> b")]
    folder = fresh_dir(session, "flat")
    where = stored(separators.write_flat(documents(session, rows), word_vocabulary(), folder, file_tokens=500), "w")
    tokenizer.encode_special_tokens = True
    want = sorted((d or -1, len(ids_of(tokenizer, x))) for d, x in rows)
    tokenizer.encode_special_tokens = False
    for block in (7, 64, 1 << 20):
        counted = separators.count_tokens(session, folder, block_tokens=block)
        got = counted.join(where, ["file", "ordinal"]).collect()
        assert sorted((x.doc_id or -1, x.n_tokens) for x in got) == want
        assert all(x.ended for x in got)


def test_flat_file_without_a_last_end(session):
    folder = fresh_dir(session, "flat")
    from lodestrata.llm.common import write_file

    write_file(f"{folder}/x.tokens", [np.array([5, 9, 9, 5, 5, 9, 7, 7], "<u2").tobytes()])
    got = separators.count_tokens(session, folder, end_id=9, block_tokens=3).orderBy("ordinal").collect()
    assert [(x.ordinal, x.start, x.n_tokens, x.ended) for x in got] == [
        (0, 0, 1, True), (1, 2, 0, True), (2, 3, 2, True), (3, 6, 2, False)]
    assert separators.count_tokens(session, fresh_dir(session, "none")).count() == 0
    assert separators.op9_token_counts(session, documents(session, []), word_vocabulary()).count() == 0


def check_packed(rows, capacity):
    spots = defaultdict(list)
    for x in rows:
        spots[x.sequence_id].append((x.offset, x.length))
    for parts in spots.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(spots)


@pytest.mark.parametrize("seed", range(4))
def test_plan_places_every_rank_once(seed):
    rng = random.Random(seed)
    counts = {rng.randrange(1, 101): rng.randrange(1, 40) for _ in range(rng.choice([1, 5, 60]))}
    plan = packing.PackingPlan(dict(counts), 100, groups=rng.choice([1, 4, 30]))
    length = np.repeat(list(counts), list(counts.values()))
    rank = np.concatenate([np.arange(n) for n in counts.values()])
    sequence, offset = plan.places(length, rank)
    used = defaultdict(list)
    for s, o, n in zip(sequence, offset, length):
        used[s].append((o, n))
    assert len(used) == plan.sequences
    for parts in used.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= 100
    assert len(used) <= 1.7 * -(-length.sum() // 100) + 1


def test_pack_documents(session, tokenizer):
    rows = edge_rows() + [(100 + i, x) for i, x in made_texts(3, 200)]
    got = packing.pack_documents(documents(session, rows), word_vocabulary(), capacity=256).collect()
    used = check_packed(got, 256)
    assert used <= 1.05 * sum(x.length for x in got) / 256 + 1
    texts = dict(rows)
    for doc in (1, 2, 4, 5, 8, 150):
        ids = np.array([*ids_of(tokenizer, texts[doc]), 1], "<u4")
        parts = sorted((x for x in got if x.doc_id == doc), key=lambda x: x.piece)
        assert [x.piece for x in parts] == list(range(-(-len(ids) // 256)))
        for x in parts:
            part = ids[x.start: x.start + 256]
            assert (x.length, x.ids_crc32) == (len(part), zlib.crc32(part.tobytes()))
    assert packing.op2_packing(session, documents(session, []), word_vocabulary()).count() == 0


def test_sequences_hold_the_ids(session, tokenizer):
    rows = [(1, "one two three"), (2, "four"), (3, None)]
    got = packing.packed_sequences(documents(session, rows), word_vocabulary(), capacity=64).collect()
    assert len(got) == 1
    want = sorted([*ids_of(tokenizer, x), 1] for _, x in rows)
    ids, parts, part = got[0].ids, [], []
    for x in ids:
        part.append(x)
        if x == 1:
            parts.append(part)
            part = []
    assert sorted(parts) == want
