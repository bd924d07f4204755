"""How much of a table is in work at once."""

from __future__ import annotations

import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from lodestrata.llm import common, decontamination, jaccard_join, packing, suffix_dedup, toxicity
from lodestrata.llm.tokens import word_vocabulary
from tests.llm.conftest import documents, made_texts


def batch_of(texts):
    return pa.record_batch({"doc_id": list(range(len(texts))), "text": texts})


def test_large_batches_come_in_slices():
    large = batch_of(["x" * 1000] * 300 + [None, "", "y" * 50_000])
    small = large.slice(0, 2)
    for cut in (common.grouped, common.bounded):
        got = list(cut([large, large.slice(0, 0), small, small], 8_000))
        assert [i for x in got for i in x["doc_id"].to_pylist()] == [*range(303), 0, 1, 0, 1]
        assert pa.Table.from_batches(got)["text"].to_pylist() == (large["text"].to_pylist() + ["x" * 1000] * 4)
        assert all(x.nbytes < 16_000 or x.num_rows == 1 or x["text"].to_pylist()[-1] == "y" * 50_000 for x in got)
        assert len([x for x in got if x.nbytes >= 16_000]) == 1


def test_a_scan_takes_the_memory_of_a_small_batch():
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9))) for _ in range(3000)]
    items = [" ".join(rng.choice(words) for _ in range(30)) for _ in range(50)]
    index = decontamination.ItemIndex.of(list(range(50)), items)
    texts = [" ".join(rng.choice(words) for _ in range(500)) for _ in range(400)] * 12
    texts[7] = f"before {items[3]} after"
    found, done = [], 0
    tracemalloc.start()
    for batch in common.grouped([batch_of(texts)], decontamination.SCAN_BYTES):
        passages = decontamination.find_passages(index, *common.column_bytes(batch["text"]))
        found += [(done + text, item) for text, item, *_ in passages]
        done += batch.num_rows
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert done == len(texts) and found == [(7, 3)]
    # The batch holds some 15 MB of text; at eighty times as many the scan would take over 1,000 MB.
    assert peak < 220 << 20


@pytest.mark.parametrize("size", [1, 90, 1000, 1 << 20])
def test_contexts_of_some_texts_at_a_time(size):
    texts = [x for _, x in made_texts(3, 40)] + ["", "z" * 99, "z" * 100, "ab" * 700, None, ""]
    for part in (texts, texts[-2:], texts[:1], []):
        data, offsets = common.column_bytes(pa.array(part, pa.string()))
        whole = suffix_dedup.window_contexts(data, offsets)
        got = suffix_dedup.contexts_of(data, offsets, size)
        assert all(np.array_equal(x, y) and x.dtype == y.dtype for x, y in zip(got, whole, strict=True))


def test_rows_that_come_twice_are_one_document(session):
    rng = random.Random(9)
    rows = [(i, " ".join(rng.choice(["ab", "cde", "f", "ghij"]) + str(rng.randrange(9999)) for _ in range(180))) for i in range(500)]
    once = suffix_dedup.repeat_digests(documents(session, rows, 1)).collect()
    assert all(x.n_removed == 0 for x in once)
    # Some 0.6 MB, and the same again: more than is in work at once, less than copies are known among.
    twice = suffix_dedup.repeat_digests(documents(session, rows * 2, 1)).collect()
    assert Counter(map(tuple, twice)) == Counter(map(tuple, once * 2))


@pytest.mark.parametrize("size", [300, 5_000])
def test_slices_give_the_same_rows(session, monkeypatch, size):
    rows = made_texts(11, 60) + [(900, None), (901, ""), (902, "again " * 400)]
    docs = documents(session, rows)
    items = session.createDataFrame([(1, next(x for _, x in rows if x and len(x) > 200)[:120])], "item_id long, text string")

    def results():
        return [Counter(map(tuple, x.collect())) for x in (
            suffix_dedup.repeat_digests(docs), suffix_dedup.without_repeats(docs), suffix_dedup.repeat_digests(docs, 2),
            jaccard_join.similar_documents(docs), decontamination.benchmark_passages(docs, items),
            decontamination.drop_contaminated(docs, items), packing.cut_pieces(docs, word_vocabulary(), 1),
        )]

    whole = results()
    for module in (suffix_dedup, jaccard_join, decontamination, packing, toxicity):
        monkeypatch.setattr(module, "SCAN_BYTES", size)
    monkeypatch.setattr(suffix_dedup, "CHUNK_BYTES", size)
    assert results() == whole
