"""Repeated passages, similar documents and benchmark passages against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lodestrata.llm import bwt, components, decontamination, jaccard_join, suffix_dedup
from tests.llm.conftest import documents, edge_rows, made_texts


def column(parts):
    return np.frombuffer(b"".join(parts), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(int)


# ------------------------------------------------------------------ repeats


@pytest.mark.parametrize("seed", range(8))
def test_intervals_of_merged_transforms(seed):
    rng = random.Random(seed)
    base = bytes(rng.choice(b"ab" if seed % 2 else b"abcdefgh") for _ in range(400))
    strings = []
    for _ in range(rng.choice([1, 2, 30])):
        at = rng.randrange(250)
        part = bytearray(base[at: at + rng.choice([100, 101, 130, 150])])
        if rng.random() < 0.5:
            part[rng.randrange(len(part))] = 65
        strings.append(bytes(part))
    seen, want = set(), []
    for i, x in enumerate(strings):
        for j in range(len(x) - 99):
            if x[j: j + 100] in seen:
                want.append((i, j))
            seen.add(x[j: j + 100])
    for shards in (1, 2, 3, 4):
        string, place = suffix_dedup.repeated_windows(*column(strings), shards)
        assert list(zip(string.tolist(), place.tolist())) == want


def test_merge_gives_the_sorted_order_and_common_prefixes():
    data, offsets = column([b"abab" * 40, b"ababab" * 20, b"abca" * 30])
    chains = bwt.chains_of(data, offsets, 4)
    parts = [bwt.sort_suffixes(chains, np.flatnonzero(chains.string % 2 == k)) for k in (0, 1)]
    mix, common = bwt.merge(*(bwt.transform(chains, x) for x in parts))
    order = np.empty(len(mix), int)
    order[~mix], order[mix] = parts

    def symbols(i):
        found = []
        while chains.symbol[i]:
            found.append(int(chains.symbol[i]))
            i = chains.after[i]
        return found

    texts = [symbols(i) for i in order]
    assert texts == sorted(texts)
    for i in range(1, len(texts)):
        same = 0
        while same < min(len(texts[i]), len(texts[i - 1])) and texts[i][same] == texts[i - 1][same]:
            same += 1
        assert common[i] == same


def brute_repeats(rows):
    seen, found = set(), {}
    for doc, text in sorted(rows, key=lambda x: x[0]):
        raw = (text or "").encode()
        cover = bytearray(len(raw))
        for j in range(len(raw) - 99):
            if raw[j: j + 100] in seen:
                cover[j: j + 100] = b"\1" * 100
            seen.add(raw[j: j + 100])
        spans = len(re.findall(rb"\x01+", bytes(cover)))
        kept = bytes(x for x, c in zip(raw, cover) if not c)
        found[doc] = (len(raw), sum(cover), spans, hashlib.sha256(kept).hexdigest())
    return found


@pytest.mark.parametrize("limit", [50_000, 2])
def test_repeats(session, limit):
    rng = random.Random(limit)
    base = ["".join(rng.choice("ab é") for _ in range(n)) for n in (90, 150, 400)] + ["a" * 500]
    rows = made_texts(4, 120) + [
        (1000 + i, "".join(rng.choice(base)[rng.randrange(40):][: rng.choice([60, 99, 100, 101, 250])]
                           for _ in range(rng.choice([0, 1, 2, 4])))) for i in range(80)
    ]
    got = suffix_dedup.repeat_digests(documents(session, rows), limit).collect()
    assert {x.doc_id: tuple(x)[1:] for x in got} == brute_repeats(rows) and len(got) == len(rows)


def test_repeats_at_the_edges(session):
    got = suffix_dedup.op3_suffix_dedup(session, documents(session, edge_rows())).collect()
    assert len(got) == len(edge_rows())
    by = defaultdict(list)
    for x in got:
        by[x.doc_id].append(x)
    assert by[6][0].n_removed == by[6][0].n_bytes and by[6][0].kept_sha256 == hashlib.sha256().hexdigest()
    assert all(x.n_removed == 0 for x in by[None])
    assert by[7][0] == by[7][1] and by[7][0].n_removed > 0 and by[1][0].n_bytes == 0
    assert suffix_dedup.op3_suffix_dedup(session, documents(session, [])).count() == 0


@pytest.mark.parametrize("spans", [[None, None], [], [[], None], [None, [{"start": 3, "length": 4}]]])
def test_runs_of_batches_without_repeats(spans):
    column = pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32())])))
    assert list(suffix_dedup.runs_by_text(column)) == [[(3, 7)] if x else [] for x in spans]


def test_tables_and_batches_without_any_repeat(session):
    rows = [(i, " ".join(f"{i}-{j}" for j in range(60))) for i in range(40)] + [(50, None), (51, ""), (52, "a")]
    docs = documents(session, rows, 8)
    for x in suffix_dedup.repeat_digests(docs).collect():
        assert (x.n_removed, x.n_spans) == (0, 0)
    left = suffix_dedup.without_repeats(docs).select("doc_id", "text").collect()
    assert {tuple(x) for x in left} == set(rows) and len(left) == len(rows)
    # One text repeats, so most batches hold no span and one does.
    again = documents(session, [*rows, (60, rows[3][1])], 8)
    assert {x.doc_id for x in suffix_dedup.repeat_digests(again).collect() if x.n_removed} == {60}
    assert suffix_dedup.without_repeats(again).count() == len(rows)


def test_texts_without_repeats_stay_valid(session):
    text = "é" * 200
    rows = [(1, "x" + text), (2, "yy" + text + "end"), (3, None), (4, "x" + text), (None, text)]
    docs = documents(session, rows)
    got = {x.doc_id: x for x in suffix_dedup.without_repeats(docs).collect()}
    assert set(got) == {1, 2, 3, None} and got[3].text is None and got[None].text == text
    assert got[2].text == "yyend" and got[2].n_chars == 5
    assert got[1].n_chars == len(got[1].text) < 201 and got[3].n_chars == 7 and suffix_dedup.without_repeats(docs).columns == docs.columns


# ------------------------------------------------------------ similar documents


def brute_components(rows):
    sets = {}
    for doc, text in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", low)
        sets[doc] = {tuple(words[i: i + 5]) for i in range(len(words) - 4)} if len(words) > 4 else (
            {tuple(words)} if words else set())
    root = {x: x for x in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    docs = sorted(sets)
    for i, a in enumerate(docs):
        for b in docs[:i]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {x: (len(sets[x]), find(x)) for x in sets}


@pytest.mark.parametrize("block", [256, 3])
def test_components(session, monkeypatch, block):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    rows = made_texts(5, 150)
    got = jaccard_join.similar_documents(documents(session, rows)).collect()
    assert {x.doc_id: (x.n_shingles, x.component_id) for x in got} == brute_components(rows)


def test_components_at_the_edges(session):
    got = jaccard_join.op6_jaccard_join(session, documents(session, edge_rows() + [(11, "A"), (12, "a b"), (None, "a")]))
    rows = [tuple(x) for x in got.collect()]
    assert len(rows) == len(edge_rows()) + 3
    assert {(4, 1, 4), (11, 1, 4), (12, 1, 12), (1, 0, 1), (2, 0, 2), (3, 0, 3), (None, 1, 4), (None, 0, None)} <= set(rows)
    assert {x[2] for x in rows if x[0] in (5, 6)} == {5} and rows.count((7, 2, 7)) == 2
    assert jaccard_join.op6_jaccard_join(session, documents(session, [])).count() == 0


def test_nothing_linked_shares_less_than_is_asked_for(session):
    n = np.arange(1, 400)
    usual, longer = jaccard_join.prefix_length(n), jaccard_join.reach(n)
    need = np.array([x[0] for x in session.range(1, 400).orderBy("id").select(jaccard_join.least_shared(F.col("id"))).collect()])
    for x in n:
        for y in n[(5 * n >= 4 * x) & (4 * n <= 5 * x)]:
            for common in range(-(-4 * (x + y) // 9), min(x, y) + 1):
                a, b = x - common, y - common  # what each has alone may come first in the order
                assert min(longer[x - 1] - a, longer[y - 1] - b) >= need[x - 1], (x, y, common)
                assert min(usual[x - 1] - a, usual[y - 1] - b) >= 1, (x, y, common)


def test_a_set_within_one_larger_by_a_shingle(session):
    rows = [(1, "a b c d e f g h i"), (2, "a b c d e f g h"), (3, "q r s t u v w x"), (4, "p q r s t u v w x"), (5, "a b c d e f g")]
    got = jaccard_join.similar_documents(documents(session, rows)).collect()
    assert {x.doc_id: (x.n_shingles, x.component_id) for x in got} == brute_components(rows)
    assert sorted(x.doc_id for x in jaccard_join.one_per_group(documents(session, rows)).collect()) == [1, 3, 5]


def test_further_orders_cut_pairs_and_no_link(session):
    rng = random.Random(3)
    passage = " ".join(f"p{i}" for i in range(14))
    rows = [(i, " ".join(f"x{i}y{k}" for k in range(60)) + " " + passage) for i in range(30)]
    rows += [(100 + i, text + " tail") for i, text in rows[:10]] + [(200, None), (1, rows[1][1])]
    docs = documents(session, rows)
    sets, bands = jaccard_join.set_table(docs)
    key = {x.doc_id: x.k1 for x in sets.collect()}
    asked = [(i, 100 + i) for i in range(10)] + [tuple(rng.sample(range(30), 2)) for _ in range(40)]
    pairs = session.createDataFrame([(a, b, key[a], key[b]) for a, b in set(asked)], "a long, b long, a1 long, b1 long")
    got = sorted((x.a, x.b) for x in jaccard_join.meeting(pairs, docs, bands).collect())
    # A repeated row doubles no pair.  A passage in common comes late in the order, so it links nothing.
    assert got == [(i, 100 + i) for i in range(10)]
    assert jaccard_join.meeting(pairs.limit(0), docs, bands).count() == 0


def test_one_per_group(session):
    docs = documents(session, edge_rows())
    got = jaccard_join.one_per_group(docs)
    assert sorted(x.doc_id or 0 for x in got.collect()) == sorted(
        x or 0 for x, _ in edge_rows() if x != 6) and got.columns == docs.columns


def test_bitmap_bound_never_drops_a_link():
    rng = np.random.default_rng(1)
    for _ in range(200):
        n = int(rng.integers(1, 400))
        common = rng.integers(0, 2**63, n).astype(np.uint64)
        more = [rng.integers(0, 2**63, int(rng.integers(0, n // 4 + 1))).astype(np.uint64) for _ in range(2)]
        sets = [np.unique(np.concatenate([common, x])) for x in more]
        both = len(np.intersect1d(*sets))
        if 100 * both >= 80 * (len(sets[0]) + len(sets[1]) - both):
            maps = [jaccard_join.parity_bitmap(x) for x in sets]
            a, b = (int.from_bytes(x, "little") for x in maps)
            assert jaccard_join.may_be_similar(a, b, len(sets[0]), len(sets[1]), *(8 * len(x) for x in maps))


def test_connected(session):
    rng = random.Random(2)
    pairs = [(i, i + 1) for i in range(60)] + [(rng.randrange(100, 200), rng.randrange(100, 200)) for _ in range(60)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in pairs:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = components.connected(session.createDataFrame(pairs, "a long, b long")).collect()
    assert {x.node: x.root for x in got} == {x: find(x) for p in pairs for x in p if find(x) != x}


# ------------------------------------------------------------ benchmark passages


def edit_distance(pattern, text, anywhere=True):
    row = [0] * (len(text) + 1) if anywhere else list(range(len(text) + 1))
    for i, c in enumerate(pattern, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[-1] + 1))
        row = new
    return min(row) if anywhere else row[-1]


# Nothing is a common q-gram; many are; all of them and few places at once.
@pytest.mark.parametrize("common, expanded", [(64, 1 << 20), (1, 1 << 20), (0, 50)])
def test_passages_within_the_budget(monkeypatch, common, expanded):
    monkeypatch.setattr(decontamination, "COMMON", common)
    monkeypatch.setattr(decontamination, "EXPANDED", expanded)
    rng = random.Random(7)
    words = ["the", "of", "ation", "er", "and", "In", "qu", "zz."]
    items = ["".join(rng.choice(words) + " " for _ in range(n)).strip() for n in (3, 20, 30, 60)]
    index = decontamination.ItemIndex.of(list(range(4)), items)
    texts = []
    for _ in range(60):
        part = list(rng.choice(items))
        for _ in range(rng.randrange(0, len(part) // 12 + 1)):
            at, kind = rng.randrange(len(part)), rng.random()
            if kind < 0.3:
                part[at] = "x"
            elif kind < 0.6 or len(part) == 1:
                part.insert(at, "y")
            else:
                del part[at]
        text = "".join(part)
        text = text.upper() if rng.random() < 0.3 else text
        texts.append(rng.choice(["", "before  it\n"]) + text + rng.choice(["", " after"]))
    found = defaultdict(list)
    for text, item, start, length, distance in decontamination.find_passages(index, *column([x.encode() for x in texts])):
        found[text, item].append((distance, start, length))
    for i, text in enumerate(texts):
        folded = bytes(decontamination.normalised(*column([text.encode()]))[0])
        for item in range(4):
            pattern = bytes(index.text[index.offsets[item]: index.offsets[item + 1]])
            if len(pattern) < decontamination.Q:
                whole = re.search(rb"(?<![a-z0-9\x80-\xff])" + re.escape(pattern) + rb"(?![a-z0-9\x80-\xff])", folded)
                assert bool(whole) == ((i, item) in found)
                continue
            least = edit_distance(pattern, folded)
            assert (least <= index.edits[item]) == ((i, item) in found)
            for distance, start, length in found[i, item][:1]:
                part = text.encode()[start: start + length]
                assert distance == least == edit_distance(
                    pattern, bytes(decontamination.normalised(*column([part]))[0]), False)


def test_passages_in_documents(session):
    item = "what is the capital of the country that lies north of the great lake and its river"
    rows = edge_rows() + [(20, "text " * 50 + item.upper() + " more"), (21, item), (21, item), (22, item[:40])]
    items = session.createDataFrame([(1, item), (2, None), (None, "x" * 50), (3, "short"), (4, item)], "item_id long, text string")
    docs = documents(session, rows)
    got = decontamination.op1_decontamination(session, docs, items).collect()
    # Every text of the edges that holds the short item as a word of its own, and none other.
    assert Counter((x.doc_id, x.item_id) for x in got if x.item_id != 3) == {(20, 1): 1, (20, 4): 1, (21, 1): 2, (21, 4): 2}
    assert not [x for x in got if x.item_id == 3]
    assert all(x.distance == 0 for x in got)
    clean = decontamination.drop_contaminated(docs, items)
    assert sorted(x.doc_id or 0 for x in clean.collect()) == sorted(x or 0 for x, _ in rows if x not in (20, 21))
    assert clean.columns == docs.columns
    none = items.limit(0)
    assert decontamination.op1_decontamination(session, docs, none).count() == 0
    assert decontamination.drop_contaminated(docs, none).count() == len(rows)


def test_many_item_blocks(session, monkeypatch):
    items = session.createDataFrame([(i, f"item number {i} is about the thing called {i * i}") for i in range(9)], "item_id long, text string")
    monkeypatch.setattr(decontamination, "ITEM_BYTES", 100)
    assert len(list(decontamination.item_blocks(items, 100))) > 1
    assert sorted(i for b in decontamination.item_blocks(items, 100) for i in b.ids) == list(range(9))
    docs = documents(session, [(i, f"so item number {i} is about the thing called {i * i}, it says") for i in range(9)]
                     + [(20, "a text of its own"), (21, "item number")])
    assert {(x.doc_id, x.item_id) for x in decontamination.benchmark_passages(docs, items).collect()
            if x.distance == 0} == {(i, i) for i in range(9)}
    assert sorted(x.doc_id for x in decontamination.drop_contaminated(docs, items).collect()) == [20, 21]


def test_short_items_stand_by_themselves():
    items = ["x", "ab c", "q(a)", " Éa ", "a-b", "   ", "", "ninebytes", "tenbytesxx", "ab c"]
    index = decontamination.ItemIndex.of(list(range(len(items))), items)
    texts = ["an x.", "axe x1 éx", "AB  C d ab\nc", "q(a)q(a) (q(a))", "Éa. éÉa Éaé", "ca-bd a-b a-b-c", "", "NINEBYTES ninebytess",
             "tenbytesxx", "x", "b", "c"]
    found = {}
    for text, item, start, length, distance in decontamination.find_passages(index, *column([x.encode() for x in texts])):
        assert distance == 0
        found.setdefault(text, []).append((item, texts[text].encode()[start: start + length].decode()))
    assert found == {
        0: [(0, "x")], 2: [(1, "AB  C"), (1, "ab\nc"), (9, "AB  C"), (9, "ab\nc")], 3: [(2, "q(a)")] * 3,
        4: [(3, "Éa")], 5: [(4, "a-b"), (4, "a-b")], 7: [(7, "NINEBYTES")], 8: [(8, "tenbytesxx")], 9: [(0, "x")],
    }


def test_many_items_with_one_opening_phrase():
    """Bounded work at once, however many items and texts share a phrase; items that are little else are still found."""
    import resource

    phrase = "which of the following statements best describes the "
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(7))
    items = [phrase + " ".join(word() for _ in range(24)) for _ in range(3000)] + [phrase + "x", phrase + phrase]
    index = decontamination.ItemIndex.of(list(range(len(items))), items)
    texts = [phrase + word() for _ in range(2000)] + [items[7], items[2999].upper(), "so " + phrase + "x then", phrase + phrase]
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    found = decontamination.find_passages(index, *column([x.encode() for x in texts]))
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 500_000
    exact = {(text, item) for text, item, *_, distance in found if distance == 0}
    assert {(2000, 7), (2001, 2999), (2002, 3000), (2003, 3001)} <= exact
    assert not [x for x in found if x[0] < 2000 and x[1] < 3000]
