"""Learned operators, quality counts and archives."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from lodestrata.llm import decision_list, language_id, toxicity, warc
from lodestrata.llm.common import stored
from lodestrata.llm.queries import llm_oracles, llm_queries
from tests.llm.conftest import documents, edge_rows, made_texts

SF = "/root/testdata/sf0.01"


# ------------------------------------------------------------------ quality


def brute_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:]))
    again = {k for i in range(len(words) - 2) if windows[tuple(words[i: i + 3])] > 1 for k in range(i, i + 3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
            len(lines) - len(set(lines)), len(again))


def test_quality_counts(session):
    rows = edge_rows() + [(100 + i, x) for i, x in made_texts(6, 80)] + [
        (500, "a b c a b c\n\n#x\n#x \n#x\n"), (501, "a b c"), (502, "a a a a"), (503, "a b c \x0b d")]
    labels = session.createDataFrame([(i, 1, 0) for i in range(600)], "doc_id long, quality int, toxic int")
    got = decision_list.op4_quality(session, documents(session, rows), labels).collect()
    want = sorted((d or -1, *brute_counts(x)) for d, x in rows)
    assert sorted((x.doc_id or -1, *tuple(x)[1:6]) for x in got) == want
    for x in got:
        failed = x.n_words < 50 or 100 * x.n_repeat_words > 50 * x.n_words
        assert x.base_failed == failed and x.kept == (not failed)  # one label only: nothing is learned


def test_list_finds_a_planted_rule(session):
    rng = random.Random(1)
    rows = []
    for i in range(3000):
        n, symbols = rng.randrange(50, 500), rng.random()
        rows.append((i, n, 5.0, symbols, 0.0, 0.0, 0.5, 0.0, 0.1, 9.0, int(not (symbols > 0.6 and n < 300))))
    names = ["doc_id", *decision_list.FEATURES, "quality"]
    table = stored(session.createDataFrame(rows, names), "labelled")
    learned = decision_list.learn_list(table)
    verdict = table.select("quality", learned.keep().cast("int").alias("kept")).collect()
    assert sum(x.quality == x.kept for x in verdict) > 2900
    assert "symbol_share" in str(learned) and "n_words" in str(learned)


def test_list_of_nothing(session):
    empty = session.createDataFrame([], "doc_id long, text string")
    labels = session.createDataFrame([], "doc_id long, quality int")
    assert decision_list.op4_quality(session, empty, labels).count() == 0
    assert str(decision_list.DecisionList(())) == "else keep"


def test_quality_stays_in_the_engine(session):
    docs = session.read.parquet(f"{SF}/documents.parquet")
    plan = decision_list.text_statistics(docs)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)


# ------------------------------------------------------------------ toxicity


@pytest.fixture(scope="module")
def labelled(session):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(200)]
    rows, labels = [], []
    for i in range(1200):
        text = [rng.choice(words) for _ in range(rng.randrange(5, 60))]
        bad = i % 5 == 0
        if bad:
            text.insert(0, rng.choice(["Stinker", "rotters", "rotting"]))
        # A group is named far more often beside an insult than elsewhere.
        if rng.random() < (0.7 if bad else 0.02):
            text.append("muslims")
        rows.append((i, " ".join(text)))
        labels.append((i, 1, int(bad)))
    return rows, session.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity_on_held_out_rows(session, labelled):
    rows, labels = labelled
    got = toxicity.op8_toxicity(session, documents(session, rows), labels).collect()
    held = [x for x in got if x.held_out]
    assert 150 < len(held) < 350 and all(0 <= x.score <= 1 for x in got)
    assert sum(x.predicted == (x.doc_id % 5 == 0) for x in held) >= 0.98 * len(held)


def test_pairs_keep_neutral_mentions_low(session, labelled, monkeypatch):
    rows, labels = labelled
    docs = documents(session, rows)
    # Some words of the pair must be known to the classifier for a difference to count.
    paired = toxicity.fit_classifier(docs, labels)
    monkeypatch.setattr(toxicity, "PAIR_WEIGHT", 0.0)
    plain = toxicity.fit_classifier(docs, labels)
    lift = [x.logit({"w1", "muslims"}) - x.logit({"w1"}) for x in (paired, plain)]
    assert lift[0] < 0.5 * lift[1] and lift[1] > 0.3
    assert paired.logit({"w1", "muslims"}) < 0 < paired.logit({"stinker"})


def test_swaps_are_made_one_at_a_time_within_sentences():
    swaps = {"black": "white", "white": "black", "muslims": "jews", "jews": "muslims"}
    got = sorted((sorted(words), term, other) for words, term, other in toxicity.swapped_sentences(
        "Black and white. None here!\nMuslims", swaps))
    assert got == [(["and", "black", "white"], "black", "white"), (["and", "black", "white"], "white", "black"),
                   (["muslims"], "muslims", "jews")]
    assert list(toxicity.swapped_sentences(None, swaps)) == list(toxicity.swapped_sentences("", swaps)) == []


def test_learned_kinds_leave_out_what_stands_alone():
    got = toxicity.all_swaps({"a": "men women"}, [("trees", 40), ("bees", 50), ("men", 9), ("bees2", 3), ("fees", 70)])
    assert got == {"men": "women", "women": "men", "trees": "bees", "bees": "trees"}


def test_learned_terms_are_neutral_and_their_swaps_cost_little(session, monkeypatch):
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdef") for _ in range(4)) + "en" for _ in range(60)]
    rows, labels = [], []
    for i in range(800):
        bad = i % 4 == 0
        # Half of the words are somewhat commoner in toxic texts.
        text = [rng.choice(words[:30] if bad and rng.random() < 0.3 else words) for _ in range(20)]
        rows.append((i, " ".join(text[:10]) + ". " + " ".join(text[10:] + ["stinker"] * bad)))
        labels.append((i, 1, int(bad)))
    docs, labels = documents(session, rows), session.createDataFrame(labels, "doc_id long, quality int, toxic int")
    paired = toxicity.fit_classifier(docs, labels, kinds={})
    monkeypatch.setattr(toxicity, "PAIR_WEIGHT", 0.0)
    plain = toxicity.fit_classifier(docs, labels, kinds={})
    assert paired.swaps == plain.swaps and paired.n_pairs > 100
    assert 20 < len(paired.swaps) and set(paired.swaps) <= set(words)
    held = docs.filter("crc32(cast(doc_id as string)) % 5 = 0")
    near, far = (toxicity.score_shift(held, x).first() for x in (paired, plain))
    assert near.n_swaps == far.n_swaps > 0 and near.shift < 0.2 * far.shift
    assert paired.logit({"stinker"}) > 0 > paired.logit(set(words[:3]))
    nothing = toxicity.score_shift(documents(session, [(1, None), (2, "")]), paired).first()
    assert (nothing.n_swaps, nothing.shift) == (0, None)


def test_pairs_by_brute_force(session):
    rows = [(1, "abcd xyz. abcd"), (2, "abce abcd xyz"), (3, None), (4, "abcd")]
    spot, swaps = {"=abcd": 0, "abcd": 1, "=abce": 2, "=xyz": 3}, {"abcd": "abce", "xyz": "none"}
    got = toxicity.counterfactual_pairs(documents(session, rows), spot, swaps)
    expected: dict = {}
    for _, text in rows:
        for sentence in (text or "").split("."):
            words = set(sentence.split())
            for term in words & swaps.keys():
                before, after = (toxicity.features_of(x) & spot.keys() for x in (words, words - {term} | {swaps[term]}))
                if before != after:
                    key = (tuple(sorted(spot[x] for x in before - after)), tuple(sorted(spot[x] for x in after - before)))
                    expected[key] = expected.get(key, 0) + 1
    assert {(tuple(x), tuple(y)): n for x, y, n in got} == expected
    assert toxicity.counterfactual_pairs(documents(session, rows), spot, {}) == []


def test_toxicity_at_the_edges(session, labelled):
    rows, labels = labelled
    got = toxicity.op8_toxicity(session, documents(session, edge_rows()), labels).collect()
    assert len(got) == len(edge_rows()) and all(x.held_out for x in got if x.doc_id is None)
    empty = labels.limit(0)
    got = toxicity.op8_toxicity(session, documents(session, rows[:5]), empty).collect()
    assert {(x.score, x.predicted) for x in got} == {(0.5, 1)}
    assert toxicity.op8_toxicity(session, documents(session, []), empty).count() == 0
    odd = session.createDataFrame([(1, 1, None), (None, 1, 1), (2, 0, 7)], "doc_id long, quality int, toxic int")
    assert toxicity.op8_toxicity(session, documents(session, rows[:5]), odd).count() == 5


def test_drop_toxic_keeps_columns(session):
    docs = documents(session, [(1, "fine text"), (2, "a stinker"), (3, None)])
    got = toxicity.drop_toxic(docs, toxicity.Classifier({"=stinker": 5.0}, -2.0))
    assert sorted(x.doc_id for x in got.collect()) == [1, 3] and got.columns == docs.columns


def test_fit_sees_no_held_out_rows(session, labelled):
    rows, labels = labelled
    import zlib

    sample = toxicity.labelled_sample(documents(session, rows), labels)
    assert all(zlib.crc32(str(x.doc_id).encode()) % 5 for x in sample.collect())
    assert toxicity.labelled_sample(documents(session, rows), labels, rows=200).count() < 320


# ------------------------------------------------------------------ languages


def mixed(gram: bytes) -> int:
    """An n-gram as the operator numbers it."""
    return (int.from_bytes(gram, "little") * 0x9E3779B97F4A7C15 & (1 << 64) - 1) >> 32


def test_grams_of_texts():
    texts = ["Ab, cd", "", "x", "  a  b  ", "été"]
    raw = [x.encode() for x in texts]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(int)
    grams, counts = language_id.grams_of(np.frombuffer(b"".join(raw), np.uint8), offsets)
    got, at = [], 0
    for n in counts:
        got.append(grams[at: at + n].tolist())
        at += n
    for text, found in zip(texts, got):
        folded = b" " + re.sub(rb"[^a-z\x80-\xff]+", b" ", text.lower().encode()).strip() + b" "
        assert found == [mixed(folded[i: i + 6]) for i in range(len(folded) - 5)]


def test_filter_against_sets(session):
    """The languages that contain each n-gram, the shares and the choice, by plain sets."""
    rng = random.Random(4)
    words = {lang: ["".join(rng.choice(signs) for _ in range(rng.choice([3, 5, 8]))) for _ in range(60)]
             for lang, signs in (("aa", "abcdefg"), ("bb", "defghijé"), ("cc", "ghijklmñ"))}
    rows = []
    for i in range(300):
        lang = rng.choice(sorted(words))
        mix = words[lang] + words[rng.choice(sorted(words))][:10]
        rows.append((i, " ".join(rng.choice(mix) for _ in range(rng.choice([1, 4, 40]))), lang))
    docs = session.createDataFrame(rows, "doc_id long, text string, lang string")

    def cut(text):
        folded = b" " + re.sub(rb"[^a-z\x80-\xff]+", b" ", text.lower().encode()).strip() + b" "
        return [mixed(folded[i: i + 6]) for i in range(len(folded) - 5)]

    model = language_id.learn_filter(docs)
    learned = {lang: {g for i, text, x in rows if x == lang and zlib.crc32(str(i).encode()) % 4 != 2 for g in cut(text)}
               for lang in words}
    every = sorted(set().union(*learned.values()))
    spots = language_id.cells_of(np.array(every, np.uint32), model.bits, model.hashes)
    masks = np.bitwise_and.reduce([model.cells[0][x] for x in spots])
    for bit, lang in enumerate(model.languages):
        hits = {g for g, mask in zip(every, masks.tolist()) if mask >> bit & 1}
        # None is missed, and hardly any comes in by chance.
        assert learned[lang] <= hits and len(hits - learned[lang]) <= 3
    right = 0
    for x in language_id.identify(docs, model).collect():
        grams = cut(rows[x.doc_id][1])
        shares = [sum(g in learned[lang] for g in grams) / max(len(grams), 1) for lang in model.languages]
        best = max(shares)
        if best and sum(best - s < 0.01 for s in shares) == 1:
            assert x.lang_pred == model.languages[shares.index(best)]
            assert abs(x.score - best / sum(shares)) < 0.02
        right += x.lang_pred == rows[x.doc_id][2]
    assert right > 250


def test_languages_of_documents(session):
    docs = session.read.parquet(f"{SF}/documents.parquet")
    got = language_id.op10_language_id(session, docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [x for x in got if x.held_out]
    assert len(held) > 150 and sum(x.lang == x.lang_pred for x in held) >= 0.98 * len(held)


def test_languages_at_the_edges(session):
    docs = documents(session, edge_rows()).drop("lang")
    from pyspark.sql import functions as F

    docs = docs.withColumn("lang", F.when(F.col("doc_id") > 4, "en").when(F.col("doc_id") == 4, "aa"))
    got = {x.doc_id: x for x in language_id.op10_language_id(session, docs).collect()}
    assert got[1].lang_pred == got[2].lang_pred == got[3].lang_pred == "und" and got[1].score == 0
    assert got[5].lang_pred == "en" and 0 <= got[5].score <= 1
    unlearned = language_id.op10_language_id(session, docs.withColumn("lang", F.lit(None).cast("string")))
    assert {x.lang_pred for x in unlearned.collect()} == {"und"}
    assert language_id.op10_language_id(session, docs.limit(0)).count() == 0


def test_a_language_of_one_short_row(session):
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 4 != 2]
    rows = [(i, "the cat sat on the mat and the dog", "en") for i in ids[1:]] + [(ids[0], "zwölf boxkämpfer jagen", "de")]
    docs = session.createDataFrame(rows, "doc_id long, text string, lang string")
    new = session.createDataFrame([(1, "zwölf boxkämpfer"), (2, "the cat and the dog")], "doc_id long, text string")
    got = language_id.identify(new, language_id.learn_filter(docs)).collect()
    assert {x.doc_id: x.lang_pred for x in got} == {1: "de", 2: "en"}


def test_more_than_64_languages(session):
    from pyspark.sql import functions as F

    rng, rows = random.Random(3), []
    for i in range(70):
        letters = [chr(0x400 + 3 * i + k) for k in range(3)]
        rows += [(100 * i + k, " ".join("".join(rng.choices(letters, k=4)) for _ in range(60)), f"l{i:02d}") for k in range(6)]
    docs = session.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.learn_filter(docs)
    assert model.cells.shape[0] == 2
    got = language_id.identify(docs, model).join(docs.select(F.col("doc_id"), "lang"), "doc_id")
    assert got.filter("lang = lang_pred").count() > 0.95 * len(rows)


# ------------------------------------------------------------------ archives

HTML = "<p>" + "page " * 40
PAGES = [
    (5, "http://a.org/x?y=1", HTML), (2, "http://b.org/ü x\r\nz", HTML), (9, None, HTML), (9, None, HTML), (3, "u", "small"),
    (4, "v", "small"), (6, "", None), (7, "w", ""), (None, "n", HTML), (8, "x", "WARC/1.1\r\n\r\n" * 50 + "é"),
    (10, "y", "x" * 3_000_000),
]


def pages(session, rows):
    from pyspark.sql import functions as F

    df = session.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    return df.withColumn("digest", F.lit(1)).withColumn("first", F.lit(2)).withColumn("refers_to", F.lit(3))


def test_archives(session):
    got = warc.op5_warc(session, pages(session, PAGES)).collect()
    first = 2
    want = []
    for page, _, html in PAGES:
        raw = (html or "").encode()
        again = html == HTML and page != first
        want.append((page, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", first if again else None))
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert warc.op5_warc(session, pages(session, [])).count() == 0


def test_captures_hold_payload_request_and_metadata(session):
    from lodestrata.session import fresh_dir

    folder = fresh_dir(session, "warc")
    files = warc.write_archives(warc.with_revisits(pages(session, PAGES)), folder, file_bytes=1000)
    names = [x.file for x in files.collect()]
    assert len(names) > 1
    records = stored(warc.read_archives(session, folder, names), "records")
    assert records.count() == 3 * len(PAGES)
    got = {x.page_id: x for x in warc.assemble(records).collect()}
    assert bytes(got[8].payload).decode() == PAGES[9][2] and got[5].payload is None
    assert got[5].request.head.startswith("GET /x?y=1 HTTP/1.1\r\nHost: a.org") and got[5].requests == 1
    assert got[2].target_uri == "http://b.org/ü%20x%0D%0Az" and got[2].metadata.head == "page-id: 2\r\n"


def test_assembly_of_foreign_records(session):
    def row(name, kind, to=()):
        return (name, kind, None, None, list(to), None, "", 0, "", None)

    records = session.createDataFrame([
        row("<r1>", "response"), row("<q1>", "request", ["<r1>"]), row("<q2>", "request", ["<r1>"]),
        row("<r2>", "response", ["<q3>"]), row("<q3>", "request"), row("<m>", "metadata", ["<gone>"]),
        row("<i>", "warcinfo"), row("<r3>", "resource"),
    ], warc.RECORD_DDL)
    got = {x.record_id: x for x in warc.assemble(records).collect()}
    assert set(got) == {"<r1>", "<r2>", "<r3>"}
    assert got["<r1>"].requests == 2 and got["<r1>"].request.record_id == "<q1>"
    assert got["<r2>"].request.record_id == "<q3>" and got["<r3>"].request is None and got["<r3>"].metadatas == 0


def test_damaged_archives_are_noticed(session, tmp_path):
    raw = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Payload-Digest: sha256:00\r\nContent-Length: 1\r\n\r\nx\r\n\r\n"
    (tmp_path / "a.warc").write_bytes(raw)
    (tmp_path / "b.warc").write_bytes(raw[:-6])
    for name, text in (("a.warc", "match its digest"), ("b.warc", "cut off")):
        with pytest.raises(Exception, match=text):
            warc.read_archives(session, str(tmp_path), [name]).collect()


# ------------------------------------------------------------------ registry


def test_registry():
    assert sorted(int(x[2:].split("_")[0]) for x in llm_queries()) == list(range(1, 14))
    assert set(llm_oracles()) <= set(llm_queries())


def test_archives_equal_their_sql(session):
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{SF}/pages.parquet'")
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    want = con.sql(f"select {', '.join(names)} from ({llm_oracles()['op5_warc']})").fetchall()
    got = [tuple(x) for x in llm_queries()["op5_warc"](session, SF).select(names).collect()]
    assert sorted(got) == sorted(want)


def test_pipeline(session):
    import corpus_pipeline

    docs = session.read.parquet(f"{SF}/documents.parquet")
    names = docs.columns
    assert 4 <= len(corpus_pipeline.STAGES) <= 5 and corpus_pipeline.ORACLE_SQL is None
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(session, docs, SF), name)
        assert docs.columns == names
        counts.append(docs.count())
    assert counts[1] < counts[0] and counts[2] < counts[1] and counts[4] < counts[3]
    last = corpus_pipeline.STAGES[-1][1](session, docs, SF)
    assert last.select("doc_id").distinct().count() == counts[4]
