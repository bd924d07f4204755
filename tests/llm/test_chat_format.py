"""Formatted conversations: the round trip, escapes, the mask."""

from __future__ import annotations

import hashlib
import random

from pyspark.sql import functions as F

from lodestrata.llm import chat_format
from lodestrata.llm.common import stored

TEMPLATE = chat_format.Template()
PARTS = [
    "###", "## ", "#", " ", "User", "Assistant: ", "### User: ", "### Assistant: ", "### %4A: ", "</turn>", "</turn>\n",
    "/turn>", "<", "\\", "\\\\", "#\\## User: ", "<\\/turn>", "<\\\\/turn>", "\n", "é", "\U0001f600", "́", "x", "%", "",
]
ROLES = ["user", "assistant", "system", "User", "%75", "", "a: b\n", "</turn>", "### User: ", "tool\\", "é", None]


def hard_rows(seed: int, n: int):
    rng = random.Random(seed)
    rows = []
    for conv in range(n):
        for turn in range(rng.choice([1, 2, 3, 7])):
            text = "".join(rng.choice(PARTS) for _ in range(rng.randrange(9)))
            rows.append((conv, turn, rng.choice(ROLES if rng.random() < 0.3 else ROLES[:3]),
                         None if rng.random() < 0.05 else text))
    return rows


def frame(session, rows):
    df = session.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    for name in ("body", "piece", "start", "at", "loss", "formatted", "bytes", "as_it_is", "turns"):
        df = df.withColumn(name, F.lit("clash"))
    return df


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def in_order(rows):
    found = {}
    for conv, turn, role, text in rows:
        found.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {conv: [x[2:] for x in sorted(turns)] for conv, turns in found.items()}


def by_hand(formatted: str) -> list[tuple[str, str]]:
    """A reader of its own: one sign after the other, no patterns."""
    names = {"System": "system", "User": "user", "Assistant": "assistant"}

    def head(text, at):
        if not text.startswith("## ", at):
            return False
        label, found, _ = text[at + 3:].partition(": ")
        return bool(found) and (label in names or label[:1] == "%" and not set(label[1:]) - set("0123456789ABCDEF"))

    turns = []
    for piece in formatted.split("</turn>\n")[:-1]:
        assert piece.startswith("### ")
        label, _, body = piece[4:].partition(": ")
        role = names.get(label) or bytes.fromhex(label[1:]).decode()
        text, at = "", 0
        while at < len(body):
            text += body[at]
            if body[at] in "#<":
                stop = at + 1
                while body[stop: stop + 1] == "\\":
                    stop += 1
                if head(body, stop) if body[at] == "#" else body.startswith("/turn>", stop):
                    assert stop > at + 1, "bare control string"
                    at += 1
            at += 1
        turns.append((role, text))
    return turns


def test_any_content_comes_back(session):
    rows = hard_rows(1, 400)
    path = chat_format.fresh_dir(session, "chat-test")
    whole = chat_format.format_conversations(frame(session, rows))
    whole.write.parquet(path)
    got = {x.conv_id: x for x in chat_format.read_formatted(session, path).collect()}
    want = in_order(rows)
    assert set(got) == set(want)
    for conv, turns in want.items():
        assert [tuple(x) for x in got[conv].turns] == turns == by_hand(got[conv].formatted)
        assert got[conv].learned == "".join(text for role, text in turns if role == "assistant")
    for x in session.read.parquet(path).collect():
        raw = x.formatted.encode()
        for span in x.loss:
            assert raw[: span.start].endswith(b"### Assistant: ")
            assert raw[span.start + span.length:].startswith(b"</turn>\n")
    # Escaped are turns that need it, and no other.
    assert 0 < sum(x.n_escaped for x in got.values()) < len(rows)


def test_escapes_are_undone(session):
    texts = [text or "" for *_, text in hard_rows(2, 600)]
    df = stored(session.createDataFrame([(x,) for x in texts], "text string"), "escapes")
    text = F.col("text")
    wrong = df.filter(
        (TEMPLATE.unescape(TEMPLATE.escape(text)) != text) | TEMPLATE.is_bare(TEMPLATE.escape(text))
        | (TEMPLATE.unescape(TEMPLATE.unescape(TEMPLATE.escape(TEMPLATE.escape(text)))) != text)
    )
    assert wrong.count() == 0


def test_broken_text_is_no_turn(session):
    texts = ["", "### User: a</turn>\n", "### User: a</turn>", "### User a</turn>\n", "x### User: a</turn>\n",
             "### User: a</turn> b</turn>\n", "### User: ### System: b</turn>\n"]
    df = session.createDataFrame(list(enumerate(texts)), "i int, text string")
    got = [x.turns for x in df.select("i", TEMPLATE.parse(F.col("text")).alias("turns")).orderBy("i").collect()]
    assert got[0] == [] and [tuple(x) for x in got[1]] == [("user", "a")] and got[2] is None
    assert all(tuple(x[0]) == (None, None) for x in got[3:])


def test_digests_and_edges(session):
    rows = [
        (1, 1, "assistant", "b"), (1, 0, "user", "a"), (1, None, None, None), (2, 0, "user", None),
        (3, 0, "assistant", "same"), (3, 0, "assistant", "same"), (3, 0, "assistant", "Same"),
        (None, 0, "user", "no id"), (None, 5, "assistant", "reply"), (4, 0, "assistant", "é" * 3_000_000 + "</turn>\n"),
    ] + [(5, i, "assistant" if i % 2 else "user", f"text {i}") for i in range(3000)]
    got = {x.conv_id: tuple(x)[1:5] for x in chat_format.op11_chat_format(session, frame(session, rows)).collect()}
    hard = "\\### Assistant: </turn> ok"
    want = in_order(rows) | {-7: [("user", hard), ("assistant", hard)]}
    for conv, turns in want.items():
        loss = "".join(text for role, text in turns if role == "assistant")
        assert got.pop(conv) == (
            len(turns), digest("".join(f"{role}\n{text}\n" for role, text in turns)), len(loss), digest(loss))
    assert not got
    empty = chat_format.op11_chat_format(session, frame(session, [])).collect()
    assert [x.conv_id for x in empty] == [-7]


def test_no_python_in_the_plan(session):
    plan = chat_format.format_conversations(frame(session, hard_rows(3, 5)))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert plan.split("== Physical Plan ==")[1].count("Exchange hashpartitioning") == 1
