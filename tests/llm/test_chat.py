"""Formatted conversations against a plain formatter, and read back."""

from __future__ import annotations

import hashlib
import json
import math
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import chat

T = chat.Template()
SCHEMA = f"conv_id long, turn long, role string, text string, formatted string, loss string, parts array<{chat.PART}>"


def part(kind, text=None, ref=None, width=None, height=None, seconds=None, pages=None):
    return (kind, text, ref, width, height, seconds, pages)


def escape(text):
    """Position by position: a bracket, backslashes, and the rest of a control string."""
    out, at = [], 0
    while at < len(text):
        run = at + 1
        while run < len(text) and text[run] == "\\":
            run += 1
        tail = next((c[1:] for c in T.controls if text.startswith(c[1:], run)), None)
        if text[at] in "<[" and tail:
            out.append(text[at] + "\\" + text[at + 1:run] + tail)
            at = run + len(tail)
        else:
            out.append(text[at])
            at += 1
    return "".join(out)


def tokens(p):
    kind, _, _, width, height, seconds, pages = p
    count = {
        "image": lambda: math.ceil(width / 28) * math.ceil(height / 28),
        "audio": lambda: math.ceil(seconds * 25), "document": lambda: pages * 256,
    }
    try:
        return max(count[kind](), 1)
    except TypeError:
        return 1


def brute(turns):
    """(formatted, [(start, end)], [(turn, kind, ref, at, tokens)]) of [(role, parts)] in order."""
    text, loss, attached = "", [], []
    for k, (role, parts) in enumerate(turns):
        text += T.start + escape(role or "") + T.said
        for p in parts or []:
            if p is None:
                continue
            if p[0] in chat.Visitor.KINDS:
                attached.append((k, p[0], p[2], len(text), tokens(p)))
                text += f"<|{p[0]}|>"
            else:
                if role == "assistant" and p[1]:
                    loss.append((len(text), len(text) + len(escape(p[1]))))
                text += escape(p[1] or "")
        text += T.end
    return text, loss, attached


PIECES = ["hi ", "é🙂", "\n", "<", "[", "\\", "</s>", "[INST]", "<|im_end|>", "<\\/s>", "<|image|>", "|im_sep|>", "s>", "[/INST]", "$1"]


def some_conversations(seed, n):
    rng = random.Random(seed)
    text = lambda: "".join(rng.choice(PIECES) for _ in range(rng.randrange(9)))
    made = [
        lambda: part("text", text()), lambda: part(None, text()), lambda: part("text"), lambda: part("table", text()),
        lambda: part("image", "seen", "a.png", rng.choice([None, 1, 28, 29, 640]), 480), lambda: part("audio", None, None, seconds=1.01),
        lambda: part("document", None, "d.pdf", pages=rng.choice([None, 0, 3])), lambda: None,
    ]
    roles = ["user", "assistant", "system", None, "", "x\n<|im_sep|>"]
    return {
        c: [(rng.choice(roles), rng.choice([None, [rng.choice(made)() for _ in range(rng.randrange(5))]])) for _ in range(rng.randrange(1, 7))]
        for c in range(n)
    }


def test_equals_a_plain_formatter(spark):
    conversations = some_conversations(1, 60)
    rows = [(c, k if k else None, role, "ignored", "x", "y", parts) for c, ts in conversations.items() for k, (role, parts) in enumerate(ts)]
    random.Random(2).shuffle(rows)
    found = chat.formatted(spark.createDataFrame(rows, SCHEMA))
    got = {r.conv_id: r for r in found.collect()}
    assert set(got) == set(conversations)
    for c, turns in conversations.items():
        text, loss, attached = brute(turns)
        assert got[c].formatted == text
        assert [(at.at + at.start, at.at + at.end) for at in got[c].loss] == loss
        assert [(a.turn, a.kind, a.ref, a.at, a.tokens) for a in got[c].attachments] == attached
        assert got[c].n_tokens_attached == sum(a[-1] for a in attached)
        for _, kind, _, at, _ in attached:
            assert text.startswith(f"<|{kind}|>", at)


def plain(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, said string, segments int")


def test_reads_back_what_went_in(spark):
    rng = random.Random(3)
    rows = [
        (c, k, rng.choice(["user", "assistant", None, "[INST]"]), rng.choice([None, "".join(rng.choice(PIECES) for _ in range(12))]), "x", 1)
        for c in range(80) for k in range(rng.randrange(1, 6))
    ]
    got = {r.conv_id: r for r in chat.digest(chat.formatted(plain(spark, rows))).collect()}
    for c in {r[0] for r in rows}:
        mine = [(r[2] or "", r[3] or "") for r in rows if r[0] == c]
        learned = "".join(text for role, text in mine if role == "assistant")
        assert got[c].n_turns == len(mine)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in mine).encode()).hexdigest()
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())
        assert got[c].formatted_chars == sum(len(T.start + escape(a) + T.said + escape(b) + T.end) for a, b in mine)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(st.sampled_from("<[\\|/s>INST]im_end a\n"), max_size=60), min_size=1, max_size=40))
def test_escapes_are_reversible_and_hide_control_strings(spark, texts):
    rows = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("e", T.escaped(F.col("t")))
    for r in rows.withColumn("back", T.unescaped(F.col("e"))).collect():
        assert r.back == r.t and r.e == escape(r.t)
        assert not any(c in r.e for c in T.controls)


def test_odd_rows(spark):
    long = "word </s> " * 60_000
    rows = [
        (1, None, "assistant", "first", "x", 1), (1, 0, "assistant", "b", "x", 1), (1, 0, "assistant", "a", "x", 1),
        (1, 0, "assistant", "a", "x", 1), (2, 0, None, None, "x", 1), (None, 5, "assistant", "", "x", 1), (3, 0, "assistant", long, "x", 1),
    ]
    got = {r.conv_id: r for r in chat.digest(chat.formatted(plain(spark, rows))).collect()}
    assert got[1].n_turns == 4 and got[1].loss_sha256 == hashlib.sha256(b"firstaab").hexdigest()
    assert (got[2].n_turns, got[2].turns_sha256, got[2].loss_chars) == (1, hashlib.sha256(b"\n\n").hexdigest(), 0)
    assert (got[None].n_turns, got[None].loss_chars) == (1, 0)
    assert got[3].loss_chars == len(long) and got[3].loss_sha256 == hashlib.sha256(long.encode()).hexdigest()
    assert chat.digest(chat.formatted(plain(spark, []))).collect() == []


def test_parts_from_json(spark):
    content = json.dumps([{"kind": "text", "text": "see "}, {"kind": "image", "ref": "a.png", "width": 30, "height": 28}])
    rows = spark.createDataFrame([(1, 0, "user", content), (1, 1, "assistant", "not json")], "conv_id long, turn long, role string, c string")
    r = chat.formatted(rows.withColumn("parts", chat.parts_of(F.col("c")))).first()
    assert r.formatted == brute([("user", [part("text", "see "), part("image", None, "a.png", 30, 28)]), ("assistant", [])])[0]
    assert [(a.ref, a.tokens) for a in r.attachments] == [("a.png", 2)]


def test_marks_must_not_overlap():
    with pytest.raises(ValueError):
        chat.Template(start="<<s>>")
    with pytest.raises(ValueError):
        chat.Template(start="<|x|>", said="<|x|>")


def test_runs_without_python(spark):
    plan = chat.digest(chat.formatted(plain(spark, [])))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and plan.count("Exchange") == 1
