"""Personal data against the plain patterns, and terms that reveal it against counting by hand."""

from __future__ import annotations

import hashlib
import math
import random
import re

import pytest

from tidemark.llm import pii

PLAIN = {k: re.compile(p, re.ASCII) for k, p in pii.KINDS.items()}


def digits(s):
    return re.sub("[^0-9]", "", s)


def luhn(s):
    total = 0
    for k, c in enumerate(reversed(s)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


PASSES = {
    "email": lambda m: True,
    "ip": lambda m: all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.split(".")),
    "card": lambda m: 12 <= len(digits(m)) <= 19 and luhn(digits(m)),
    "phone": lambda m: 9 <= len(digits(m)) <= 15,
}


def brute(text):
    """(counts, spans) of the base kinds."""
    counts, spans = [], []
    for n, kind in enumerate(pii.KINDS):
        found = [m for m in PLAIN[kind].finditer(text or "") if PASSES[kind](m[0])]
        counts.append(len(found))
        spans += [(m.start(), n, f"{kind}:{m.start()}:{m.end()}") for m in found]
    return counts, ",".join(s for _, _, s in sorted(spans))


def matches(documents, texts):
    got = {r.doc_id: r for r in pii.find(documents(texts)).collect()}
    for k, t in enumerate(texts):
        if t is Ellipsis:
            continue
        counts, spans = brute(t)
        r = got[k]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == counts, t
        assert r.base_sha256 == hashlib.sha256(spans.encode()).hexdigest(), (t, spans, r.spans)
    return got


def test_base_kinds_equal_the_plain_patterns(documents):
    rng = random.Random(6)
    parts = ["a", "B9", "@", ".", "..", "-", "+", " ", "  ", "é", "🙂", "x.y", "@ex.org", "1", "12", "255", "256", "4111", "1111",
             "4111 1111 1111 1111", "4111-1111-1111-1111", "+1 (234) 567-8901", "10.0.0.1", "\n", "%", "_", "0", "00", "٣"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 25))) for _ in range(1500)]
    texts += ["a@b.c..d@e.f", "a@b.c%x@d.e", "x@y@z.com", "a@b.c@d.e", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111 - 4111111111111111"]
    matches(documents, texts)


def test_odd_and_long_texts(documents, odd_texts):
    """Runs that a matcher with recursion, or one that starts again at every character, wouldn't survive."""
    long = ["a@" + "b." * 30_000 + "c", "1 " * 30_000, "a" * 60_000 + " x@y.z", "9" * 60_000 + ".1.2.3", "1.2.3.4 " * 400, "+1" + "-" * 30_000]
    got = matches(documents, odd_texts + long)
    assert (got[None].n_email, got[None].spans) == (0, "")
    assert pii.find(documents([])).collect() == []
    assert pii.sanitised(documents([])).collect() == []


SECRET = "jane@corp.example"


def corpus():
    """A nickname stands near one address only, in four contexts; other words stand everywhere."""
    rng = random.Random(1)
    words = ["report", "meeting", "budget", "office", "monday", "please", "review", "draft"]
    filler = lambda n: " ".join(rng.choice(words) for _ in range(n))
    near = [f"{filler(3)} Wolfsbane writes from {SECRET} {filler(k + 2)}" for k in range(4)]
    return near + [filler(12) for _ in range(60)] + [f"Wolfsbane said hello, {SECRET} {filler(4)} wolfsbane", f"{near[0]}", "rare word"]


def test_terms_that_reveal_an_entity(documents):
    texts = corpus()
    got = matches(documents, texts)
    for k in (*range(4), 64, 65):
        spans = [s.split(":") for s in got[k].spans.split(",")]
        terms = {texts[k][int(a):int(b)].lower() for kind, a, b in spans if kind == "term"}
        assert "wolfsbane" in terms and not terms & {"report", "meeting", "budget"}, terms
    assert all("term" not in got[k].spans for k in [*range(4, 64), 66])


def test_disclosure_equals_counting(documents, spark):
    texts = corpus()
    docs = documents(texts)
    entities = pii._entities(pii.base_spans(docs))
    got = {(r.entity, r.term): r.certain for r in pii.disclosing(docs, entities).collect()}
    words = [w for t in texts for w in re.findall(r"\w+", t.lower()) if len(w) >= 3]
    near, contexts = [], set()
    for t in texts:
        for m in PLAIN["email"].finditer(t):
            left, right = t[max(0, m.start() - 60):m.start()], t[m.end():m.end() + 60]
            left = re.sub(r"^\w+", "", left) if len(left) == 60 else left
            right = re.sub(r"\w+$", "", right) if len(right) == 60 else right
            context = f"{left} {right}".lower()
            found = [w for w in re.findall(r"\w+", context) if len(w) >= 3]
            near += found
            contexts |= {(w, context) for w in found}
    want = {}
    for w in set(near):
        if sum(1 for x, _ in contexts if x == w) >= 3:
            share = min(1, near.count(w) / words.count(w))
            if 1 + math.log2(share) / -math.log2(len(near) / len(words)) >= 0.8:
                want[f"email:{SECRET}", w] = share >= 0.9
    assert got == want and want


@pytest.mark.parametrize("contexts", [1, 2])
def test_names_seen_in_few_contexts(documents, contexts):
    """One context is enough in a corpus in which the entity is rare; copies of it are no more than one."""
    rng = random.Random(3)
    words = [f"{a}{b}" for a in ("rep", "meet", "budg", "off", "mon", "rev") for b in ("ort", "ing", "et", "ice", "day", "iew")]
    filler = lambda n: " ".join(words[k % 36] for k in rng.sample(range(36), n))
    texts = [f"{filler(3)} Wolfsbane writes {SECRET} {filler(2 + k)}" for k in range(contexts)]
    texts += [filler(20) for _ in range(1000)]
    got = matches(documents, texts)
    for k in range(contexts):
        spans = [s.split(":") for s in got[k].spans.split(",")]
        assert {texts[k][int(a):int(b)].lower() for kind, a, b in spans if kind == "term"} == {"wolfsbane", "writes"}
    assert all("term" not in got[k].spans for k in range(contexts, len(texts)))
    clean = {r.doc_id: r.text for r in pii.sanitised(documents(texts)).collect()}
    assert "Wolfsbane" not in clean[0] and clean[contexts] == texts[contexts]


def test_copies_are_no_evidence(documents):
    """In a corpus in which a twentieth of all words are near the entity, one context is chance however often it is copied."""
    filler = [f"w{k}x" for k in range(4)]
    texts = [f"w0x Wolfsbane {SECRET} w1x w2x"] * 5 + [" ".join(filler * 5) for _ in range(20)]
    got = matches(documents, texts)
    assert all("term" not in r.spans for r in got.values())


def test_sanitised_texts(documents):
    texts = corpus() + ["call +1 234 567 8901 or 4111 1111 1111 1111", None, "", "nothing here"]
    docs = documents(texts)
    out = pii.sanitised(docs)
    assert out.columns == docs.columns
    rows = {r.doc_id: r for r in out.collect()}
    assert "[EMAIL]" in rows[0].text and SECRET not in rows[0].text and "wolfsbane" not in rows[0].text.lower()
    assert rows[67].text == "call [PHONE] or [CARD]"
    assert [rows[k].text for k in (66, 68, 69, 70)] == ["rare word", None, "", "nothing here"]
    before = {r.doc_id: r for r in docs.collect()}
    assert all(rows[k][c] == before[k][c] for k in rows for c in docs.columns if c != "text")


def test_nothing_but_spark_runs(documents):
    for df in (pii.find(documents(corpus())), pii.sanitised(documents(corpus()))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|InArrow", plan)


@pytest.mark.parametrize("text", ["J@x.org and j@X.org", "İ@x.org ıİ +1 234 567 8901"])
def test_case_and_width(documents, text):
    matches(documents, [text])
