"""Toxicity and quality: held-out accuracy, what is matched, and odd rows."""

from __future__ import annotations

import math
import random
import re

import pytest

from tidemark.llm import quality, toxicity


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@pytest.mark.parametrize(("module", "label", "least"), [(toxicity, "toxic", 0.93), (quality, "quality", 0.95)])
def test_held_out_accuracy(spark, module, label, least):
    sf_dir = "/root/testdata/sf0.01"
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = module.scores(docs, module.learn(docs, labels)).join(labels, "doc_id").where("held_out").collect()
    assert len(scored) > 50
    assert all(0 <= r.score <= 1 for r in scored)
    assert sum(r.predicted == r[label] for r in scored) / len(scored) >= least


def test_held_out_rows_teach_nothing(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    for module, label in ((toxicity, "toxic"), (quality, "quality")):
        flipped = labels.selectExpr("doc_id", f"case when crc32(cast(doc_id as string)) % 5 = 0 then 1 - {label} else {label} end as {label}")
        assert module.learn(docs, labels) == module.learn(docs, flipped)


def test_folding():
    assert toxicity.folded("1D10T, mоron") == " idiot moron "  # the o is Cyrillic
    assert toxicity.folded("ＬＯＳＥＲ $cum") == " loser scum "
    assert toxicity.folded("a$$$ costs 100 in 2024 r2d2") == " a costs in r d "
    assert toxicity.folded("") == "  "


def test_terms_stems_and_exceptions():
    lexicon = toxicity.Lexicon({" scum ": 4.0, " lowe": 3.0}, {" scum bag ": -4.0}, (0.0, 1.0, 1.0))
    matcher = lexicon.matcher()
    assert toxicity.measured("Scum! loweisch, scumbag flower", matcher)[:2] == (2, 7.0)
    assert toxicity.measured("scum bag", matcher)[:2] == (0, 0.0)
    assert toxicity.measured(None, matcher) == (0, 0.0, 0.0)
    short, long = toxicity.measured("scum", matcher), toxicity.measured("scum " + "word " * 200, matcher)
    assert short[1] == long[1] and short[2] > long[2]


def test_exceptions_are_learned(documents, spark):
    toxic = [f"you are such vermin number {k} go away vermin" for k in range(40)]
    clean = [f"call pest control about vermin removal in town {k}" for k in range(6)] + [f"a nice and calm day {k} again" for k in range(400)]
    docs = documents(toxic + clean)
    labels = spark.createDataFrame([(k, int(k < 40)) for k in range(len(toxic + clean))], "doc_id long, toxic int")
    lexicon = toxicity.learn(docs, labels)
    assert any(t.strip() in "vermin" for t in lexicon.terms)
    matcher = lexicon.matcher()
    harmless = toxicity.measured("they offer vermin removal in town", matcher)
    assert harmless[1] < toxicity.measured("they offer vermin they say", matcher)[1]


def test_odd_rows(documents, odd_texts, spark):
    docs = documents(odd_texts)
    none = spark.createDataFrame([], "doc_id long, toxic int, quality int")
    some = spark.createDataFrame(
        [(k, k % 2, k % 3 == 0) for k in range(18)] + [(None, 1, True), (5, None, None), (5, 1, True), (5, 1, True)],
        "doc_id long, toxic int, quality boolean",
    ).selectExpr("doc_id", "toxic", "cast(quality as int) as quality")
    for module in (toxicity, quality):
        for labels in (none, some):
            learned = module.learn(docs, labels)
            got = module.scores(docs, learned).collect()
            assert len(got) == len(odd_texts)
            assert all(0 <= r.score <= 1 and r.held_out is not None for r in got)
            assert len({r.score for r in got if r.doc_id in (4, 5)}) == 1
        assert module.scores(documents([]), module.learn(documents([]), some)).collect() == []


def test_rejected_rows_go_whole(documents):
    lexicon = toxicity.Lexicon({" scum ": 4.0}, {}, (-2.0, 2.0, 0.0))
    docs = documents(["you scum", "you friend", None, ""])
    kept = toxicity.without_toxic(docs, lexicon)
    assert kept.schema == docs.schema
    assert sorted(kept.collect()) == sorted(docs.where("doc_id > 0").collect())


def test_rules_equal_their_columns(spark, documents):
    rules = quality.Rules(
        {(quality.Condition(0, False, 5.0),): 1.0, (quality.Condition(0, True, 2.0), quality.Condition(1, True, 2.5)): -2.0}, 0.5
    )
    got = quality.scores(documents(["a b", "one two three", "one two three four five six", ""]), rules).orderBy("doc_id").collect()
    expected = [1.5, -0.5, -1.5, 1.5]
    assert [r.score for r in got] == pytest.approx([1 / (1 + 2.718281828459045 ** -x) for x in expected])


def test_statistics(documents):
    rows = quality.measured(documents(["One two TWO two\n\nOne two TWO two\n a|b! 12"])).collect()[0]
    assert (rows.words, rows.lines, rows.repeated_lines) == (10, 3, pytest.approx(1 / 3))
    assert rows.distinct_words == pytest.approx(4 / 10) and rows.most_frequent == pytest.approx(6 / 10)
    assert rows.digits == pytest.approx(2 / 41) and rows.bars == pytest.approx(1 / 41)


def test_matches_equal_a_plain_scan():
    """Random lexicons: every term and phrase is counted at every place where it stands."""
    rng = random.Random(11)
    words = ["ab", "abc", "abcd", "bcd", "cd", "b0b", "СаВ", "x", "a1b", "ABCD", "...", "d-c"]
    for _ in range(60):
        stems = {f" {''.join(rng.choice('abcd') for _ in range(rng.randint(1, 4)))}{rng.choice([' ', ''])}": rng.uniform(-2, 5) for _ in range(8)}
        phrases = {f" {rng.choice(words[:5])} {rng.choice(words[:5])} ": rng.uniform(-5, 0) for _ in range(4)}
        lexicon = toxicity.Lexicon(stems, phrases, (0.0, 0.0, 0.0))
        text = " ".join(rng.choice(words) for _ in range(rng.randrange(40)))
        plain = toxicity.folded(text)
        weights = dict(stems)
        for phrase, weight in phrases.items():
            weights[phrase] = weights.get(phrase, 0) + weight
        found = [w for term, w in weights.items() for at in range(len(plain)) if plain.startswith(term, at)]
        n, total, by_length = toxicity.measured(text, lexicon.matcher())
        assert n == sum(1 if w > 0 else -1 for w in found)
        assert total == pytest.approx(max(0.0, sum(found)))
        assert by_length == pytest.approx(1000 * max(0.0, sum(found)) / (len(plain.split()) + 21))


def plain_statistics(text):
    """A few of the statistics, counted with Python's own means."""
    text = text or ""
    data, found = text.encode(), re.findall(r"[^\x20\x09-\x0D]+", text)
    lower = [w.translate({c: c + 32 for c in range(65, 91)}) for w in found]
    lines = [tuple(x) for x in (re.findall(r"[^\x20\x09-\x0D]+", line) for line in "".join(
        chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text).split("\n")) if x]
    some, size = max(len(found), 1), max(len(data), 1)
    pairs = list(zip(lower, lower[1:]))
    return {
        "words": len(found), "word_length": sum(len(w.encode()) for w in found) / some, "digits": sum(48 <= b < 58 for b in data) / size,
        "distinct_words": len(set(lower)) / some, "most_frequent": max(map(lower.count, set(lower)), default=0) / some,
        "repeated_next": sum(a == b for a, b in pairs) / max(len(pairs), 1), "distinct_pairs": len(set(pairs)) / max(len(pairs), 1),
        "lines": len(lines), "repeated_lines": 1 - len(set(lines)) / max(len(lines), 1), "bars": data.count(b"|") / size,
        "exclamations": data.count(b"!") / size, "line_words": len(found) / max(len(lines), 1),
        "short_words": sum(len(w.encode()) <= 2 for w in found) / some, "stops": data.count(b".") / size,
        "vowels": sum(b in b"aeiouAEIOU" for b in data) / size,
    }


def test_learned_rules_equal_a_plain_evaluation(spark, documents, odd_texts):
    """Statistics by plain counting, rules by plain comparisons: the scores of the compiled column."""
    sf_dir = "/root/testdata/sf0.01"
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    rules = quality.learn(docs, labels)
    assert len(rules.weights) > 5
    rows = docs.select("doc_id", "text").limit(300).union(documents(odd_texts, 10**6).select("doc_id", "text")).where("doc_id is not null")
    texts = {r.doc_id: r.text for r in rows.collect()}
    measured = {r.doc_id: r.asDict() for r in quality.measured(rows).collect()}
    scored = {r.doc_id: r.score for r in quality.scores(rows, rules).collect()}
    assert set(texts) == set(measured) == set(scored)
    for doc, text in texts.items():
        for name, value in plain_statistics(text).items():
            assert measured[doc][name] == pytest.approx(value, abs=1e-12), (doc, name)
        total = rules.intercept
        for rule, weight in rules.weights.items():
            if all((measured[doc][quality.STATISTICS[c.statistic]] > c.threshold) == c.above for c in rule):
                total += weight
        assert scored[doc] == pytest.approx(1 / (1 + math.exp(-total)), abs=1e-12)
