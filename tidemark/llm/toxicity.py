"""Toxicity by a weighted lexicon, learned from labels and matched by an Aho-Corasick automaton.

Texts are folded first: lower case, letters of other scripts that look like Latin ones, and digits and
signs that stand for letters.  Then only words stay, one space apart, so a term is a word (``" term "``)
or a stem (``" ste"``), and a phrase is words side by side.  Terms carry the log-odds of standing in a
toxic text.  Exception phrases, in which a term is harmless, take its weight back.  The total and the
total by length go through a logistic function fitted on the same labelled rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Labelled rows that the lexicon is learned from; its terms and phrases are words of theirs, and as many as qualify.
MAX_TRAINING = 10_000
STEMS = (4, 5, 6, 7)
#: What a term must have: different toxic texts, as a number and as a part of all, and log-odds.
LEAST_TEXTS, LEAST_SHARE, LEAST_LOG_ODDS = 5, 0.01, 3.0

# Letters of other scripts and the Latin letters that they look like.
LOOKALIKES = dict(zip("асԁеһіјкӏмопрѕтцѵхуγαεικνορτυχ", "acdehijklmonpstuvxyyaeikvoptux"))
# Digits and signs and the letters that they stand for before a letter.
SIGNS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}

_FOLDED = str.maketrans(LOOKALIKES | {chr(c): chr(c - 0xFEE0) for c in range(0xFF21, 0xFF5B)})
_ODD = re.compile("[" + "".join(LOOKALIKES) + "Ａ-ｚ]")
_SIGN = re.compile(r"(?:(?<=[^\W\d_])|(?<!\S))[013457@$]+(?=[^\W\d_])")
_WORD = re.compile(r"[^\W\d_]+")


def folded(text: str) -> str:
    """The words of ``text`` after folding, each between single spaces."""
    text = text.lower()
    if not text.isascii() and _ODD.search(text):
        text = text.translate(_FOLDED).lower()
    text = _SIGN.sub(lambda m: "".join(SIGNS[c] for c in m[0]), text)
    return f" {' '.join(_WORD.findall(text))} "


class Lexicon(NamedTuple):
    """Terms and exception phrases (``" word "``, ``" stem"``) with weights, and the logistic function."""

    terms: dict
    phrases: dict
    coefficients: tuple  # of 1, log(1 + total), log(1 + total by length)

    def matcher(self) -> ahocorasick.Automaton | None:
        weights = Counter(self.terms)
        weights.update(self.phrases)
        if not weights:
            return None
        matcher = ahocorasick.Automaton()
        for term, weight in weights.items():
            matcher.add_word(term, (term, weight))
        matcher.make_automaton()
        return matcher


def measured(text: str | None, matcher) -> tuple[int, float, float]:
    """(terms found, their total weight, the total by length) of a text; exceptions are taken off."""
    words = folded(text or "")
    if matcher is None:
        return 0, 0.0, 0.0
    found = [weight for _, (_, weight) in matcher.iter(words)]
    total = max(0.0, math.fsum(found))
    return sum(1 if w > 0 else -1 for w in found), total, 1000 * total / (words.count(" ") + 20)


def _features(total: np.ndarray, by_length: np.ndarray) -> np.ndarray:
    return np.stack([np.ones(len(total)), np.log1p(total), np.log1p(by_length)], 1)


def _probability(x: np.ndarray, coefficients) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ np.asarray(coefficients), -30, 30)))


def _fitted(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> tuple:
    """Logistic regression by Newton steps; the penalty spares the first coefficient."""
    beta, penalty = np.zeros(x.shape[1]), ridge * np.diag([1e-3, *[1.0] * (x.shape[1] - 1)])
    for _ in range(50):
        p = _probability(x, beta)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ beta)
        beta += np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-8:
            break
    return tuple(beta)


def _counted(batches):
    """Texts of either label that hold each word and stem, summed within the batch."""
    for batch in batches:
        counts = {}
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words = set(folded(text).split())
            terms = {f" {w} " for w in words if len(w) > 2} | {f" {w[:n]}" for w in words for n in STEMS if len(w) > n}
            for term in terms:
                counts.setdefault(term, [0, 0])[toxic] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()), *(pa.array([v[k] for v in counts.values()], pa.int64()) for k in (0, 1))],
            names=["term", "clean", "toxic"],
        )


def _phrase_counter(terms: dict):
    def count(batches):
        matcher = Lexicon(terms, {}, ()).matcher()
        for batch in batches:
            counts = {}
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words, seen = folded(text), set()
                for end, (term, _) in matcher.iter(words):
                    start = end + 1 - len(term)
                    stop = words.index(" ", start + 1)
                    after = words.find(" ", stop + 1)
                    before = words.rfind(" ", 0, start)
                    if after > 0:
                        seen.add((words[start:after + 1], term))
                    if before >= 0:
                        seen.add((words[before:stop + 1], term))
                for pair in seen:
                    counts.setdefault(pair, [0, 0])[toxic] += 1
            yield pa.RecordBatch.from_arrays(
                [*(pa.array([p[k] for p in counts], pa.string()) for k in (0, 1)),
                 *(pa.array([v[k] for v in counts.values()], pa.int64()) for k in (0, 1))],
                names=["phrase", "term", "clean", "toxic"],
            )

    return count


def _measurer(lexicon: Lexicon):
    def measure(batches):
        matcher = lexicon.matcher()
        for batch in batches:
            found = [measured(text.as_py(), matcher) for text in batch.column(1)]
            n, total, by_length = (np.array(x) for x in zip(*found)) if found else (np.zeros(0),) * 3
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n.astype(np.int64)), pa.array(total.astype(float)), pa.array(by_length.astype(float))],
                names=["doc_id", "n_terms", "total", "by_length"],
            )

    return measure


def _scorer(lexicon: Lexicon):
    measure = _measurer(lexicon)

    def score(batches):
        for batch in measure(batches):
            x = _features(np.array(batch.column(2)), np.array(batch.column(3)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(_probability(x, lexicon.coefficients)), batch.column(1)],
                names=["doc_id", "score", "n_terms"],
            )

    return score


def held_out(doc_id="doc_id"):
    """Rows that nothing is learned from: a fifth, by the CRC of the id's text; false for a null id."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(5)) == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, most: int) -> DataFrame:
    """(doc_id, text, label) of at most ``most`` labelled documents that are not held out.

    They are the first by a hash of the id, so the sample is the same in every run, and small enough
    to be sent to every task.  Labels given twice count as 1 if any is; other values than 0 and 1 are ignored.
    """
    chosen = labels.where(F.col(label).isin(0, 1) & ~held_out() & F.col("doc_id").isNotNull())
    chosen = chosen.groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias(label))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text")).where("text is not null")
    return docs.join(F.broadcast(chosen), "doc_id")


def learn(docs: DataFrame, labels: DataFrame, most: int = MAX_TRAINING) -> Lexicon:
    """A lexicon from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic).

    With no rows to learn from, or of one label only, it is empty and scores the share of toxic rows.
    """
    rows = training_rows(docs, labels, "toxic", most).select("text", "toxic")
    rows = rows.groupBy("text").agg(F.max("toxic").alias("toxic")).persist()  # copies are no further evidence
    try:
        sizes = dict(rows.groupBy("toxic").count().collect())
        clean, toxic = sizes.get(0, 0), sizes.get(1, 0)
        share = (toxic + 0.5) / (clean + toxic + 1) if clean + toxic else 0.01
        empty = Lexicon({}, {}, (math.log(share / (1 - share)), 0.0, 0.0))
        if not clean or not toxic:
            return empty
        counts = rows.mapInArrow(_counted, "term string, clean long, toxic long").groupBy("term")
        counts = counts.agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        odds = F.log((F.col("toxic") + 0.5) / (toxic + 1.0)) - F.log((F.col("clean") + 0.5) / (clean + 1.0))
        found = counts.withColumn("weight", odds).where((F.col("toxic") >= max(LEAST_TEXTS, LEAST_SHARE * toxic)) & (F.col("weight") >= LEAST_LOG_ODDS))
        best = found.select("term", "weight").collect()
        terms: dict = {}
        for r in sorted(best, key=lambda r: (len(r["term"].rstrip()), r["term"])):  # a stem covers its words
            if not any(r["term"][:n + 1] in terms for n in STEMS if n + 1 < len(r["term"].rstrip())):
                if r["term"].rstrip() not in terms:
                    terms[r["term"]] = r["weight"]
        if not terms:
            return empty
        phrases = rows.mapInArrow(_phrase_counter(terms), "phrase string, term string, clean long, toxic long")
        phrases = phrases.groupBy("phrase", "term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        harmless = phrases.where("clean >= 3 and toxic = 0").select("phrase", "term").collect()
        lexicon = Lexicon(terms, {}, ())
        taken: dict = {}
        for r in sorted(harmless):
            taken[r["phrase"]] = -terms[r["term"]]
        lexicon = Lexicon(terms, taken, ())
        marked = rows.select(F.col("toxic").cast("long").alias("doc_id"), "text")
        marked = marked.mapInArrow(_measurer(lexicon), "doc_id long, n_terms long, total double, by_length double")
        sample = np.array([tuple(r) for r in marked.collect()], float)  # at most ``most`` rows of four numbers
        sample = sample[np.lexsort(sample.T)]
        return lexicon._replace(coefficients=_fitted(_features(sample[:, 2], sample[:, 3]), sample[:, 0]))
    finally:
        rows.unpersist()


def scores(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """(doc_id, held_out, score, predicted, n_terms) for every row of ``docs`` (doc_id, text, ...).

    Null and empty texts hold no term and get the lowest score.  A null doc_id is scored and not held
    out; repeated rows are scored alike.  Other columns are ignored; an empty table gives no rows.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(_scorer(lexicon), "doc_id long, score double, n_terms long").select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_terms"
    )


def _rejecter(lexicon: Lexicon):
    def clean(batches):
        matcher = lexicon.matcher()
        for batch in batches:
            at = batch.schema.names.index("text")
            found = [measured(text.as_py(), matcher) for text in batch.column(at)]
            _, total, by_length = (np.array(x, float) for x in zip(*found)) if found else (np.zeros(0),) * 3
            yield batch.filter(pa.array(_probability(_features(total, by_length), lexicon.coefficients) < 0.5))

    return clean


def without_toxic(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores below 0.5."""
    return docs.mapInArrow(_rejecter(lexicon), docs.schema)
