"""Document quality by a sparse ensemble of rules over statistics of the text.

Trees of a random forest, grown on labelled rows, give paths; each is a conjunction of comparisons, a
rule.  A logistic regression with a lasso penalty keeps few of the rules and weighs them, and what it
keeps is compiled to one Spark column expression over the statistics.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.text import _BASE, distinct, mix, slices, words
from tidemark.llm.toxicity import held_out, training_rows

#: Labelled rows that trees and weights are learned from.
MAX_TRAINING = 20_000
TREES, DEPTH, LASSO, SEED = 20, 4, 0.002, 9

STATISTICS = (
    "words", "word_length", "upper", "digits", "signs", "signed_words", "distinct_words", "most_frequent",
    "repeated_next", "distinct_pairs", "lines", "repeated_lines", "bars", "exclamations", "line_words",
    "short_words", "stops", "vowels",
)


def _class_of(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_UPPER, _DIGIT = _class_of(range(65, 91)), _class_of(range(48, 58))
_LETTER = _class_of([*range(65, 91), *range(97, 123), *range(128, 256)])
_SIGN = _class_of(b"#$%&*+/<=>@[\\]^_`{|}~")


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(rows, STATISTICS) of every row of a run of text; shares are of bytes, words or lines."""
    n = len(offsets) - 1
    found = words(data, offsets)
    count = np.bincount(found.row, minlength=n)
    some, size = np.maximum(count, 1), np.maximum(np.diff(offsets), 1)

    def share(kind: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(kind[data])])
        return (sums[offsets[1:]] - sums[offsets[:-1]]) / size

    def most(rows, hashes):
        """(distinct, largest count) of each row's hashes."""
        order = np.lexsort((hashes, rows))
        r, h = rows[order], hashes[order]
        new = np.flatnonzero(np.concatenate([[True], (r[1:] != r[:-1]) | (h[1:] != h[:-1])])) if len(r) else np.zeros(0, int)
        top = np.zeros(n, np.int64)
        np.maximum.at(top, r[new], np.diff(np.append(new, len(r))))
        return np.bincount(r[new], minlength=n), top

    kinds, top = most(found.row, found.hash)
    next_to = found.row[1:] == found.row[:-1]
    pair_rows = found.row[1:][next_to]
    pairs = mix(found.hash[:-1][next_to] * np.uint64(_BASE) + found.hash[1:][next_to])
    pair_kinds, _ = most(pair_rows, pairs)
    again = np.bincount(pair_rows[(found.hash[1:] == found.hash[:-1])[next_to]], minlength=n)
    n_pairs = np.maximum(np.bincount(pair_rows, minlength=n), 1)

    cuts = np.unique(np.concatenate([offsets, np.flatnonzero(data == 0x0A) + 1]))
    per_line = np.searchsorted(cuts, found.start, "right") - 1
    hashes = np.zeros(max(len(cuts) - 1, 0), np.uint64)
    place = np.arange(len(found.hash), dtype=np.uint64)
    first = np.searchsorted(per_line, np.arange(len(hashes)))
    np.add.at(hashes, per_line, mix(found.hash + mix(place - first[per_line].astype(np.uint64))))
    full = np.bincount(per_line, minlength=len(hashes)) > 0
    line_row = (np.searchsorted(offsets, cuts[:-1], "right") - 1)[full]
    lines = np.bincount(line_row, minlength=n)
    line_kinds = np.bincount(distinct(line_row, hashes[full])[0], minlength=n)
    some_lines = np.maximum(lines, 1)

    length = found.end - found.start
    signed = _SIGN[data[found.end - 1]] if len(found.end) else np.zeros(0, bool)
    by_row = lambda weights: np.bincount(found.row, weights, minlength=n)
    letters = share(_LETTER)
    return np.stack(
        [
            count, by_row(length) / some, share(_UPPER) / np.maximum(letters, 1e-9), share(_DIGIT), share(_SIGN),
            by_row(signed) / some, kinds / some, top / some, again / n_pairs, pair_kinds / n_pairs, lines,
            1 - line_kinds / some_lines, share(_class_of(b"|")), share(_class_of(b"!")), count / some_lines,
            by_row(length <= 2) / some, share(_class_of(b".")), share(_class_of(b"aeiouAEIOU")),
        ],
        axis=1,
    ).astype(float)


def _measure(batches):
    for batch in batches:
        for first, data, offsets in slices(batch.column(1)):
            found = statistics(data, offsets)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(first, len(found)), *(pa.array(found[:, k]) for k in range(len(STATISTICS)))],
                names=["doc_id", *STATISTICS],
            )


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, STATISTICS) of every row of ``docs`` (doc_id, text, ...); null reads as empty, all zero."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(_measure, ", ".join(["doc_id long", *(f"{s} double" for s in STATISTICS)]))


class Condition(NamedTuple):
    statistic: int
    above: bool
    threshold: float


class Rules(NamedTuple):
    """Rules (tuples of conditions) with weights, and the intercept."""

    weights: dict
    intercept: float

    def score(self) -> Column:
        """The probability of the label 1 as a column over STATISTICS."""
        total = F.lit(float(self.intercept))
        for rule, weight in self.weights.items():
            total = total + F.when(holds(rule), F.lit(float(weight))).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def holds(rule: tuple) -> Column:
    out = F.lit(True)
    for c in rule:
        column, bound = F.col(STATISTICS[c.statistic]), F.lit(c.threshold)
        out = out & (column > bound if c.above else column <= bound)
    return out


def _simplified(path: tuple) -> tuple:
    """Of comparisons that bound a statistic on one side, the tightest; in a fixed order."""
    tight: dict = {}
    for c in path:
        key = (c.statistic, c.above)
        choose = max if c.above else min
        tight[key] = choose(tight.get(key, c.threshold), c.threshold)
    return tuple(Condition(s, above, t) for (s, above), t in sorted(tight.items()))


def paths(node, so_far: tuple = ()) -> set:
    """Every path of a tree that starts at its root, as a rule."""
    out = {_simplified(so_far)} if so_far else set()
    if "Internal" in node.getClass().getSimpleName():
        split = node.split()
        for child, above in ((node.leftChild(), False), (node.rightChild(), True)):
            out |= paths(child, (*so_far, Condition(split.featureIndex(), above, split.threshold())))
    return out


def learn(docs: DataFrame, labels: DataFrame, most: int = MAX_TRAINING) -> Rules:
    """Rules from ``docs`` (doc_id, text) and ``labels`` (doc_id, quality).

    With no rows to learn from, or of one label only, there are none, and the score is their share of 1.
    """
    rows = training_rows(docs, labels, "quality", most)
    label = rows.select(F.col("quality").cast("long").alias("doc_id"), "text")
    rows = measured(label).select(F.col("doc_id").cast("double").alias("label"), *STATISTICS).persist()
    try:
        sizes = dict(rows.groupBy("label").count().collect())
        good, bad = sizes.get(1.0, 0), sizes.get(0.0, 0)
        share = (good + 0.5) / (good + bad + 1)
        none = Rules({}, math.log(share / (1 - share)))
        if not good or not bad:
            return none
        vectors = rows.select("label", array_to_vector(F.array(*STATISTICS)).alias("features"))
        forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, maxBins=64, seed=SEED, subsamplingRate=0.7)
        rules = sorted(set().union(*(paths(t._call_java("rootNode")) for t in forest.fit(vectors).trees)))
        if not rules:
            return none
        fires = F.array(*(holds(r).cast("double") for r in rules))
        lasso = LogisticRegression(elasticNetParam=1.0, regParam=LASSO, standardization=True, maxIter=60)
        model = lasso.fit(rows.select("label", array_to_vector(fires).alias("features")))
        weights = {r: float(w) for r, w in zip(rules, model.coefficients.toArray()) if w}
        return Rules(weights, float(model.intercept))
    finally:
        rows.unpersist()


def scores(docs: DataFrame, rules: Rules) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs`` (doc_id, text, ...).

    Null and empty texts have statistics of zero and are scored by them.  A null doc_id is scored and
    not held out; repeated rows are scored alike.  Other columns are ignored; an empty table gives no rows.
    """
    out = measured(docs).select("doc_id", held_out().alias("held_out"), rules.score().alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))
