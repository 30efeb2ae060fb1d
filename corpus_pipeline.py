"""Documents to training samples, stage by stage; each stage's result is written and read by the next.

Every stage takes (spark, docs, sf_dir) and, but for the last, returns the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import minhash, mixing, pieces, pii, toxicity
from tidemark.llm.shared import prepared, stored

#: What bounds a worker's memory while texts are encoded: lattices kept, text looked at together, tables.
LITTLE = {"kept": pieces.KEPT // 16, "at_once": pieces.AT_ONCE // 16, "bits": 18}


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity scores below 0.5, by a lexicon learned from the labels that are not held out.

    Null and empty texts stay; repeated rows share a fate; without labels or documents nothing is rejected.
    """
    labels = prepared(spark).read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.without_toxic(docs, toxicity.learn(docs, labels))


def _numbered(docs: DataFrame) -> DataFrame:
    """The rows that have a doc_id, with a ``number`` for each different (doc_id, text), in that order."""
    docs = docs.where("doc_id is not null")
    again = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if again.isEmpty():  # ids that are unique are numbers
        return docs.withColumn("number", F.col("doc_id").cast("long"))
    text = F.coalesce(F.md5(F.col("text").cast("binary")), F.lit(""))
    pairs = docs.select("doc_id", text.alias("text_md5")).distinct()
    pairs = pairs.repartitionByRange("doc_id", "text_md5").sortWithinPartitions("doc_id", "text_md5")
    pairs = stored(pairs.withColumn("number", F.monotonically_increasing_id()), "numbers")
    same = docs.withColumn("text_md5", text).join(pairs, ["doc_id", "text_md5"]).drop("text_md5")
    # rows equal in both may differ elsewhere: the least of them is the one that stays
    least = same.groupBy("number").agg(F.min(F.struct(*[F.col(f"`{c}`") for c in docs.columns])).alias("row"))
    return stored(least.select("row.*", "number"), "numbered")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies (five words, 0.8) stays, the one with the smallest (doc_id, text).

    Rows equal in doc_id and text are one document; rows that share a doc_id and differ in text are documents
    of their own.  Rows without doc_id and those without words all stay.
    """
    rows = _numbered(docs)
    verdicts = minhash.near_duplicates(rows.select(F.col("number").alias("doc_id"), "text"), size=5, percent=80)
    kept = stored(verdicts.where("kept").select(F.col("doc_id").alias("number")).distinct(), "kept")
    return rows.join(kept, "number", "left_semi").select(docs.columns).union(docs.where(F.col("doc_id").isNull()))


def clean_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with personal data and the terms that reveal it replaced; ``n_chars`` follows the text."""
    out = pii.sanitised(docs)
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(length))
    return out


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: weights 5, 2, 1, 150% of all words, twice at most.

    Documents without words are never taken.
    """
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids, round_trip, samples): the pieces of every document and two sampled segmentations.

    A null or empty text has no ids.  Rows that repeat a document repeat its pieces.  The text that decoding
    gives is compared where it is made, and workers take far less memory than they may, for more time: stages
    before this one have filled the executors.
    """
    found = pieces.encoded(docs, text=False, **LITTLE)
    return found.select("doc_id", "ids", F.col("exact").alias("round_trip"), "samples")


STAGES = [
    ("reject_toxic", reject_toxic),
    ("drop_near_copies", drop_near_copies),
    ("clean_personal_data", clean_personal_data),
    ("mix_sources", mix_sources),
    ("encode", encode),
]
#: SQL can express neither the learned lexicon nor the sampled segmentations.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = prepared(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
