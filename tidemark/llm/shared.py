"""Scratch tables on shared storage, and connected components over links."""

from __future__ import annotations

import os
import tempfile

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import apply_settings, shared_folder


#: Of rows that a worker is given at once.
BATCH_BYTES = 16 << 20
#: Whether Spark removes the files of a query's shuffles with its end.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def prepared(spark: SparkSession) -> SparkSession:
    """The library's settings; a scratch folder only where a local session names none."""
    apply_settings(spark)
    # rows hold whole texts: ten thousand of them at once are more than a small executor has room for
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))  # whatever their length
    # tasks import this package from where the driver has it, whatever folder the driver was started in;
    # on a cluster whose machines don't share that folder, ship it with --py-files
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, paths)])
    if not spark.conf.get("spark.checkpoint.dir", None):
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir is not set; point it at storage all executors share")
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tidemark-"))
    return spark


def written(df: DataFrame, name: str, *by: str) -> str:
    """The new folder, one of the shared folder's, that ``df`` was written to (filed ``by`` columns); its shuffles are removed."""
    spark = prepared(df.sparkSession)
    path = shared_folder(spark, name)
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.partitionBy(*by).parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read from there: its lineage ends here, and its shuffles are removed."""
    path = written(df, name)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def smallest(edges: np.ndarray, n: int) -> np.ndarray:
    """The smallest vertex connected to each of ``n``."""
    label = np.arange(n)
    while len(edges):
        low = np.minimum(label[edges[:, 0]], label[edges[:, 1]])
        before = label.copy()
        np.minimum.at(label, label[edges[:, 0]], low)
        np.minimum.at(label, label[edges[:, 1]], low)
        np.minimum.at(label, edges[:, 0], low)
        np.minimum.at(label, edges[:, 1], low)
        label = label[label]
        if (label == before).all():
            break
    return label


def _print_of(edges: DataFrame):
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the undirected ``edges`` (u, v); the component is its smallest node.

    Alternates the large-star and small-star steps: each re-points the neighbours of a node at the
    smallest of them, which leaves stars after a number of rounds logarithmic in the longest path.
    Minima are combined before the shuffle and the joins against them can be split, so a hub costs no
    more than as many leaves elsewhere.  Self-links, repeated and null-ended links are ignored.
    """
    edges = stored(
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .where("u is not null and v is not null and u <> v").distinct(),
        "edges",
    )
    seen = _print_of(edges)
    while seen[0]:
        both = edges.union(edges.select("v", "u")).toDF("u", "v")
        smallest = stored(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "smallest")
        large = both.where("v > u").join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.where("u <> v").distinct(), "large")
        smallest = stored(large.groupBy("u").agg(F.min("v").alias("m")), "smallest")
        small = large.join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        edges = stored(small.union(smallest.select("u", F.col("m").alias("v"))).distinct(), "edges")
        now = _print_of(edges)
        if now == seen:
            break
        seen = now
    leaves = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return stored(leaves.union(roots), "components")
