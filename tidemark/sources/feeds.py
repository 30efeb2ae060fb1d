"""Change feeds landed as files, read as streams or batches, and file listings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def stream_feed(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fmt: str = "parquet",
    max_files: int | None = None,
    max_bytes: str | None = None,
    partitions: Sequence[int] | None = None,
) -> DataFrame:
    """A landing folder as a stream; the streaming checkpoint is its cursor.

    ``max_files`` or ``max_bytes`` bound a micro-batch, the role page and flush sizes play for a
    polled feed.  ``partitions`` follows only those ``partition=N`` folders.
    """
    if partitions is not None:
        schema = T.StructType([*schema.fields, T.StructField("partition", T.IntegerType())])
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    feed = reader.load(path)
    if partitions is None:
        return feed
    return feed.where(F.col("partition").isin(list(partitions))).drop("partition")


def list_files(spark: SparkSession, path: str, content: bool = False) -> DataFrame:
    """Every file below a folder; without ``content`` the bytes are never read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files if content else files.drop("content")
