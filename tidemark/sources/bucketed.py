"""Keyed tables in buckets of their keys, so that reading and merging them needs no shuffle of what is stored.

A catalog table is clustered by its keys and partitioned by batch.  A batch is dealt to the buckets when it
is written and costs its own size; a batch written again replaces itself, as it is a partition.  The
newest row of each key is then found bucket by bucket, and a join on the keys with something smaller moves
that alone.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import merge
from tidemark.sources import folders
from tidemark.sources.tables import AT, BATCH, WRITER, Batch, Shape

OWN = (AT, WRITER, BATCH)


class BucketedTable:
    """``name`` in the session's catalog, its files at ``path``; another session finds its batches there.

    ``columns`` are fixed.  ``buckets`` bound the tasks that a read has, and are to be kept for a table.
    """

    def __init__(self, spark: SparkSession, name: str, path: str, columns: T.StructType, shape: Shape, buckets: int = 200) -> None:
        if not shape.keys or shape.gone or shape.day:
            raise ValueError("buckets are for tables with keys alone")
        self.spark, self.name, self.shape, self.names = spark, name, shape, columns.names
        listed = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns)
        keys = ", ".join(f"`{k}`" for k in shape.keys)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({listed}, {AT} BIGINT, {WRITER} STRING, {BATCH} STRING) USING parquet "
            f"PARTITIONED BY ({WRITER}, {BATCH}) CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {buckets} BUCKETS LOCATION '{path}'"
        )
        self.buckets = buckets
        if folders.exists(spark, path):  # batches that another session wrote
            spark.catalog.recoverPartitions(name)

    def add(self, df: DataFrame, batch: Batch) -> int:
        """Write rows as a batch (writer, which); returns how many came."""
        seen = Observation()
        rows = df.select(*[F.col(f"`{n}`") for n in self.names]).observe(seen, F.count(F.lit(1)).alias("rows"))
        rows = merge.dedupe_last(rows, self.shape.keys, [c for c in self.shape.order if c in rows.columns])
        # one file a bucket: rows are dealt as the buckets are
        rows = rows.withColumn(AT, F.lit(time.time_ns())).repartition(self.buckets, *[F.col(f"`{k}`") for k in self.shape.keys])
        view = f"tm_rows_{uuid.uuid4().hex}"
        rows.createOrReplaceTempView(view)
        try:  # a batch is a partition, and this one alone is replaced
            rows.sparkSession.sql(
                f"INSERT OVERWRITE TABLE {self.name} PARTITION ({WRITER} = :writer, {BATCH} = :batch) SELECT * FROM {view}",
                {"writer": batch[0], "batch": str(batch[1])},
            )
        finally:
            rows.sparkSession.catalog.dropTempView(view)
        return seen.get["rows"]

    def read(self) -> DataFrame:
        """The newest row of each key; nothing that is stored is shuffled for it."""
        rows = self.spark.table(self.name)
        order = [*self.shape.order, AT]
        return merge.dedupe_last(rows.drop(WRITER, BATCH), list(self.shape.keys), order).select(
            *[F.col(f"`{n}`") for n in self.names if n not in self.shape.hidden]
        )

    def matching(self, keys: DataFrame) -> DataFrame:
        """What is held of some keys; only the keys are moved."""
        return self.read().join(keys.select(*self.shape.keys).distinct(), list(self.shape.keys), "left_semi")
