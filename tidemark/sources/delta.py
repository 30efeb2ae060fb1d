"""The same table operations on Delta Lake, where MERGE and transactions are built in."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import merge
from tidemark.sources.tables import BATCH, WRITER, Batch, Shape

try:
    from delta.tables import DeltaTable
except ImportError:  # pragma: no cover - depends on the cluster
    DeltaTable = None


class DeltaLakeTable:
    """Keyed rows are merged, deletes applied and other rows appended when they are written.

    A row carries the batch that last wrote it.  Batches of one writer have ascending whole numbers, as runs
    and micro-batches have, so that Delta skips an append it has seen.
    """

    def __init__(self, spark: SparkSession, path: str, shape: Shape | None = None) -> None:
        if DeltaTable is None:
            raise ImportError("the delta-spark package is not installed")
        self.spark, self.path, self.shape = spark, path, shape or Shape()

    def exists(self) -> bool:
        return DeltaTable.isDeltaTable(self.spark, self.path)

    def _stored(self) -> DataFrame:
        return self.spark.read.format("delta").load(self.path)

    def _is(self, batch: Batch) -> Column:
        return F.col(WRITER).eqNullSafe(batch[0]) & F.col(BATCH).eqNullSafe(int(batch[1]))

    def read(self, at_least: str | None = None, without: Batch | None = None) -> DataFrame:
        """The table; file statistics prune what days prune elsewhere.

        ``without`` leaves out the rows that a batch wrote, also those it merged over older ones.
        """
        rows = self._stored()
        if at_least is not None and self.shape.day:
            rows = rows.where(F.col(self.shape.day) >= F.lit(at_least))
        if without:
            rows = rows.where(~self._is(without))
        return rows.drop(WRITER, BATCH, *self.shape.hidden)

    def batches(self) -> dict[str, int]:
        """The highest number of each writer's batches."""
        rows = self._stored().where(F.col(WRITER).isNotNull()).groupBy(WRITER).agg(F.max(BATCH).alias("last"))
        return {r[WRITER]: r["last"] for r in rows.collect()}

    def read_new(self, seen: Mapping[str, int], upto: Mapping[str, int]) -> DataFrame:
        """What batches after those ``seen`` of each writer, up to others, were the last to write."""
        new = [
            (F.col(WRITER) == writer) & (F.col(BATCH) > seen.get(writer, -1)) & (F.col(BATCH) <= last)
            for writer, last in upto.items()
        ]
        rows = self._stored().where(reduce(lambda a, b: a | b, new, F.lit(False)))
        return rows.drop(WRITER, BATCH, *self.shape.hidden)

    def read_batch(self, batch: Batch) -> DataFrame:
        """The rows that a batch was the last to write."""
        return self._stored().where(self._is(batch)).drop(WRITER, BATCH)

    def _append(self, rows: DataFrame, batch: Batch | None) -> None:
        writer = rows.write.format("delta").mode("append").option("mergeSchema", "true")
        if batch:  # Delta skips a transaction it has
            writer = writer.option("txnAppId", batch[0]).option("txnVersion", int(batch[1]))
        writer.save(self.path)

    def _on(self, keys) -> str:
        return " AND ".join(f"s.`{k}` = t.`{k}`" for k in keys)

    def add(self, df: DataFrame, batch: Batch | None = None) -> int:
        seen, shape = Observation(), self.shape
        writer, which = batch if batch else (None, None)
        df = df.withColumn(WRITER, F.lit(writer).cast("string")).withColumn(BATCH, F.lit(None if which is None else int(which)).cast("long"))
        rows = df.observe(seen, F.count(F.lit(1)).alias("rows"))
        if shape.keys:
            order = [c for c in shape.order if c in rows.columns]
            rows = merge.dedupe_last(rows, shape.keys, order)
            if self.exists():
                # an older row does not replace a newer one
                newer = reduce(lambda a, b: f"{a} AND {b}", [f"(t.`{c}` IS NULL OR s.`{c}` >= t.`{c}`)" for c in order], "true")
                (
                    DeltaTable.forPath(self.spark, self.path).alias("t").merge(rows.alias("s"), self._on(shape.keys))
                    .withSchemaEvolution().whenMatchedUpdateAll(newer).whenNotMatchedInsertAll().execute()
                )
            else:
                self._append(rows, None)
        elif shape.gone and shape.gone[2] in rows.columns:
            name, changed, deleted = shape.gone
            self._append(rows.where(F.col(deleted).isNull()).drop(deleted), batch)
            until = df.where(F.col(deleted).isNotNull()).groupBy(name).agg(F.max(deleted).alias("until"))
            condition = f"s.`{name}` = t.`{name}` AND t.`{changed}` <= s.until"
            DeltaTable.forPath(self.spark, self.path).alias("t").merge(until.alias("s"), condition).whenMatchedDelete().execute()
        else:
            self._append(rows, batch)
        return seen.get["rows"]
