"""Tables as plain Parquet folders that are only ever added to.

A write goes to ``tm_writer=<who>/tm_batch=<which>``, a folder of its own, so it costs what it writes,
writers never meet, and a batch that is repeated replaces its own folder and nothing else.  Columns are
merged by Spark as the folders are read.  What the rows mean is settled on reading: of a keyed table the
newest row of each key counts, and deletes are rows too.  ``fold`` writes what a table holds now as a new
table, for when its history has grown long.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from urllib.parse import quote, unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import merge
from tidemark.operators.joins import join_aggregated
from tidemark.sources import folders

# names of stored columns that tables add; unusual on purpose, since they must not clash with theirs
WRITER, BATCH, AT, DAY, GIVEN = "tm_writer", "tm_batch", "tm_at", "tm_day", "tm_given"
OWN = (WRITER, BATCH, AT, DAY, GIVEN)

Batch = tuple[str, object]


@dataclass(frozen=True)
class Shape:
    """How the rows of a table are to be read.

    ``keys`` make it a keyed table: the last row of each by ``order`` and then by arrival counts.
    ``hidden`` columns only serve the order and are not shown.  ``gone`` names (id, changed, deleted)
    columns of a history: rows with a ``deleted`` time remove those of the same id changed up to it.
    ``day`` is a datetime column whose day rows are filed under.
    """

    keys: tuple[str, ...] = ()
    order: tuple[str, ...] = ()
    hidden: tuple[str, ...] = ()
    gone: tuple[str, str, str] | None = None
    day: str | None = None


class Table:
    """A table at a path.  An existing one knows its shape; a new one takes the given."""

    def __init__(self, spark: SparkSession, path: str, shape: Shape | None = None) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self._given = shape
        # who writes batches that nobody named; what is known of the table, since shapes never change
        self._me, self._shape_kept, self._columns = uuid.uuid4().hex, None, None

    # ---- what is known -----------------------------------------------------------------------

    def exists(self) -> bool:
        return self._kept_shape() is not None

    def _kept_shape(self) -> Shape | None:
        if self._shape_kept is None:
            text = folders.read_text(self.spark, f"{self.path}/_shape")
            if text:
                self._shape_kept = Shape(**{k: tuple(v) if isinstance(v, list) else v for k, v in json.loads(text).items()})
        return self._shape_kept

    def _shape(self) -> Shape:
        kept = self._kept_shape()
        if kept and self._given and self._given != kept:
            raise ValueError(f"{self.path} has {kept}, not {self._given}")
        return kept or self._given or Shape()

    def _stored(self) -> DataFrame:
        """All rows with the columns of every write, and those that tables add."""
        return self.spark.read.option("mergeSchema", "true").option("basePath", self.path).parquet(self.path)

    # ---- writing -----------------------------------------------------------------------------

    def _aligned(self, df: DataFrame, columns: T.StructType | None) -> DataFrame:
        """Rows with the table's types; columns without a type (all null) say nothing and are left out."""
        df = df.select(*[F.col(f"`{f.name}`") for f in df.schema.fields if f.dataType != T.NullType()])
        known = T.StructType([f for f in columns if f.name in df.columns]) if columns else T.StructType()
        if not known.fields:
            return df
        try:
            # in the session of the rows, where what is observed of them is reported
            rows = df.sparkSession.createDataFrame([], known).unionByName(df, allowMissingColumns=True)
        except AnalysisException as error:
            raise TypeError(f"{self.path}: columns do not fit the table's: {error}") from error
        for f in known:
            to, new = rows.schema[f.name].dataType, df.schema[f.name].dataType
            # a union widens numbers; nothing else may become another type, and the stored type not at all
            if not isinstance(to, (T.StructType, T.ArrayType)) and (to != f.dataType or new != to and not isinstance(new, T.NumericType)):
                raise TypeError(f"{f.name}: {new.simpleString()} does not fit the table's {f.dataType.simpleString()}")
        return rows.select(*[F.col(f"`{n}`") for n in df.columns])

    def folder(self, writer: str, batch: object) -> str:
        """The letters keep Spark from taking a name for a number."""
        return f"{self.path}/{WRITER}=w{quote(writer, safe='')}/{BATCH}=b{quote(str(batch), safe='')}"

    def add(self, df: DataFrame, batch: Batch | None = None) -> int:
        """Write rows as a batch (writer, which) of their own; returns how many came.

        A batch written before is replaced, so repeating it changes nothing.  Of a keyed table the
        rows are reduced to the last of each key first.  New columns become the table's.
        """
        shape, at = self._shape(), time.time_ns()
        if self._columns is None and self.exists():
            self._columns = T.StructType([f for f in self._stored().schema if f.name not in OWN])
        writer, which = batch or (self._me, f"{at:020d}")
        seen = Observation()
        rows = self._aligned(df, self._columns).observe(seen, F.count(F.lit(1)).alias("rows"))
        schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in rows.schema.fields])
        partly = bool(shape.keys and self._columns and set(self._columns.names) - {*schema.names, *shape.hidden})
        if not self.exists():
            self._create(schema, shape)
        if shape.keys:
            rows = merge.dedupe_last(rows, shape.keys, [c for c in shape.order if c in rows.columns])
        if partly:
            rows = rows.withColumn(GIVEN, F.array(*[F.lit(n) for n in schema.names]))
        rows = rows.withColumn(AT, F.lit(at))
        if shape.day:
            day = F.lit(None).cast("date")
            if shape.day in rows.columns:
                # the UTC day whatever the session zone; rebalance splits a day that is too large
                day = F.date_from_unix_date(F.floor(F.unix_seconds(F.col(shape.day).cast("timestamp")) / 86400).cast("int"))
            rows = rows.withColumn(DAY, day).hint("rebalance", DAY)
        written = self._write(rows, self.folder(writer, which), [DAY] if shape.day else [])
        names = set(self._columns.names) if self._columns else set()
        self._columns = T.StructType([*(self._columns or []), *[f for f in schema if f.name not in names]])
        return seen.get["rows"] if written is None else written

    def _write(self, rows: DataFrame, folder: str, filed: list[str]) -> int | None:
        """How many rows were written, where the way of writing tells."""
        rows.write.mode("overwrite").partitionBy(*filed).parquet(folder)

    def _create(self, schema: T.StructType, shape: Shape) -> None:
        """A batch without rows tells the columns of a table that has none yet; the shape comes last."""
        empty = self.spark.createDataFrame([], T.StructType([*schema, T.StructField(AT, T.LongType())])).coalesce(1)
        folder = self.folder(self._me, "columns")
        empty.write.mode("overwrite").parquet(f"{folder}/{DAY}=__HIVE_DEFAULT_PARTITION__" if shape.day else folder)
        folders.write_text(self.spark, f"{self.path}/_shape", json.dumps({k: v for k, v in vars(shape).items() if v}))
        self._shape_kept = None  # another writer's may have come first
        self._shape()

    # ---- reading -----------------------------------------------------------------------------

    def read(self, at_least: str | None = None, without: Batch | None = None) -> DataFrame:
        """What the table holds now; of one filed by day, from a day on; or as if a batch had not been written."""
        if not self.exists():
            raise FileNotFoundError(f"no table at {self.path}")
        shape, rows = self._shape(), self._stored()
        if at_least is not None and shape.day:
            rows = rows.where(F.col(DAY) >= F.lit(at_least).cast("date"))
        if without:
            rows = rows.where(~self._is(without))
        return _shown(rows, shape)

    def _is(self, batch: Batch) -> Column:
        writer, which = batch
        return (F.col(WRITER) == f"w{writer}") & (F.col(BATCH) == f"b{which}")

    def batches(self) -> dict[str, int]:
        """The highest number of each writer's batches, by the names of folders alone."""
        out = {}
        for name in folders.names(self.spark, self.path):
            if name.startswith(f"{WRITER}=w"):
                numbers = [n.removeprefix(f"{BATCH}=b") for n in folders.names(self.spark, f"{self.path}/{name}")]
                numbers = [int(n) for n in numbers if n.isdigit()]
                if numbers:
                    out[unquote(name.removeprefix(f"{WRITER}=w"))] = max(numbers)
        return out

    def read_new(self, seen: Mapping[str, int], upto: Mapping[str, int]) -> DataFrame:
        """What the table would hold of the batches after those ``seen`` of each writer, up to others.

        Only their folders are read.  For whoever goes by batches and needs no row of an earlier one.
        """
        return _shown(self._new(seen, upto), self._shape())

    def _new(self, seen: Mapping[str, int], upto: Mapping[str, int]) -> DataFrame:
        number = F.substr(F.col(BATCH), F.lit(2)).try_cast("long")
        new = [
            (F.col(WRITER) == f"w{writer}") & (number > seen.get(writer, -1)) & (number <= last)
            for writer, last in upto.items() if last > seen.get(writer, -1)
        ]
        return self._stored().where(reduce(lambda a, b: a | b, new, F.lit(False)))

    def read_batch(self, batch: Batch) -> DataFrame:
        """The rows of one batch as they were written."""
        return self._stored().where(self._is(batch)).drop(*OWN)

    def fold(self, into: str) -> Table:
        """What the table holds now, as a new table of the same shape at another path."""
        shape = self._shape()
        folded = Table(self.spark, into, shape)
        folded.add(_settled(self._stored(), shape).drop(*OWN), ("fold", 0))
        return folded


def _settled(rows: DataFrame, shape: Shape) -> DataFrame:
    if shape.keys:
        return _newest(rows, [c for c in rows.columns if c not in OWN], shape, GIVEN in rows.columns)
    return _remaining(rows, shape.gone) if shape.gone else rows


def _shown(rows: DataFrame, shape: Shape) -> DataFrame:
    hidden = {*OWN, *shape.hidden, *([shape.gone[2]] if shape.gone else [])}
    return _settled(rows, shape).select(*[F.col(f"`{n}`") for n in rows.columns if n not in hidden])


def _newest(rows: DataFrame, names: Sequence[str], shape: Shape, partly: bool) -> DataFrame:
    """The last row of each key; columns that a write did not have keep what they were."""
    order, keys = [*[c for c in shape.order if c in names], AT], list(shape.keys)
    if not partly:
        return merge.dedupe_last(rows.drop(WRITER, BATCH), keys, order)
    # keys that some write gave in part: each column from the last write that had it
    in_part = rows.where(F.col(GIVEN).isNotNull()).select(*keys).distinct()
    no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])  # nothing else is the same row
    whole = merge.dedupe_last(rows.where(F.col(GIVEN).isNull() | no_key).drop(GIVEN, WRITER, BATCH), keys, order)
    parts = join_aggregated(rows, in_part, keys, "left_semi")
    last = F.struct(*[F.col(f"`{c}`") for c in order])
    had = lambda name: F.col(GIVEN).isNull() | F.array_contains(GIVEN, F.lit(name))
    rest = [n for n in names if n not in keys]
    parts = parts.groupBy(*keys).agg(*[F.max_by(F.col(f"`{n}`"), F.when(had(n), last)).alias(n) for n in rest])
    return merge.delete_by_key(whole, in_part, keys).unionByName(parts, allowMissingColumns=True)


def _remaining(rows: DataFrame, gone: tuple[str, str, str]) -> DataFrame:
    """Rows of a history that no delete of their id at or after them removes."""
    name, changed, deleted = gone
    if deleted not in rows.columns:
        return rows
    until = rows.where(F.col(deleted).isNotNull()).groupBy(name).agg(F.max(deleted).alias("tm_until"))
    live = join_aggregated(rows.where(F.col(deleted).isNull()), until, [name], "left")
    return live.where(F.col("tm_until").isNull() | (F.col(changed) > F.col("tm_until"))).drop("tm_until")


def open_table(spark: SparkSession, path: str, shape: Shape | None = None, fmt: str = "parquet"):
    """A table of the requested format: ``parquet``, the same with ``staged`` batches, or ``delta`` (needs its package)."""
    if fmt == "delta":
        from tidemark.sources.delta import DeltaLakeTable

        return DeltaLakeTable(spark, path, shape)
    if fmt == "staged":
        from tidemark.sources.destination import StagedTable

        return StagedTable(spark, path, shape)
    return Table(spark, path, shape)
