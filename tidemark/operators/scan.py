"""Incremental reads of a table driven by a stored watermark."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidemark.functions.values import typed_watermark
from tidemark.operators.joins import join_aggregated


def since(
    df: DataFrame, field: str, watermark: object = None, up_to: object = None
) -> DataFrame:
    """Rows with ``field > watermark`` (all rows without one), at most ``up_to``.

    The upper bound closes a run at its start time, so rows changing meanwhile wait for the next.
    """
    dtype = df.schema[field].dataType
    low = typed_watermark(watermark, dtype)
    high = typed_watermark(up_to, dtype)
    if low is not None:
        df = df.where(F.col(field) > low)
    return df if high is None else df.where(F.col(field) <= high)


def in_order(df: DataFrame, field: str, *tie_break: str) -> DataFrame:
    """Ascending by the incremental field; a range-partitioned global sort."""
    return df.orderBy(field, *tie_break)


def next_batch(df: DataFrame, field: str, size: int, watermark: object = None) -> DataFrame:
    """The first ``size`` rows after the watermark, with every tie of the last one.

    A batch that cut between equal values would lose the rest of them: the next run starts
    strictly above the value reached here.  Two scans: a top-n of the one column (``size`` is what the
    caller is ready to take at once), and the rows, with the end pushed down as a plain ``<=``.  To
    go through a whole table batch by batch, follow it as a stream.
    """
    rows = since(df, field, watermark)
    first = rows.select(field).where(F.col(field).isNotNull()).orderBy(field).limit(size)
    within = F.col(field) <= first.agg(F.max(field)).scalar()
    if typed_watermark(watermark, df.schema[field].dataType) is None:
        # a null never exceeds a watermark, so the first load is its only chance
        within = within | F.col(field).isNull()
    return rows.where(within)


def _number(field: str, dtype: T.DataType) -> tuple[Column, Callable[[object], Column]]:
    """The field as a number of the same order, and a number as a value of the field."""
    column = F.col(field)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(column.cast("timestamp")), lambda v: F.timestamp_micros(F.lit(v)).cast(dtype)
    if isinstance(dtype, T.DateType):
        return F.unix_date(column).cast("long"), lambda v: F.date_from_unix_date(F.lit(v).cast("int"))
    if isinstance(dtype, T.IntegralType):
        return column.cast("long"), F.lit
    if isinstance(dtype, T.FractionalType):
        return F.nanvl(column.cast("double"), F.lit(None)), F.lit
    raise TypeError(f"{field}: batches need a number or a time, not {dtype.simpleString()}")


#: About how many rows a cell holds, within which rows are ranked; and into how many a table is cut at most.
CELL, CELLS = 100_000, 4096


def _cuts(df: DataFrame, number: Column, kind: str, size: int, k: int = 8192) -> tuple[int, list[object]]:
    """How many rows have a number, and numbers that end cells of about ``size`` of them, the highest last.

    Quantiles come from a KLL sketch of at most some ``8 * k`` bytes a task, whatever the table's size; they
    are off by a share of all rows, some 0.1% with this ``k``.
    """
    sketch = getattr(F, f"kll_sketch_agg_{kind}")(number, F.lit(k))
    one = df.agg(sketch.alias("sketch"), F.max(number).alias("top"), F.count(number).alias("n")).first()
    cells = min(math.ceil(one["n"] / size), CELLS)
    if cells < 2:
        return one["n"], [one["top"]] * cells
    shares = F.array(*[F.lit(j / cells) for j in range(1, cells + 1)])
    quantiles = getattr(F, f"kll_sketch_get_quantile_{kind}")(F.lit(one["sketch"]), shares)
    ends = df.sparkSession.range(1).select(quantiles.alias("ends")).first()["ends"]
    return one["n"], sorted({*ends[:-1], one["top"]})


def _place(number: Column, ends: list[object], kind: str) -> Column:
    """Which of ascending ends is the first not below a number: from 0, as many as there are for one above all."""
    sorted_ends = np.array(ends, dtype="int64" if kind == "bigint" else "float64")

    @F.pandas_udf("int")
    def place(values: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(sorted_ends, values.to_numpy(), side="left"))

    # nulls would turn whole numbers into fractions on their way to pandas
    return F.when(number.isNotNull(), place(F.coalesce(number, F.lit(ends[0]))))


def _kind(dtype: T.DataType) -> str:
    return "double" if isinstance(dtype, T.FractionalType) else "bigint"


def row_numbers(df: DataFrame, field: str, name: str, *tie_break: str) -> DataFrame:
    """The rows numbered from 1 in the order of a field, those without a value (null, NaN) first.

    Rows are ranked within cells that a sketch cuts, and cells start where those before them end, so no
    task sees all rows.
    """
    number, _ = _number(field, df.schema[field].dataType)
    kind = _kind(df.schema[field].dataType)
    _, cells = _cuts(df, number, kind, CELL)
    cell = F.coalesce(_place(number, cells, kind), F.lit(-1)) if cells else F.lit(-1)
    placed = df.withColumn("__cell", cell)
    before = Window.orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)  # a row for each cell
    starts = placed.groupBy("__cell").agg(F.count(F.lit(1)).alias("n"))
    starts = starts.select("__cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__start"))
    place = F.row_number().over(Window.partitionBy("__cell").orderBy(field, *tie_break))
    return placed.withColumn(name, place).join(starts, "__cell").withColumn(name, F.col("__start") + F.col(name)).drop("__cell", "__start")


def batch_ends(df: DataFrame, field: str, size: int, k: int = 8192) -> list[object]:
    """Numbers that cut the field into batches of at most ``size`` rows, and of half as many at least.

    A sketch cuts the values into cells of some 100,000 rows; within each the rows are ranked, so batches are
    as even in a large table as in a small one.  A value with many rows is in one batch whole.
    """
    (number, _), kind = _number(field, df.schema[field].dataType), _kind(df.schema[field].dataType)
    rows, cells = _cuts(df, number, kind, max(CELL, size * 8), k)
    if not rows:
        return []
    counts = df.select(number.alias("number")).where("number is not null").groupBy("number").agg(F.count(F.lit(1)).alias("n"))
    placed = counts.withColumn("cell", _place(F.col("number"), cells, kind)).where(F.col("cell") < len(cells))
    one = Window.partitionBy("cell")
    before = F.sum("n").over(one.orderBy("number").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")
    batch = F.floor(before * F.ceil(F.sum("n").over(one) / size) / F.sum("n").over(one))
    ends = placed.select("cell", "number", batch.alias("batch")).groupBy("cell", "batch").agg(F.max("number").alias("end"))
    return sorted(r["end"] for r in ends.select("end").collect())


class Batches:
    """A whole table as batches in the order of a field: one after the other, or all at once by their numbers."""

    def __init__(self, df: DataFrame, field: str, size: int) -> None:
        self.df, self.field = df, field
        self._number, self._value = _number(field, df.schema[field].dataType)
        self._ends = batch_ends(df, field, size)

    def __iter__(self) -> Iterator[DataFrame]:
        """Each batch is a range that the scan can push down, for whoever takes one at a time."""
        if not self._ends:
            yield self.df.where(self._number.isNull())
        for k, end in enumerate(self._ends):
            within = F.col(self.field) <= self._value(end)
            yield self.df.where(within & (F.col(self.field) > self._value(self._ends[k - 1])) if k else within | self._number.isNull())

    def numbered(self, name: str) -> DataFrame:
        """The rows of all batches with the number of theirs, from 0: one pass, however many batches there are."""
        if not self._ends:
            return self.df.where(self._number.isNull()).withColumn(name, F.lit(0))
        place = F.coalesce(_place(self._number, self._ends, _kind(self.df.schema[self.field].dataType)), F.lit(0))
        return self.df.withColumn(name, place).where(F.col(name) < len(self._ends))


def in_batches(df: DataFrame, field: str, size: int) -> Batches:
    """The whole table as batches of about ``size`` rows in the order of ``field``, ties together.

    Where all batches end is found first.  Rows without a value (null, NaN) come with the first.  Rows above
    the highest value seen then are left for another time.
    """
    return Batches(df, field, size)


def events_since(
    events: DataFrame, last_created: int | Column | None, data_set: str, size: int | None = None
) -> DataFrame:
    """Events of one data set created at ``last + 1`` or later (from 1 on the first run).

    With ``size`` only the first of them, oldest first; without it nothing needs an order.
    """
    bound = F.coalesce(F.lit(last_created).cast("long"), F.lit(0)) + 1
    rows = events.where((F.col("createdTime") >= bound) & (F.col("dataSet") == data_set))
    return rows if size is None else in_order(next_batch(rows, "createdTime", size), "createdTime")


def series_since(points: DataFrame, watermarks: DataFrame) -> DataFrame:
    """Points newer than their own series' watermark; series without one come whole.

    ``watermarks`` is (externalId, since), one row per series.  One pass over the points serves
    every series, and a series holding most of them is split.
    """
    joined = join_aggregated(points, watermarks.select("externalId", "since"), ["externalId"], "left")
    newer = F.col("since").isNull() | (
        F.col("timestamp") > F.col("since").cast(points.schema["timestamp"].dataType)
    )
    return joined.where(newer).select(*points.columns)


def distinct_ids(df: DataFrame, column: str = "externalId") -> DataFrame:
    return df.select(column).distinct()


def subscription_members(series: DataFrame, partitions: int) -> DataFrame:
    """Series having an external id, each assigned to one of ``partitions`` by its md5.

    The assignment depends on the id alone, so it is stable across runs and engines.
    """
    prefix = F.conv(F.substr(F.md5("externalId"), F.lit(1), F.lit(8)), 16, 10).cast("long")
    return (
        series.where(F.col("externalId").isNotNull())
        .select("externalId", F.pmod(prefix, F.lit(partitions)).cast("int").alias("partition"))
    )
