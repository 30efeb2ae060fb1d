"""Watermarks as rows: (state_id, low, high, value_type), values kept as text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import datetime_text, parse_datetime

SIDES = ("low", "high")
#: The stored text of a state that was set back.
CLEARED = ""


def value_text(column: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return datetime_text(column, dtype)
    return column.cast("string")


def _state_row(state_id: Column, value: Column, dtype: T.DataType, side: str) -> list[Column]:
    if side not in SIDES:
        raise ValueError(f"side must be one of {SIDES}")
    text = value_text(value, dtype)
    empty = F.lit(None).cast("string")
    return [
        state_id.alias("state_id"),
        (text if side == "low" else empty).alias("low"),
        (text if side == "high" else empty).alias("high"),
        F.lit(dtype.simpleString()).alias("value_type"),
    ]


def batch_watermark(df: DataFrame, field: str, state_id: str, side: str = "low") -> DataFrame:
    """One state row holding the highest value of ``field``; null when there were no rows."""
    top = df.agg(F.max(field).alias("top"))
    return top.select(*_state_row(F.lit(state_id), F.col("top"), df.schema[field].dataType, side))


def series_state_id(path: str, external_id: Column) -> Column:
    return F.concat(F.lit(f"{path}-"), external_id, F.lit("-state"))


def series_watermark(points: DataFrame, path: str) -> DataFrame:
    """One state row per series: its latest timestamp."""
    dtype = points.schema["timestamp"].dataType
    latest = points.groupBy("externalId").agg(F.max("timestamp").alias("top"))
    return latest.select(
        *_state_row(series_state_id(path, F.col("externalId")), F.col("top"), dtype, "low")
    )


def series_bounds(states: DataFrame, path: str) -> DataFrame:
    """The states of one path back as (externalId, since), ready to join to its points."""
    head, tail = f"{path}-", "-state"
    is_series = F.startswith("state_id", F.lit(head)) & F.endswith("state_id", F.lit(tail))
    size = F.length("state_id") - F.lit(len(head) + len(tail))
    return states.where(is_series).select(
        F.substr("state_id", F.lit(len(head) + 1), size).alias("externalId"),
        parse_datetime("low").alias("since"),
    )


def batch_state_id(path: str, writer: str) -> str:
    return f"{path}#batch#{writer}"


def set_rows(new: DataFrame) -> DataFrame:
    """The rows that set something: an empty value (null, 0) leaves the stored one alone."""
    value = F.coalesce("low", "high")
    return new.where(value.isNotNull() & ~value.isin("", "0", "0.0"))


def settled(history: DataFrame, order: str = "seq") -> DataFrame:
    """One row per state from its settings in order; a side not set keeps its earlier value."""
    newest = {
        c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c)
        for c in ("low", "high", "value_type")
    }
    return history.groupBy("state_id").agg(*newest.values(), F.max(order).alias(order))


def latest(history: DataFrame, order: str = "seq") -> DataFrame:
    """The settled states, sides that were set back as null."""
    rows = settled(history, order)
    return rows.select("state_id", *[F.nullif(F.col(c), F.lit(CLEARED)).alias(c) for c in SIDES], "value_type")


def advance(states: DataFrame, new: DataFrame) -> DataFrame:
    """The states after setting the new rows."""
    before = states.withColumn("seq", F.lit(0))
    return latest(before.unionByName(set_rows(new).withColumn("seq", F.lit(1))))


def has_recent_update(instances: DataFrame, run_start: int, field: str = "lastUpdatedTime") -> DataFrame:
    """One row: did anything change at or after the run's start?"""
    return instances.agg(
        F.coalesce(F.max(field) >= F.lit(run_start), F.lit(False)).alias("has_recent_update")
    )
