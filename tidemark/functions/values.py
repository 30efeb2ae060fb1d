"""Column-wise clean-up applied to whole frames."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import datetime_text, json_text, parse_datetime

DATETIMES = (T.TimestampType, T.TimestampNTZType)
FLOATS = (T.FloatType, T.DoubleType)
NESTED = (T.ArrayType, T.MapType, T.StructType)


def _rewrite(df: DataFrame, rewrite) -> DataFrame:
    """Project every column through ``rewrite(column, dtype)`` in a single select."""
    return df.select(
        *[rewrite(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields]
    )


def dates_to_strings(df: DataFrame) -> DataFrame:
    """Datetime columns as text with microseconds and offset; dates as ``yyyy-MM-dd``."""

    def rewrite(column: Column, dtype: T.DataType) -> Column:
        if isinstance(dtype, DATETIMES):
            return datetime_text(column, dtype)
        return column.cast("string") if isinstance(dtype, T.DateType) else column

    return _rewrite(df, rewrite)


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN in float columns becomes null."""
    return _rewrite(
        df, lambda c, t: F.when(~F.isnan(c), c) if isinstance(t, FLOATS) else c
    )


def nested_to_text(df: DataFrame) -> DataFrame:
    """Arrays, maps and structs as JSON text; scalars and nulls unchanged."""
    return _rewrite(df, lambda c, t: json_text(c, t) if isinstance(t, NESTED) else c)


def typed_watermark(value: object, dtype: T.DataType) -> Column | None:
    """A stored watermark as a literal of the column's own type, or None when there is none.

    Keeping the column bare and casting the literal lets the comparison reach the Parquet scan.
    Unreadable text falls back to the epoch for datetimes and to "no watermark" for numbers.
    """
    if value is None or value == "None" or isinstance(value, Column):
        return value if isinstance(value, Column) else None
    if isinstance(dtype, (*DATETIMES, T.DateType)):
        if isinstance(value, (datetime, date)):
            return F.lit(value).cast(dtype)
        return parse_datetime(F.lit(str(value))).cast(dtype)
    if isinstance(dtype, T.NumericType):
        try:
            float(str(value))
        except ValueError:
            return None
        return F.lit(str(value)).cast(dtype)
    return F.lit(str(value))
