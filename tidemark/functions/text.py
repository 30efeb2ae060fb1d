"""Text forms of values: datetimes, JSON, row keys, URLs."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The text patterns state values and exported datetimes use.
DATETIME_PATTERN = "yyyy-MM-dd HH:mm:ss.SSSSSS"
OFFSET_PATTERN = "xx"
PARSE_PATTERN = "yyyy-MM-dd HH:mm:ss[.SSSSSS][XXX][XX]"
DATE_PATTERN = "yyyy-MM-dd"
EPOCH = "1970-01-01 00:00:00"


def datetime_text(column: str | Column, dtype: T.DataType) -> Column:
    """``2024-01-05 10:11:12.000345+0000``; a zone-less timestamp carries no offset."""
    column = F.col(column) if isinstance(column, str) else column
    if isinstance(dtype, T.TimestampNTZType):
        return F.date_format(column, DATETIME_PATTERN)
    return F.date_format(column, DATETIME_PATTERN + OFFSET_PATTERN)


def parse_datetime(text: str | Column) -> Column:
    """Watermark text to an instant: timestamp, else a date at midnight, else the epoch.

    A missing offset means UTC (the session zone).  Null stays null, so "no watermark" remains
    distinguishable from "a watermark nobody can read", which restarts from the epoch.
    """
    text = F.col(text) if isinstance(text, str) else text
    parsed = F.coalesce(
        F.try_to_timestamp(text, F.lit(PARSE_PATTERN)),
        F.try_to_timestamp(text, F.lit(DATE_PATTERN)),
        F.lit(EPOCH).cast("timestamp"),
    )
    return F.when(text.isNotNull(), parsed)


def json_text(column: str | Column, dtype: T.DataType) -> Column:
    """JSON text with ``", "`` and ``": "`` separators for string maps, compact otherwise."""
    column = F.col(column) if isinstance(column, str) else column
    if isinstance(dtype, T.MapType) and isinstance(dtype.valueType, T.StringType):

        def scalar(value: Column) -> Column:
            quoted = F.to_json(F.array(value))
            return F.substr(quoted, F.lit(2), F.length(quoted) - 2)

        pairs = F.transform(
            F.map_entries(column),
            lambda e: F.concat(scalar(e["key"]), F.lit(": "), scalar(e["value"])),
        )
        return F.concat(F.lit("{"), F.array_join(pairs, ", "), F.lit("}"))
    return F.to_json(column)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, however often the body mentions it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _shortest(column: Column, raw: Column) -> Column:
    """Java's text of a double, minus the surplus digits JVMs before 19 print now and then.

    Only texts long enough to have 16 digits are tried with 15 and more; a candidate counts when
    it reads back as the same double.
    """
    choice = F.when(F.length(raw) < 17, raw)
    for digits in (15, 16, 17):
        candidate = F.format_string(f"%.{digits - 1}e", column)
        # 1.500000000000000e+08 -> 1.5E8
        tidy = F.regexp_replace(candidate, r"(\.\d+?)0*e[+]?(-?)0?", "$1E$2")
        choice = choice.when(candidate.try_cast("double") == column, tidy)
    return choice.otherwise(raw)


def _plain_or_exponent(column: Column, short: Column) -> Column:
    size = F.abs(column)
    # decimal(38,20) holds 18 integer digits and every fraction digit a double of this size prints
    decimal = short.try_cast("decimal(38,20)").cast("string")
    mantissa = F.regexp_replace(F.substring_index(short, "E", 1), r"\.0$", "")
    power = F.substring_index(short, "E", -1).try_cast("int")
    sign = F.when(power < 0, "e-").otherwise("e+")
    return (
        F.when(F.isnan(column), "nan")
        .when(size == float("inf"), F.when(column > 0, "inf").otherwise("-inf"))
        .when(~F.contains(short, F.lit("E")), short)
        .when((size >= 1e-4) & (size < 1e16), F.regexp_replace(decimal, r"(\.\d+?)0+$", "$1"))
        .otherwise(F.concat(mantissa, sign, F.lpad(F.abs(power).cast("string"), F.greatest(F.length(F.abs(power).cast("string")), F.lit(2)), F.lit("0"))))
    )


def number_text(column: Column) -> Column:
    """A double as shortest decimal text: ``12345678.9``, ``1e-05``, ``1e+16``, ``nan``, ``inf``.

    Spark's own cast switches to exponent form at 1e7 and writes ``1.0E16``; row keys hashed
    before the switch to Spark used the form below.  On JVMs before 19 the 17th digit may differ
    above 1e17, where their text is rounded twice.
    """
    column = column.cast("double")
    raw, size = column.cast("string"), F.abs(column)
    exact = _let(
        raw, lambda r: _let(_shortest(column, r), lambda short: _plain_or_exponent(column, short))
    )
    # the common case needs no second look: no exponent, too few digits to be wrong
    usual = (size == 0) | (size >= 1e-3) & (size < 1e7) & (F.length(raw) < 17)
    return F.when(usual, raw).otherwise(exact)


def value_text(column: str | Column, dtype: T.DataType) -> Column:
    """Text a value contributes to a row key; null becomes ``None``, booleans ``True``/``False``."""
    column = F.col(column) if isinstance(column, str) else column
    if isinstance(dtype, T.BooleanType):
        text = F.when(column, "True").when(~column, "False")
    elif isinstance(dtype, T.DoubleType):
        # the scan side turns NaN into null before any key is built
        text = F.when(~F.isnan(column), number_text(column))
    elif isinstance(dtype, T.FloatType):
        text = F.when(~F.isnan(column), column.cast("string"))
    elif isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        text = datetime_text(column, dtype)
    elif isinstance(dtype, (T.ArrayType, T.MapType, T.StructType)):
        text = json_text(column, dtype)
    else:
        text = column.cast("string")
    return F.coalesce(text, F.lit("None"))


def md5_key(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """md5 hex over the ``-``-joined text of the named columns, or of all of them."""
    names = list(columns) if columns else df.columns
    return F.md5(F.concat_ws("-", *[value_text(F.col(f"`{n}`"), df.schema[n].dataType) for n in names]))


def joined_key(df: DataFrame, columns: Sequence[str]) -> Column:
    """The ``-``-joined text of the named columns, unhashed.

    Of several columns, a ``-`` or ``\\`` within a value is escaped, so different rows have different keys.
    """
    parts = [value_text(F.col(f"`{n}`"), df.schema[n].dataType) for n in columns]
    if len(parts) > 1:
        parts = [F.regexp_replace(p, r"([\\-])", r"\\$1") for p in parts]
    return F.concat_ws("-", *parts)


def storage_url_parts(url: str | Column) -> Column:
    """``scheme://container@account.host/path`` as struct(container, account, path).

    Without ``@`` the container is the whole authority and the account is null.
    """
    url = F.col(url) if isinstance(url, str) else url
    authority = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    host = F.substring_index(authority, "@", -1)
    return F.struct(
        F.substring_index(authority, "@", 1).alias("container"),
        F.when(F.contains(authority, F.lit("@")), F.substring_index(host, ".", 1)).alias("account"),
        F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1).alias("path"),
    )


def base_name(path: str | Column) -> Column:
    """Text after the last slash."""
    path = F.col(path) if isinstance(path, str) else path
    return F.substring_index(path, "/", -1)
