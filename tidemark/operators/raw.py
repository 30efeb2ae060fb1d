"""Free-form key-value rows: promoting their columns and giving exported rows a key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import joined_key, md5_key
from tidemark.functions.values import dates_to_strings, nan_to_null, nested_to_text

RAW_FIXED = ("key", "last_updated_time")
OTHER = "other_columns"
ROW_KEY = "row_key"


def column_names(rows: DataFrame) -> DataFrame:
    """Distinct names used in the ``columns`` maps, one row each."""
    return rows.select(F.explode(F.map_keys("columns")).alias("name")).distinct()


def flatten_rows(rows: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """``columns`` promoted to real columns, plus ``key`` and ``last_updated_time``.

    The fixed two win over promoted columns of the same name.  ``columns`` is a struct, or a map:
    of a map the declared ``names`` become columns, and whatever else it holds stays in a map
    column ``other_columns`` (null where nothing is left), so rows may use any number of names.
    """
    dtype = rows.schema["columns"].dataType
    if isinstance(dtype, T.StructType):
        promoted = [F.col(f"columns.`{n}`").alias(n) for n in dtype.fieldNames() if n not in RAW_FIXED]
        return rows.select(*promoted, *RAW_FIXED)
    listed = [n for n in names or () if n not in RAW_FIXED]
    promoted = [F.col("columns")[n].alias(n) for n in listed]
    known = F.array(*[F.lit(n) for n in (*listed, *RAW_FIXED)])
    other = F.map_filter("columns", lambda name, _: ~F.array_contains(known, name))
    other = F.when(F.size(other) > 0, other).alias(OTHER)
    return rows.select(*promoted, other, *RAW_FIXED)


def found_columns(rows: DataFrame, column: str = "columns") -> list[tuple[str, str]]:
    """(name, type) of what the JSON objects of a text column hold, found by an aggregate over all of them.

    Whole numbers are ``bigint``, other numbers ``double``, truth values ``boolean``; everything else, nested
    values and names whose values differ in kind among them, is ``string``.  One row a name comes back.
    """
    held = rows.select(F.try_parse_json(column).alias("held"))
    each = held.lateralJoin(held.sparkSession.tvf.variant_explode(F.col("held").outer()))
    kinds = each.groupBy("key").agg(F.schema_of_variant_agg("value").alias("kind")).where("key is not null")
    kind = F.regexp_extract("kind", r"^\w+", 0)
    as_ = F.when(kind == "BIGINT", "bigint").when(kind.isin("DECIMAL", "DOUBLE", "FLOAT"), "double").when(kind == "BOOLEAN", "boolean")
    found = kinds.select("key", F.coalesce(as_, F.lit("string")).alias("as")).collect()
    return sorted((r["key"], r["as"]) for r in found)


def _held(name: str, as_: str) -> Column:
    """A name's value in the variant ``columns``; paths have no escapes, so a name with both quotes is looked up."""
    for quote in "\"'":
        if quote not in name:
            return F.try_variant_get("columns", f"$[{quote}{name}{quote}]", as_)
    return F.try_variant_get(F.col("columns").try_cast("map<string,variant>")[name], "$", as_)


def flatten_json(rows: DataFrame, names: Sequence[tuple[str, str]] | None = None) -> DataFrame:
    """As ``flatten_rows``, of a ``columns`` column of JSON text, whose names and types are found if not given.

    Every text is parsed once, as a variant.  A text that is no object, and a name that it lacks, give nulls;
    a value that does not fit its column's type gives null, and nested values stay JSON text.
    """
    names = found_columns(rows) if names is None else names
    held = rows.withColumn("columns", F.try_parse_json("columns"))
    promoted = [_held(name, as_).alias(name) for name, as_ in names if name not in RAW_FIXED]
    return held.select(*promoted, *RAW_FIXED)


def export_rows(
    df: DataFrame,
    key_fields: Sequence[str] | None = None,
    md5: bool = False,
) -> DataFrame:
    """Lake rows as text-friendly RAW rows, their key in a column ``row_key``.

    A column ``key`` of the table is data like any other and stays.  Datetimes and nested values become text, NaN becomes null.  The key is the md5 of the key
    fields (all columns when none are named) with ``md5`` on, the joined key fields otherwise,
    and the md5 of all columns when neither is given: a row's position is no stable key.
    """
    clean = nan_to_null(dates_to_strings(nested_to_text(df)))
    key = joined_key(clean, key_fields) if key_fields and not md5 else md5_key(clean, key_fields)
    return clean.withColumn(ROW_KEY, key)
