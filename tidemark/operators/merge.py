"""Keyed upsert, keyed delete and schema-evolving append as plain joins and unions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.joins import join_aggregated


def _orderable(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.StructType):
        return all(_orderable(f.dataType) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return _orderable(dtype.elementType)
    return not isinstance(dtype, (T.MapType, T.VariantType))


def _any_null(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def _quoted(name: str) -> Column:
    return F.col(f"`{name}`")


def dedupe_last(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = (), keep_null_keys: bool = True
) -> DataFrame:
    """One row per key: the last in ``order_by``, ties broken by the remaining columns.

    An aggregate rather than a ranking window: copies of a key collapse inside each map task, so
    a key holding a third of all rows still shuffles one row per task.  Rows with a null key
    identify nothing and are all kept, unless ``keep_null_keys`` is off.
    """
    rest = [c for c in df.columns if c not in keys]
    if not keep_null_keys:
        df = df.where(~_any_null(keys))
    # a row that nothing identifies is a group of its own
    own = F.when(_any_null(keys), F.monotonically_increasing_id())
    if not rest:
        return df.withColumn("__own", own).distinct().drop("__own")
    ranked = list(order_by) + [
        c for c in rest if c not in order_by and _orderable(df.schema[c].dataType)
    ]
    if all(_orderable(df.schema[c].dataType) for c in rest):
        last = F.max(F.struct(*[_quoted(c) for c in ranked if c in rest]))
    else:
        last = F.max_by(F.struct(*[_quoted(c) for c in rest]), F.struct(*[_quoted(c) for c in ranked]))
    return (
        df.groupBy(*[_quoted(k) for k in keys], own.alias("__own"))
        .agg(last.alias("__last"))
        .select(*[_quoted(c) if c in keys else F.col(f"__last.`{c}`").alias(c) for c in df.columns])
    )


def append_evolving(target: DataFrame, new: DataFrame) -> DataFrame:
    """Bag union by name; columns missing on either side are null there."""
    return target.unionByName(new, allowMissingColumns=True)


def delete_by_key(target: DataFrame, deleted: DataFrame, keys: Sequence[str] = ("externalId",)) -> DataFrame:
    """Target rows whose key is not listed; every version of a listed key goes.

    Keys travel as rows, so quotes in ids need no escaping and the list may be of any length.
    """
    return join_aggregated(target, deleted.select(*keys).distinct(), keys, "left_anti")


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] = (),
    drop: Sequence[str] = (),
) -> DataFrame:
    """MERGE: matched rows take every source column, the others are inserted.

    Null keys match nothing, so such rows of both sides stay.  The source is reduced to its last
    row per key by ``order_by``; columns in ``drop`` only serve that order and are not stored.
    A key the source holds is held once afterwards, however often the target repeats it.

    Rows of other keys stream through an anti join against the narrow, reduced source keys.  When
    the source carries every target column, that is all; columns that only the target has survive
    a match, for which the few matched target rows are joined to the source.
    No side is hinted for broadcast: Catalyst and AQE do so below their size threshold.
    """
    keys = list(keys)
    stored = [c for c in source.columns if c not in drop]
    src = dedupe_last(source, keys, order_by).select(*[_quoted(c) for c in stored])
    kept = [c for c in target.columns if c not in stored]
    untouched = delete_by_key(target, src, keys)
    if kept:
        matched = join_aggregated(target.select(*keys, *[_quoted(c) for c in kept]), src.select(*keys).distinct(), keys, "left_semi")
        src = join_aggregated(src, dedupe_last(matched, keys, keep_null_keys=False), keys, "left")
    return append_evolving(untouched, src)
