"""Joining against a side that was aggregated by the join's own keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HASH = "__key_hash"


def join_aggregated(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join ``left`` to a ``right`` side that holds each key once, whatever a key's share of left.

    AQE splits a skewed partition only when both inputs come straight from a shuffle.  An
    aggregation by the join keys already is partitioned by them, so Spark would join it as it
    stands and leave a hot key of the left side to one task.  A hash of the keys as a further
    join key makes it shuffle the (already reduced) right side once more.  When the right side
    is small enough to broadcast, neither side is shuffled.
    """
    keys = list(keys)
    # equal values of different types hash differently, so such keys only take part as they are
    alike = [k for k in keys if left.schema[k].dataType == right.schema[k].dataType]
    if not alike:
        return left.join(right, keys, how)
    hashed = F.xxhash64(*[F.col(f"`{k}`") for k in alike])
    return (
        left.withColumn(HASH, hashed)
        .join(right.withColumn(HASH, hashed), [*keys, HASH], how)
        .drop(HASH)
    )
