"""Schemas of the feeds and tables the jobs exchange."""

from __future__ import annotations

from pyspark.sql import types as T


def points_feed(value: T.DataType = T.DoubleType()) -> T.StructType:
    """One change-feed record per series: parallel arrays of epoch milliseconds and values.

    String-valued series come on a feed, and go to a table, of their own.
    """
    upserts = [
        T.StructField("timestamp", T.ArrayType(T.LongType())),
        T.StructField("value", T.ArrayType(value)),
    ]
    return T.StructType(
        [
            T.StructField("external_id", T.StringType()),
            T.StructField("upserts", T.StructType(upserts)),
            T.StructField("cursor", T.LongType()),
        ]
    )


POINTS_FEED = points_feed()

# Optional columns of an event as stored in the lake; externalId and startTime are mandatory.
EVENT_OPTIONAL = {
    "endTime": T.LongType(),
    "type": T.StringType(),
    "subtype": T.StringType(),
    "metadata": T.MapType(T.StringType(), T.StringType()),
    "description": T.StringType(),
    "assetExternalIds": T.ArrayType(T.StringType()),
}

WATERMARKS = T.StructType(
    [
        T.StructField("state_id", T.StringType()),
        T.StructField("low", T.StringType()),
        T.StructField("high", T.StringType()),
        T.StructField("value_type", T.StringType()),
    ]
)

RUN_LOG = T.StructType(
    [
        T.StructField("pipeline", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("logged_at", T.TimestampType()),
    ]
)

FILES = T.StructType(
    [
        T.StructField("external_id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("data_set_id", T.LongType()),
        T.StructField("source_created_time", T.LongType()),
        T.StructField("source_modified_time", T.LongType()),
        T.StructField("length", T.LongType()),
    ]
)
