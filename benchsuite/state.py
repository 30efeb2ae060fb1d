"""Watermarks and the run log."""

from __future__ import annotations

from pyspark.sql import functions as F

from benchsuite import domain as d
from benchsuite.registry import query
from tidemark.functions import text
from tidemark.operators import watermark


@query(
    "watermark_parse",
    """SELECT event_id, CASE event_type WHEN 'click' THEN ts WHEN 'error' THEN ts
         WHEN 'view' THEN date_trunc('second', ts) WHEN 'signup' THEN date_trunc('day', ts)
         ELSE TIMESTAMP '1970-01-01' END AS watermark FROM events""",
)
def watermark_parse(spark, sf):
    """Five spellings of a stored watermark; the last one nobody can read."""
    ts = F.col("ts")
    stored = (
        F.when(F.col("event_type") == "click", F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS'+0000'"))
        .when(F.col("event_type") == "error", F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS'+00:00'"))
        .when(F.col("event_type") == "view", F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
        .when(F.col("event_type") == "signup", F.date_format(ts, "yyyy-MM-dd"))
        .otherwise(F.col("props"))
    )
    rows = d.table(spark, sf, "events").select("event_id", stored.alias("stored"))
    return rows.select(
        "event_id", text.parse_datetime("stored").cast("timestamp_ntz").alias("watermark")
    )


@query(
    "watermark_max",
    """SELECT 'events-state' AS state_id, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS low,
         CAST(NULL AS VARCHAR) AS high, 'timestamp_ntz' AS value_type FROM events
       UNION ALL
       SELECT 'event_state', NULL, CAST(max(epoch_ms(o_orderdate)) AS VARCHAR), 'bigint' FROM orders""",
)
def watermark_max(spark, sf):
    by_time = watermark.batch_watermark(d.table(spark, sf, "events"), "ts", "events-state")
    created = watermark.batch_watermark(d.events(spark, sf), "createdTime", "event_state", "high")
    return by_time.unionByName(created)


SERIES_SQL = """SELECT 'Tables/RawTS-user_' || user_id || '-state' AS state_id,
  strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS low, CAST(NULL AS VARCHAR) AS high, 'timestamp_ntz' AS value_type
  FROM events {where} GROUP BY user_id"""


@query("watermark_per_series", SERIES_SQL.format(where=""))
def watermark_per_series(spark, sf):
    return watermark.series_watermark(d.points(spark, sf), "Tables/RawTS")


@query(
    "watermark_series_bounds",
    """SELECT 'user_' || user_id AS "externalId", max(ts) AS since FROM events GROUP BY 1""",
)
def watermark_series_bounds(spark, sf):
    states = watermark.series_watermark(d.points(spark, sf), "Tables/RawTS")
    bounds = watermark.series_bounds(states, "Tables/RawTS")
    return bounds.withColumn("since", F.col("since").cast("timestamp_ntz"))


@query(
    "watermark_table",
    f"""WITH old AS ({SERIES_SQL.format(where="WHERE ts < TIMESTAMP '2024-01-10'")}),
        new AS ({SERIES_SQL.format(where="WHERE event_type = 'click' AND ts >= TIMESTAMP '2024-01-28'")})
        SELECT * FROM old WHERE state_id NOT IN (SELECT state_id FROM new) UNION ALL SELECT * FROM new""",
)
def watermark_table(spark, sf):
    points = d.points(spark, sf)
    events = d.table(spark, sf, "events")
    clicks = events.where((F.col("event_type") == "click") & (F.col("ts") >= "2024-01-28")).select("event_id")
    old = watermark.series_watermark(points.where(F.col("timestamp") < "2024-01-10"), "Tables/RawTS")
    new = watermark.series_watermark(points.join(clicks, "event_id", "left_semi"), "Tables/RawTS")
    empty = new.withColumn("low", F.lit(None).cast("string"))  # runs without rows move nothing
    return watermark.advance(watermark.advance(old, new), empty)


@query(
    "recent_update_flag",
    """SELECT view, max("lastUpdatedTime") >= 1700001999000 AS has_recent_update FROM (
         SELECT 'Part' AS view, 1700000000000 + p_partkey * 1000 AS "lastUpdatedTime" FROM part
         UNION ALL SELECT 'Supplier', 1700000000500 + s_suppkey * 1000 FROM supplier) GROUP BY view""",
)
def recent_update_flag(spark, sf):
    from tidemark.operators.instances import has_data

    nodes = d.nodes(spark, sf)
    flags = [
        watermark.has_recent_update(has_data(nodes, v), 1700001999000).select(
            F.lit(v.external_id).alias("view"), "has_recent_update"
        )
        for v in (d.PART, d.SUPPLIER)
    ]
    return flags[0].unionByName(flags[1])
