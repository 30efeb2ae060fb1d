"""Points and series metadata."""

from __future__ import annotations

from pyspark.sql import functions as F

from benchsuite import domain as d
from benchsuite.registry import query
from tidemark.operators import merge, scan, watermark
from tidemark.operators import points as ops
from tidemark.operators import series as series_ops

KEYS = ops.POINT_KEYS


@query(
    "feed_explode_points",
    """SELECT 'user_' || user_id AS "externalId", date_trunc('millisecond', ts) AS "timestamp", value
       FROM events""",
)
def feed_explode_points(spark, sf):
    points = ops.explode_feed(d.feed(spark, sf)).drop("cursor")
    return points.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


@query(
    "points_dedupe",
    """SELECT 'user_' || user_id AS "externalId", date_trunc('day', ts) AS "timestamp", value, event_id
       FROM events QUALIFY row_number() OVER
         (PARTITION BY user_id, date_trunc('day', ts) ORDER BY event_id DESC) = 1""",
)
def points_dedupe(spark, sf):
    daily = F.date_trunc("day", "timestamp").cast("timestamp_ntz")
    points = d.points(spark, sf).withColumn("timestamp", daily)
    return merge.dedupe_last(points, KEYS, ["event_id"])


UPSERT_SQL = f"""
WITH pts AS ({d.PTS}),
target AS (SELECT "externalId", "timestamp", value FROM pts WHERE "timestamp" < TIMESTAMP '2024-01-20'),
arrived AS (
  SELECT "externalId", "timestamp", value + 1 AS value, 1 AS seq FROM pts WHERE "timestamp" >= TIMESTAMP '2024-01-10'
  UNION ALL
  SELECT "externalId", "timestamp", value + 2, 2 FROM pts WHERE "timestamp" >= TIMESTAMP '2024-01-25'),
source AS (
  SELECT "externalId", "timestamp", value FROM arrived
  QUALIFY row_number() OVER (PARTITION BY "externalId", "timestamp" ORDER BY seq DESC, value DESC) = 1)
SELECT * FROM target t WHERE NOT EXISTS
  (SELECT 1 FROM source s WHERE s."externalId" = t."externalId" AND s."timestamp" = t."timestamp")
UNION ALL SELECT * FROM source"""


def arrivals(spark, sf):
    """Points of the later days, corrected twice for the last of them; ``seq`` is arrival order."""
    points = d.points(spark, sf).drop("event_id")
    once = points.where(F.col("timestamp") >= "2024-01-10").withColumn("value", F.col("value") + 1)
    twice = points.where(F.col("timestamp") >= "2024-01-25").withColumn("value", F.col("value") + 2)
    return once.withColumn("seq", F.lit(1)).unionByName(twice.withColumn("seq", F.lit(2)))


@query("points_upsert", UPSERT_SQL)
def points_upsert(spark, sf):
    points = d.points(spark, sf).drop("event_id")
    target = points.where(F.col("timestamp") < "2024-01-20")
    return merge.upsert(target, arrivals(spark, sf), KEYS, ["seq"], ["seq"])


@query(
    "points_upsert_partial",
    f"""
WITH pts AS ({d.PTS}), t AS (SELECT * FROM pts WHERE "timestamp" < TIMESTAMP '2024-01-20'),
s AS (SELECT "externalId", "timestamp", value + 1 AS value FROM pts WHERE "timestamp" >= TIMESTAMP '2024-01-10')
SELECT coalesce(t."externalId", s."externalId") AS "externalId", coalesce(t."timestamp", s."timestamp") AS "timestamp",
  CASE WHEN s."externalId" IS NOT NULL THEN s.value ELSE t.value END AS value, t.event_id
FROM t FULL JOIN s ON s."externalId" = t."externalId" AND s."timestamp" = t."timestamp\"""",
)
def points_upsert_partial(spark, sf):
    """The source lacks a target column, which matched rows keep."""
    points = d.points(spark, sf)
    source = points.where(F.col("timestamp") >= "2024-01-10").select(
        *KEYS, (F.col("value") + 1).alias("value")
    )
    return merge.upsert(points.where(F.col("timestamp") < "2024-01-20"), source, KEYS)


@query(
    "points_export",
    f"""
WITH pts AS (SELECT 'user_' || user_id AS "externalId", ts AS "timestamp", value, event_type FROM events),
wm AS (SELECT "externalId", max("timestamp") AS since FROM pts
       WHERE event_type = 'error' AND "timestamp" < TIMESTAMP '2024-01-05' GROUP BY 1),
fresh AS (SELECT 'lake_' || pts."externalId" AS "externalId", "timestamp", value FROM pts
          LEFT JOIN wm ON wm."externalId" = pts."externalId" WHERE since IS NULL OR "timestamp" > since),
stored AS (SELECT 'lake_' || "externalId" AS "externalId", "timestamp", -1.0::DOUBLE AS value FROM pts
           WHERE event_type = 'error' AND "timestamp" < TIMESTAMP '2024-01-05')
SELECT * FROM stored t WHERE NOT EXISTS
  (SELECT 1 FROM fresh s WHERE s."externalId" = t."externalId" AND s."timestamp" = t."timestamp")
UNION ALL SELECT * FROM fresh""",
)
def points_export(spark, sf):
    points = d.points(spark, sf).drop("event_id")
    early = d.table(spark, sf, "events").where(
        (F.col("event_type") == "error") & (F.col("ts") < "2024-01-05")
    )
    sent = early.select(
        F.concat(F.lit("user_"), F.col("user_id")).alias("externalId"), F.col("ts").alias("timestamp")
    )
    states = watermark.series_watermark(sent, "Tables/RawTS")
    fresh = scan.series_since(points, watermark.series_bounds(states, "Tables/RawTS"))
    stored = ops.prefix_ids(sent.withColumn("value", F.lit(-1.0)), "lake_")
    return merge.upsert(stored, ops.prefix_ids(fresh, "lake_"), KEYS)


@query("points_prefix", f"""SELECT 'p_' || "externalId" AS "externalId", "timestamp", value FROM ({d.PTS})""")
def points_prefix(spark, sf):
    return ops.prefix_ids(d.points(spark, sf).drop("event_id"), "p_")


EVENT_TYPES = ("click", "error", "purchase", "signup", "view")


@query(
    "points_pivot",
    """SELECT date_trunc('hour', ts) AS "timestamp", """
    + ", ".join(f"max(CASE WHEN event_type = '{t}' THEN value END) AS {t}" for t in EVENT_TYPES)
    + " FROM events GROUP BY 1",
)
def points_pivot(spark, sf):
    """Every event type as a series of hourly points, side by side."""
    hourly = d.table(spark, sf, "events").select(
        F.col("event_type").alias("externalId"),
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("timestamp"),
        "value",
    )
    return ops.wide(hourly, EVENT_TYPES)


@query(
    "points_wide_sparse",
    """WITH p AS (SELECT date_trunc('hour', ts) AS "timestamp", 'user_' || user_id || '_' || event_type AS id, max(value) AS value
                  FROM events GROUP BY ALL)
       SELECT "timestamp", count(*) AS places, string_agg(id || '=' || value, ',' ORDER BY id) AS held,
         (SELECT count(DISTINCT id) FROM p) AS width FROM p GROUP BY 1""",
)
def points_wide_sparse(spark, sf):
    """Hourly points of every user and event type: a frame as wide as there are series, each row what it holds."""
    hourly = d.table(spark, sf, "events").select(
        F.concat(F.lit("user_"), "user_id", F.lit("_"), "event_type").alias("externalId"),
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("timestamp"), "value",
    )
    numbers = ops.dictionary(hourly)
    rows = ops.wide_sparse(hourly, numbers)
    width = numbers.agg((F.max("index") + 1).cast("long").alias("width"))
    back = rows.select("timestamp", F.inline(F.arrays_zip("indices", "values"))).join(numbers, F.col("indices") == F.col("index"))
    pair = F.struct("externalId", F.concat_ws("=", "externalId", F.col("values").cast("string")).alias("text"))
    held = F.array_join(F.sort_array(F.collect_list(pair)).getField("text"), ",").alias("held")
    named = back.groupBy("timestamp").agg(held)
    return rows.select("timestamp", F.size("indices").cast("long").alias("places")).join(named, "timestamp").withColumn("width", width.scalar())


@query(
    "series_metadata",
    """SELECT c_name AS "externalId", c_name AS name,
         CASE WHEN c_acctbal > 0 THEN c_mktsegment ELSE '' END AS description,
         c_mktsegment = 'MACHINERY' AS "isString", c_acctbal < 0 AS "isStep", c_mktsegment AS unit,
         CASE WHEN c_nationkey > 5 THEN 'segment=' || c_mktsegment ELSE 'source=tidemark' END AS metadata,
         CASE WHEN c_nationkey <> 3 THEN coalesce(n_name, '') ELSE '' END AS "assetExternalId"
       FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
       WHERE c_mktsegment <> 'BUILDING'""",
)
def series_metadata(spark, sf):
    rows = series_ops.series_rows(d.series(spark, sf), d.assets(spark, sf))
    pairs = F.transform(F.map_entries("metadata"), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return rows.withColumn("metadata", F.array_join(pairs, ";"))


@query(
    "series_unseen",
    """SELECT DISTINCT 'cust_' || o_custkey AS "externalId" FROM orders
       WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)""",
)
def series_unseen(spark, sf):
    feed = d.table(spark, sf, "orders").select(
        F.concat(F.lit("cust_"), F.col("o_custkey")).alias("externalId")
    )
    known = d.table(spark, sf, "customer").where("c_acctbal > 0").select(
        F.concat(F.lit("cust_"), F.col("c_custkey")).alias("externalId")
    )
    return series_ops.unseen_ids(feed, known)


@query(
    "series_missing_create",
    """SELECT DISTINCT 'user_' || user_id AS "externalId", 'user_' || user_id AS name,
         TRUE AS "isString", CAST(123456 AS BIGINT) AS "dataSetId" FROM events
       WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'AUTOMOBILE')""",
)
def series_missing_create(spark, sf):
    known = d.table(spark, sf, "customer").where("c_mktsegment = 'AUTOMOBILE'").select(
        F.concat(F.lit("user_"), F.col("c_custkey")).alias("externalId")
    )
    return series_ops.missing_series(d.points(spark, sf), known, 123456)
