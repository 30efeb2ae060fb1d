"""Scans, batches, key listings, files."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from benchsuite import domain as d
from benchsuite.registry import query
from tidemark.functions import text
from tidemark.operators import files, scan, watermark
from tidemark.session import shared_folder


@query("scan_full", "SELECT * FROM events")
def scan_full(spark, sf):
    return scan.since(d.table(spark, sf, "events"), "ts")


@query("scan_incremental", "SELECT * FROM events WHERE ts > TIMESTAMP '2024-01-15 06:30:00.5'")
def scan_incremental(spark, sf):
    return scan.since(d.table(spark, sf, "events"), "ts", "2024-01-15 06:30:00.500000+0000")


@query(
    "scan_bounded",
    "SELECT * FROM events WHERE ts > TIMESTAMP '2024-01-10' AND ts <= TIMESTAMP '2024-01-20'",
)
def scan_bounded(spark, sf):
    return scan.since(d.table(spark, sf, "events"), "ts", "2024-01-10", up_to="2024-01-20")


@query("scan_counter", "SELECT * FROM events WHERE event_id > 4321")
def scan_counter(spark, sf):
    return scan.since(d.table(spark, sf, "events"), "event_id", "4321")


@query("scan_in_order", "SELECT * FROM events WHERE ts > TIMESTAMP '2024-01-15' ORDER BY ts, event_id")
def scan_in_order(spark, sf):
    return scan.in_order(
        scan.since(d.table(spark, sf, "events"), "ts", "2024-01-15"), "ts", "event_id"
    )


@query(
    "scan_first_batch",
    """SELECT * EXCLUDE (rnk) FROM (SELECT *, rank() OVER (ORDER BY ts) AS rnk FROM events)
       WHERE rnk <= 1000""",
)
def scan_first_batch(spark, sf):
    return scan.next_batch(d.table(spark, sf, "events"), "ts", 1000)


@query("scan_all_batches", "SELECT *, true AS in_order FROM events")
def scan_all_batches(spark, sf):
    """Every batch of 700 rows stored as its number; what is read back came in the order of time."""
    home, events = shared_folder(spark, "scan-batches"), d.table(spark, sf, "events")
    numbered = scan.in_batches(events, "ts", 700).numbered("batch")
    numbered.repartition("batch").write.partitionBy("batch").parquet(home)
    rows = spark.read.parquet(home)
    ends = rows.groupBy("batch").agg(F.min("ts").alias("low"), F.max("ts").alias("high"), F.count(F.lit(1)).alias("n"))
    before = F.lag("high").over(Window.orderBy("batch"))  # a row for each batch
    ends = ends.select("batch", (F.coalesce(before < F.col("low"), F.lit(True)) & F.col("n").between(300, 1400)).alias("in_order"))
    ends = ends.withColumn("in_order", F.col("in_order") | (F.col("batch") == F.max("batch").over(Window.partitionBy())))
    return rows.join(ends, "batch").drop("batch")


SERIES_STATE = """
  SELECT externalId, max("timestamp") AS since FROM pts WHERE event_type = 'error'
    AND "timestamp" < TIMESTAMP '2024-01-05' GROUP BY 1"""


@query(
    "scan_series_since",
    f"""WITH pts AS (SELECT 'user_' || user_id AS externalId, ts AS "timestamp", value, event_type FROM events),
       wm AS ({SERIES_STATE})
       SELECT pts.externalId AS "externalId", "timestamp", value FROM pts LEFT JOIN wm USING (externalId)
       WHERE since IS NULL OR "timestamp" > since""",
)
def scan_series_since(spark, sf):
    events = d.table(spark, sf, "events")
    points = d.points(spark, sf).drop("event_id")
    written = events.where((F.col("event_type") == "error") & (F.col("ts") < "2024-01-05")).select(
        F.concat(F.lit("user_"), F.col("user_id")).alias("externalId"), F.col("ts").alias("timestamp")
    )
    states = watermark.series_watermark(written, "Tables/RawTS")
    return scan.series_since(points, watermark.series_bounds(states, "Tables/RawTS"))


@query("distinct_series_ids", "SELECT DISTINCT 'user_' || user_id AS \"externalId\" FROM events")
def distinct_series_ids(spark, sf):
    return scan.distinct_ids(d.points(spark, sf))


@query(
    "subscription_members",
    """SELECT c_name AS "externalId",
         CAST(CAST('0x' || substr(md5(c_name), 1, 8) AS BIGINT) % 8 AS INTEGER) AS "partition"
       FROM customer WHERE c_name IS NOT NULL""",
)
def subscription_members(spark, sf):
    return scan.subscription_members(d.series(spark, sf), 8)


@query("file_catalog", d.LISTING)
def file_catalog(spark, sf):
    return files.catalog_rows(d.listing(spark, sf), 123456).withColumn("content", F.md5("content"))


@query(
    "file_changed",
    """WITH state AS (SELECT url, max(page_id) + CASE WHEN url LIKE '%utm_source%' THEN 1 ELSE 0 END AS stored
         FROM pages WHERE url LIKE 'https%' GROUP BY url)
       SELECT p.url AS external_id, p.page_id AS source_modified_time
       FROM pages p LEFT JOIN state s ON p.url = s.url WHERE p.page_id IS DISTINCT FROM s.stored""",
)
def file_changed(spark, sf):
    catalog = d.page_files(spark, sf)
    altered = F.when(F.col("external_id").contains("utm_source"), 1).otherwise(0)
    state = (
        catalog.where(F.col("external_id").startswith("https"))
        .groupBy("external_id")
        .agg(F.max("source_modified_time").alias("seen"))
        .select("external_id", (F.col("seen") + altered).alias("stored_time"))
    )
    return files.changed_files(catalog, state)


@query(
    "url_parts",
    r"""WITH u AS (SELECT page_id, regexp_replace(url, '^https?://', 'abfss://pages@') AS storage, url FROM pages)
       SELECT page_id, 'pages' AS container,
         split_part(regexp_extract(storage, '^[a-z]+://pages@([^/?#]*)', 1), '.', 1) AS account,
         regexp_extract(storage, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path,
         regexp_extract(url, '([^/]*)$', 1) AS name FROM u""",
)
def url_parts(spark, sf):
    storage = F.regexp_replace("url", "^https?://", "abfss://pages@")
    return d.table(spark, sf, "pages").select(
        "page_id",
        text.storage_url_parts(storage).alias("u"),
        text.base_name("url").alias("name"),
    ).select("page_id", "u.container", "u.account", "u.path", "name")
