"""The jobs end to end: state, sink and log together, run twice over a growing source."""

from __future__ import annotations

from contextlib import suppress
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from benchsuite import domain as d
from benchsuite.events import _with_assets
from benchsuite.raw import RAW_LAST
from benchsuite.registry import query
from tidemark.operators.instances import views_of
from tidemark.plans.audit import counters
from tidemark.plans.config import OUT_POINTS, POINTS, Destination, EventFeed, RawExport, RawFeed, Space, Subscription
from tidemark.plans.jobs import Jobs
from tidemark.session import shared_folder


@query(
    "job_replicate_points",
    """WITH f AS (SELECT 'user_' || user_id AS "externalId", date_trunc('millisecond', ts) AS "timestamp", value,
             event_id // 1000 AS "cursor" FROM events)
       SELECT "externalId", "timestamp", value FROM f QUALIFY row_number() OVER
         (PARTITION BY "externalId", "timestamp" ORDER BY "cursor" DESC, value DESC) = 1""",
)
def job_replicate_points(spark, sf):
    home = shared_folder(spark, "job-points")
    d.feed(spark, sf).write.parquet(f"{home}/feed")
    sub = Subscription("charts", f"{home}/feed", f"{home}/points", f"{home}/series")
    job = Jobs(spark, f"{home}/state")
    job.replicate_points([sub], d.series(spark, sf), d.assets(spark, sf))
    rows = job.table(sub.points_table).read()
    return rows.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


@query(
    "job_replicate_events",
    f"""SELECT "externalId", "createdTime", "startTime", "dataSet", "type", '{{"priority": "' || "dataSet" || '"}}' AS metadata
        FROM ({d.EVT}) WHERE "dataSet" = '1-URGENT'""",
)
def job_replicate_events(spark, sf):
    """Two runs: the second finds what was created after the first."""
    home = shared_folder(spark, "job-events")
    job, feed = Jobs(spark, f"{home}/state"), EventFeed(f"{home}/events", "1-URGENT")
    events = d.events(spark, sf).withColumn(
        "metadata", F.create_map(F.lit("priority"), F.col("dataSet"))
    )
    job.replicate_events(events.where(F.col("createdTime") < 900000000000), feed)
    job.replicate_events(events, feed)
    return job.table(feed.table).read()


@query("job_replicate_raw", f"SELECT * FROM ({d.RAW}) {RAW_LAST}")
def job_replicate_raw(spark, sf):
    home = shared_folder(spark, "job-raw")
    job, feed = Jobs(spark, f"{home}/state"), RawFeed("db", "lines", f"{home}/lines")
    rows = d.raw_rows(spark, sf)
    job.replicate_raw(rows.where(F.col("last_updated_time") < 900000000000), feed)
    job.replicate_raw(rows, feed)
    return job.table(feed.table).read()


@query("job_replicate_instances", d.TABLES_SQL)
def job_replicate_instances(spark, sf):
    """First run up to a point in time, the second takes the rest of the changes."""
    home = shared_folder(spark, "job-instances")
    job = Jobs(spark, f"{home}/state")
    space = Space(d.SPACE, d.VIEWS, f"{home}/tables")
    d.instances(spark, sf).write.parquet(f"{home}/feed")
    changes = spark.read.parquet(f"{home}/feed")
    job.replicate_instances(space, changes, run_start=950000000000)
    job.replicate_instances(space, changes)
    tables = {path.rsplit("/", 1)[1]: job.table(path) for path in job.space_tables(space)}
    return d.rows_per_table(tables)


@query(
    "job_export_points",
    f"""SELECT 'lake_' || "externalId" AS "externalId", "timestamp", value FROM ({d.PTS})""",
)
def job_export_points(spark, sf):
    home = shared_folder(spark, "job-export-points")
    job, to = Jobs(spark, f"{home}/state"), Destination(f"{home}/out", "lake_", 123456)
    points = d.points(spark, sf).drop("event_id")
    job.export_points(points.where(F.col("timestamp") < "2024-01-15"), "Tables/RawTS", to)
    job.export_points(points, "Tables/RawTS", to)
    return job.table(f"{to.tables}/points").read()


@query(
    "job_export_new_batches",
    f"""SELECT 'lake_' || "externalId" AS "externalId", "timestamp", value FROM ({d.PTS})""",
)
def job_export_new_batches(spark, sf):
    """Points of a table that grows by a batch between runs; each run reads the batches it has not seen.

    Later batches hold newer points, and series that no earlier one has.
    """
    home = shared_folder(spark, "job-export-batches")
    job, to = Jobs(spark, f"{home}/state"), Destination(f"{home}/out", "lake_", 123456)
    table, points = job.table(f"{home}/points", POINTS), d.points(spark, sf).drop("event_id")
    late = F.crc32(F.col("externalId").cast("binary")) % 10 == 0  # stand-in: a tenth of the series arrives last, whole
    for k, days in enumerate((("2024-01-01", "2024-01-12"), ("2024-01-12", "2024-02-10"))):
        table.add(points.where(~late & (F.col("timestamp") >= days[0]) & (F.col("timestamp") < days[1])), ("feed", k))
        job.export_points(table, "Tables/RawTS", to)
    table.add(points.where(late), ("feed", 2))
    job.export_points(table, "Tables/RawTS", to)
    return job.destination(f"{to.tables}/points").read()


@query(
    "destination_after_failures",
    f"""SELECT 'lake_' || "externalId" AS "externalId", "timestamp", value, 0::BIGINT AS read_meanwhile FROM ({d.PTS})""",
)
def destination_after_failures(spark, sf):
    """An export whose tasks fail on the last day's rows: nothing of it is seen, and the next run takes it all."""
    home = shared_folder(spark, "destination-failures")
    job, to = Jobs(spark, f"{home}/state"), Destination(f"{home}/out", "lake_", 123456)
    points = d.points(spark, sf).drop("event_id")
    out = job.destination(f"{to.tables}/points", OUT_POINTS)
    last = points.agg(F.max("timestamp")).first()[0]
    broken = F.when(F.col("timestamp") == F.lit(last), F.raise_error(F.lit("lost"))).otherwise(F.col("value"))
    with suppress(Exception):
        job.export_points(points.withColumn("value", broken.cast("double")), "Tables/RawTS", to)
    meanwhile = out.read().count()
    job.export_points(points, "Tables/RawTS", to)
    return out.read().withColumn("read_meanwhile", F.lit(meanwhile).cast("long"))


@query(
    "job_export_events",
    """SELECT 'order_' || o_orderkey AS "externalId", epoch_ms(o_orderdate) AS "startTime",
         CASE WHEN o_orderstatus = 'P' THEN NULL ELSE concat_ws(',', CAST(hi.n_nationkey AS VARCHAR), CAST(lo.n_nationkey AS VARCHAR)) END AS "assetIds",
         CAST(123456 AS BIGINT) AS "dataSetId"
       FROM orders LEFT JOIN customer ON o_custkey = c_custkey
         LEFT JOIN nation hi ON hi.n_nationkey = c_nationkey + 10 LEFT JOIN nation lo ON lo.n_nationkey = c_nationkey""",
)
def job_export_events(spark, sf):
    home = shared_folder(spark, "job-export-events")
    job, to = Jobs(spark, f"{home}/state"), Destination(f"{home}/out", data_set_id=123456)
    starts = d.events(spark, sf).select("externalId", "startTime")
    events = starts.join(_with_assets(spark, sf), "externalId")
    job.export_events(
        events.where(F.col("startTime") < 900000000000), "Tables/Events", to, d.assets(spark, sf), "startTime"
    )
    job.export_events(events, "Tables/Events", to, d.assets(spark, sf), "startTime")
    rows = job.table(f"{to.tables}/events").read()
    ids = F.array_join(F.col("assetIds").cast("array<string>"), ",")
    return rows.select("externalId", "startTime", ids.alias("assetIds"), "dataSetId")


@query(
    "job_export_raw",
    """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, event_type, value,
         md5(CAST(event_id AS VARCHAR)) AS row_key FROM events""",
)
def job_export_raw(spark, sf):
    home = shared_folder(spark, "job-export-raw")
    job, to = Jobs(spark, f"{home}/state"), Destination(f"{home}/out")
    spec = RawExport("db", "events", ("event_id",), "ts", md5_key=True)
    events = d.table(spark, sf, "events").drop("user_id", "props")
    job.export_raw(events.where(F.col("ts") < "2024-01-15"), spec, to)
    job.export_raw(events, spec, to)
    return job.table(f"{to.tables}/db/events").read()


@query("job_export_files", d.LISTING)
def job_export_files(spark, sf):
    """Two runs over a growing, changing listing: the second takes what is new or has another time."""
    home = shared_folder(spark, "job-files")
    job, to = Jobs(spark, f"{home}/state"), Destination(f"{home}/out", data_set_id=123456)
    files = d.listing(spark, sf)
    some = F.col("length") % 3
    before = files.where(some > 0).withColumn(
        "modificationTime", F.col("modificationTime") - F.when(some > 1, F.expr("INTERVAL 1 HOUR")).otherwise(F.expr("INTERVAL 0 HOUR"))
    )
    job.export_files(before, "pages", to)
    job.export_files(files, "pages", to)
    return job.table(f"{to.tables}/files").read().withColumn("content", F.md5("content"))


@query(
    "job_replicate_subscriptions",
    """SELECT 'sub_' || (user_id % 4) AS "subscription", 'user_' || user_id AS "externalId", ts AS "timestamp", value
       FROM (SELECT user_id, date_trunc('millisecond', ts) AS ts, value, event_id // 1000 AS "cursor" FROM events)
       QUALIFY row_number() OVER (PARTITION BY user_id, ts ORDER BY "cursor" DESC, value DESC) = 1""",
)
def job_replicate_subscriptions(spark, sf):
    """Four feeds followed at once, each into tables of its own, all logging to one run log."""
    home = shared_folder(spark, "job-subscriptions")
    feed = d.feed(spark, sf).withColumn("part", F.substr("external_id", F.lit(6)).cast("long") % 4)
    subs = []
    for k in range(4):
        feed.where(F.col("part") == k).drop("part").write.parquet(f"{home}/feed{k}")
        subs.append(Subscription(f"sub_{k}", f"{home}/feed{k}", f"{home}/points{k}", f"{home}/series{k}"))
    job = Jobs(spark, f"{home}/state")
    job.replicate_points(subs, d.series(spark, sf), d.assets(spark, sf))
    parts = [
        job.table(s.points_table).read().select(
            F.lit(s.external_id).alias("subscription"), "externalId", F.col("timestamp").cast("timestamp_ntz").alias("timestamp"), "value"
        )
        for s in subs
    ]
    return reduce(DataFrame.unionByName, parts)


def _logged(spark, sf):
    """The log of two event runs, one of RAW rows and a failing export."""
    home = shared_folder(spark, "job-log")
    job, feed = Jobs(spark, f"{home}/state"), EventFeed(f"{home}/events", "1-URGENT")
    events = d.events(spark, sf)
    job.replicate_events(events.where(F.col("createdTime") < 900000000000), feed)
    job.replicate_events(events, feed)
    job.replicate_events(events, feed)
    job.replicate_raw(d.raw_rows(spark, sf), RawFeed("db", "lines", f"{home}/lines"))
    with suppress(Exception):
        job.export_raw(events, RawExport("db", "orders", ("no such column",)), Destination(f"{home}/out"))
    return job.log.read()


RUNS_SQL = f"""SELECT 'event_state' AS pipeline, 'success' AS status, count(*) AS "rows" FROM ({d.EVT})
    WHERE "dataSet" = '1-URGENT' AND "createdTime" < 900000000000
  UNION ALL SELECT 'event_state', 'success', count(*) FROM ({d.EVT}) WHERE "dataSet" = '1-URGENT' AND "createdTime" >= 900000000000
  UNION ALL SELECT 'event_state', 'seen', NULL
  UNION ALL SELECT 'db_lines_raw_state', 'success', count(*) FROM lineitem
  UNION ALL SELECT 'raw/db/orders', 'failure', NULL"""


@query("run_log", RUNS_SQL)
def run_log(spark, sf):
    return _logged(spark, sf).select("pipeline", "status", "rows")


@query(
    "run_counters",
    f"""SELECT pipeline, count(*) FILTER (WHERE status = 'success') AS writes, count(*) FILTER (WHERE status = 'failure') AS failures,
         CAST(coalesce(sum("rows") FILTER (WHERE status = 'success'), 0) AS BIGINT) AS "rows" FROM ({RUNS_SQL}) GROUP BY 1""",
)
def run_counters(spark, sf):
    return counters(_logged(spark, sf))


@query(
    "instances_views",
    """SELECT p_brand AS "externalId", 'plant_' || p_brand AS "table", count(DISTINCT p_type) AS properties
       FROM part GROUP BY p_brand""",
)
def instances_views(spark, sf):
    """A view of every brand, its properties the types of its parts, listed from a catalog table."""
    catalog = d.table(spark, sf, "part").groupBy(F.col("p_brand").alias("externalId")).agg(
        F.map_from_entries(F.collect_set(F.struct(F.col("p_type").alias("k"), F.lit("text").alias("v")))).alias("properties")
    )
    catalog = catalog.withColumns({"space": F.lit(d.SPACE), "version": F.lit("1"), "usedFor": F.lit("node")})
    views = [(v.external_id, v.table, len(v.properties)) for v in views_of(catalog, d.SPACE)]
    return spark.createDataFrame(views, "externalId string, table string, properties long")
