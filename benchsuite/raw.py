"""RAW rows in both directions."""

from __future__ import annotations

from pyspark.sql import functions as F

from benchsuite import domain as d
from benchsuite.registry import query
from tidemark.functions import text, values
from tidemark.operators import merge, scan
from tidemark.operators import raw as ops
from tidemark.plans.config import RAW_ROWS
from tidemark.session import shared_folder
from tidemark.sources.bucketed import BucketedTable


@query(
    "raw_since",
    f"""SELECT * EXCLUDE (rnk) FROM (SELECT *, rank() OVER (ORDER BY last_updated_time) AS rnk
        FROM ({d.RAW}) WHERE last_updated_time > 900000000000) WHERE rnk <= 5000""",
)
def raw_since(spark, sf):
    batch = scan.next_batch(d.raw_rows(spark, sf), "last_updated_time", 5000, 900000000000)
    return ops.flatten_rows(batch)


@query("raw_flatten", d.RAW)
def raw_flatten(spark, sf):
    return ops.flatten_rows(d.raw_rows(spark, sf))


@query(
    "raw_flatten_map",
    """SELECT CAST(event_id AS VARCHAR) AS "key", epoch_us(ts) // 1000 AS last_updated_time,
         CASE WHEN event_type = 'click' THEN props END AS click, CASE WHEN event_type = 'error' THEN props END AS error,
         CASE WHEN event_type = 'view' THEN props END AS "view",
         CASE WHEN event_type IN ('purchase', 'signup') THEN event_type || '=' || props END AS other_columns FROM events""",
)
def raw_flatten_map(spark, sf):
    """Free-form maps: declared names become columns, the others stay in a map."""
    rows = d.table(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("key"),
        F.create_map("event_type", "props").alias("columns"),
        d.ms("ts").alias("last_updated_time"),
    )
    flat = ops.flatten_rows(rows, ["click", "error", "view"])
    other = F.transform(F.map_entries(ops.OTHER), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return flat.withColumn(ops.OTHER, F.array_join(other, ";"))


@query(
    "raw_flatten_json",
    """SELECT CAST(event_id AS VARCHAR) AS "key", epoch_us(ts) // 1000 AS last_updated_time, CAST(props->>'$.k' AS BIGINT) AS k,
         CASE WHEN event_type = 'click' THEN value END AS click, CASE WHEN event_type = 'error' THEN value END AS error,
         CASE WHEN event_type = 'view' THEN value END AS "view", CASE WHEN event_type = 'purchase' THEN value END AS purchase,
         CASE WHEN event_type = 'signup' THEN value END AS signup, event_id % 2 = 0 AS "even 'id'",
         '{"type":"' || event_type || '"}' AS nested FROM events""",
)
def raw_flatten_json(spark, sf):
    """Free-form JSON rows, each with a name of its type: names and types are found, none is given."""
    more = F.to_json(F.struct((F.col("event_id") % 2 == 0).alias("even 'id'"), F.struct(F.col("event_type").alias("type")).alias("nested")))
    value = F.concat(F.lit('"'), "event_type", F.lit('": '), F.col("value").cast("string"), F.lit(", "))
    rows = d.table(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("key"), d.ms("ts").alias("last_updated_time"),
        F.concat(F.lit("{"), value, F.expr("substr(props, 2, length(props) - 2)"), F.lit(", "), F.substr(more, F.lit(2))).alias("columns"),
    )
    return ops.flatten_json(rows)


@query(
    "raw_md5_key",
    """SELECT *, md5(concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_partkey AS VARCHAR),
         CAST(l_suppkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), CAST(l_quantity AS VARCHAR),
         CAST(l_extendedprice AS VARCHAR), CAST(l_discount AS VARCHAR), CAST(l_tax AS VARCHAR),
         l_returnflag, l_linestatus, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S.%f'))) AS md5_key
       FROM lineitem""",
)
def raw_md5_key(spark, sf):
    rows = d.table(spark, sf, "lineitem")
    return rows.withColumn("md5_key", text.md5_key(rows))


@query(
    "raw_md5_key_numbers",
    """SELECT o_orderkey, CAST(o_totalprice * 1000 AS VARCHAR) AS big, CAST(o_totalprice / 1e10 AS VARCHAR) AS small,
         CAST(o_totalprice * 1e15 AS VARCHAR) AS huge,
         md5(concat_ws('-', CAST(o_totalprice * 1000 AS VARCHAR),
           coalesce(CASE WHEN o_orderstatus = 'P' THEN NULL WHEN o_orderstatus = 'F' THEN 'True' ELSE 'False' END,
                    'None'))) AS md5_key
       FROM orders""",
)
def raw_md5_key_numbers(spark, sf):
    """Doubles, booleans and nulls in the form existing row keys were hashed from."""
    price = F.col("o_totalprice")
    orders = d.table(spark, sf, "orders").select(
        "o_orderkey",
        (price * 1000).alias("big"),
        (price / 1e10).alias("small"),
        (price * 1e15).alias("huge"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus") == "F").alias("final"),
    )
    return orders.select(
        "o_orderkey",
        *[text.number_text(F.col(c)).alias(c) for c in ("big", "small", "huge")],
        text.md5_key(orders, ["big", "final"]).alias("md5_key"),
    )


RAW_LAST = """QUALIFY row_number() OVER (PARTITION BY "key"
  ORDER BY last_updated_time DESC, part DESC, flag DESC, quantity DESC) = 1"""


@query(
    "raw_upsert",
    f"""WITH r AS ({d.RAW}),
        t AS (SELECT * FROM r WHERE last_updated_time < 930000000000 {RAW_LAST}),
        s AS (SELECT * FROM r WHERE last_updated_time >= 880000000000 {RAW_LAST})
        SELECT * FROM t WHERE "key" NOT IN (SELECT "key" FROM s) UNION ALL SELECT * FROM s""",
)
def raw_upsert(spark, sf):
    rows = ops.flatten_rows(d.raw_rows(spark, sf))
    order = ["last_updated_time", "part", "flag", "quantity"]
    target = merge.dedupe_last(rows.where(F.col("last_updated_time") < 930000000000), ["key"], order)
    source = rows.where(F.col("last_updated_time") >= 880000000000)
    return merge.upsert(target, source, ["key"], order)


@query(
    "raw_export",
    """SELECT l_orderkey, l_linenumber, l_returnflag,
         strftime(l_shipdate, '%Y-%m-%d %H:%M:%S.%f') AS l_shipdate,
         CASE WHEN l_discount > 0 THEN l_tax END AS tax,
         '["' || l_returnflag || '","' || l_linestatus || '"]' AS flags,
         l_orderkey || '-' || l_linenumber AS row_key FROM lineitem""",
)
def raw_export(spark, sf):
    rows = d.table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_returnflag",
        "l_shipdate",
        F.when(F.col("l_discount") > 0, F.col("l_tax")).otherwise(float("nan")).alias("tax"),
        F.array("l_returnflag", "l_linestatus").alias("flags"),
    )
    return ops.export_rows(rows, ["l_orderkey", "l_linenumber"])


@query(
    "raw_export_md5",
    """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, event_type, value,
         md5(event_id || '-' || strftime(ts, '%Y-%m-%d %H:%M:%S.%f') || '-' || event_type || '-' ||
             CAST(value AS VARCHAR)) AS row_key FROM events""",
)
def raw_export_md5(spark, sf):
    return ops.export_rows(
        d.table(spark, sf, "events").select("event_id", "ts", "event_type", "value"), md5=True
    )


@query(
    "dates_to_strings",
    """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS local,
         strftime(ts, '%Y-%m-%d %H:%M:%S.%f') || '+0000' AS instant, strftime(ts, '%Y-%m-%d') AS day
       FROM events""",
)
def dates_to_strings(spark, sf):
    return values.dates_to_strings(
        d.table(spark, sf, "events").select(
            "event_id",
            F.col("ts").alias("local"),
            F.col("ts").cast("timestamp").alias("instant"),
            F.to_date("ts").alias("day"),
        )
    )


@query(
    "nan_to_null",
    "SELECT l_orderkey, l_linenumber, CASE WHEN l_discount > 0 THEN l_tax END AS tax FROM lineitem",
)
def nan_to_null(spark, sf):
    tax = F.when(F.col("l_discount") > 0, F.col("l_tax")).otherwise(float("nan"))
    return values.nan_to_null(
        d.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", tax.alias("tax"))
    )


@query("raw_upsert_bucketed", f"SELECT * FROM ({d.RAW}) {RAW_LAST}")
def raw_upsert_bucketed(spark, sf):
    """Three batches of RAW rows, one of them written twice, in buckets of their key."""
    home, rows = shared_folder(spark, "raw-bucketed"), ops.flatten_rows(d.raw_rows(spark, sf))
    name = f"bucketed_{home.rsplit('-', 1)[1]}"
    table = BucketedTable(spark, name, f"{home}/rows", rows.schema, RAW_ROWS, buckets=8)
    third = F.pmod(F.xxhash64("key", "last_updated_time"), F.lit(3))
    for k in (0, 1, 1, 2):
        table.add(rows.where(third == k), ("rows", k))
    return table.read()
