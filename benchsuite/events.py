"""Events on both sides."""

from __future__ import annotations

from pyspark.sql import functions as F

from benchsuite import domain as d
from benchsuite.registry import query
from tidemark.operators import events as ops
from tidemark.operators import merge, scan


@query(
    "events_since",
    f"""SELECT * FROM ({d.EVT}) WHERE "createdTime" >= epoch_ms(TIMESTAMP '1998-01-01') + 1
        AND "dataSet" = '1-URGENT'""",
)
def events_since(spark, sf):
    return scan.events_since(d.events(spark, sf), 883612800000, "1-URGENT")


@query(
    "events_first_load",
    f"""SELECT * FROM ({d.EVT}) WHERE "createdTime" >= 1 AND "dataSet" = '2-HIGH'""",
)
def events_first_load(spark, sf):
    return scan.events_since(d.events(spark, sf), None, "2-HIGH")


@query(
    "events_json_metadata",
    """SELECT doc_id, '{"lang": ' || to_json(lang) || ', "source": ' || to_json(source) || ', "flag": ' ||
         CASE WHEN n_chars > 2000 THEN 'null' ELSE '"short"' END || '}' AS metadata FROM documents""",
)
def events_json_metadata(spark, sf):
    documents = d.table(spark, sf, "documents").select(
        "doc_id",
        F.create_map(
            F.lit("lang"),
            "lang",
            F.lit("source"),
            "source",
            F.lit("flag"),
            F.when(F.col("n_chars") <= 2000, "short"),
        ).alias("metadata"),
    )
    return ops.metadata_as_json(documents)


@query(
    "events_json_text",
    """SELECT doc_id, '{"text": ' || to_json(text) || '}' AS metadata FROM documents""",
)
def events_json_text(spark, sf):
    """Whole document texts as metadata values: quotes, line ends and non-ASCII letters."""
    documents = d.table(spark, sf, "documents").select(
        "doc_id", F.create_map(F.lit("text"), "text").alias("metadata")
    )
    return ops.metadata_as_json(documents)


@query(
    "events_optional_columns",
    f"""SELECT "externalId", "startTime", CAST(NULL AS BIGINT) AS "endTime", "type",
          CAST(NULL AS VARCHAR) AS subtype, CAST(NULL AS VARCHAR) AS description,
          CAST(123456 AS BIGINT) AS "dataSetId" FROM ({d.EVT})""",
)
def events_optional_columns(spark, sf):
    rows = ops.event_rows(d.events(spark, sf), 123456)
    return rows.drop("metadata", "assetExternalIds")


def _with_assets(spark, sf):
    """Each order refers to its customer's nation key in two ways, one of which may not exist."""
    customers = d.table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    orders = d.table(spark, sf, "orders").join(
        customers, F.col("o_custkey") == F.col("c_custkey"), "left"
    )
    ids = F.array(
        F.concat(F.lit("NATION_"), F.col("c_nationkey") + 10),
        F.concat(F.lit("NATION_"), F.col("c_nationkey")),
    )
    return orders.select(
        F.concat(F.lit("order_"), F.col("o_orderkey")).alias("externalId"),
        F.when(F.col("o_orderstatus") != "P", ids).alias("assetExternalIds"),
    )


ASSETS_SQL = """
WITH refs AS (
  SELECT 'order_' || o_orderkey AS "externalId", o_orderstatus,
    [ 'NATION_' || (c_nationkey + 10), 'NATION_' || c_nationkey ] AS ids
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey),
one AS (SELECT "externalId", o_orderstatus, unnest(ids) AS id, generate_subscripts(ids, 1) AS pos FROM refs)"""


@query(
    "events_resolve_assets",
    ASSETS_SQL
    + """SELECT "externalId", CASE WHEN any_value(o_orderstatus) <> 'P'
           THEN coalesce(string_agg(CAST(n_nationkey AS VARCHAR), ',' ORDER BY pos), '') END AS "assetIds"
         FROM one LEFT JOIN nation ON n_name = id GROUP BY "externalId\"""",
)
def events_resolve_assets(spark, sf):
    rows = ops.resolve_assets(_with_assets(spark, sf), d.assets(spark, sf))
    return rows.withColumn("assetIds", F.array_join(F.col("assetIds").cast("array<string>"), ","))


@query(
    "events_unknown_assets",
    ASSETS_SQL
    + """SELECT DISTINCT id AS "externalId" FROM one WHERE o_orderstatus <> 'P' AND id IS NOT NULL
         AND id NOT IN (SELECT n_name FROM nation)""",
)
def events_unknown_assets(spark, sf):
    return ops.unknown_assets(_with_assets(spark, sf), d.assets(spark, sf))


APPEND_SQL = f"""
SELECT "externalId", "createdTime", "type", NULL AS priority FROM ({d.EVT}) WHERE "createdTime" < 900000000000
UNION ALL
SELECT "externalId", "createdTime", NULL, "dataSet" FROM ({d.EVT}) WHERE "createdTime" >= 900000000000"""


def event_generations(spark, sf):
    """The same feed before and after a column was replaced by another."""
    events = d.events(spark, sf)
    old = events.where(F.col("createdTime") < 900000000000).select("externalId", "createdTime", "type")
    new = events.where(F.col("createdTime") >= 900000000000).select(
        "externalId", "createdTime", F.col("dataSet").alias("priority")
    )
    return old, new


@query("events_append_evolve", APPEND_SQL)
def events_append_evolve(spark, sf):
    return merge.append_evolving(*event_generations(spark, sf))


@query(
    "events_upsert",
    f"""WITH e AS ({d.EVT}),
        s AS (SELECT "externalId", "createdTime", "startTime" + 1 AS "startTime", "dataSet", 'updated' AS "type"
              FROM e WHERE "createdTime" >= 880000000000)
        SELECT * FROM e WHERE "createdTime" < 920000000000
          AND "externalId" NOT IN (SELECT "externalId" FROM s)
        UNION ALL SELECT * FROM s""",
)
def events_upsert(spark, sf):
    events = d.events(spark, sf)
    source = events.where(F.col("createdTime") >= 880000000000).select(
        "externalId",
        "createdTime",
        (F.col("startTime") + 1).alias("startTime"),
        "dataSet",
        F.lit("updated").alias("type"),
    )
    return merge.upsert(events.where(F.col("createdTime") < 920000000000), source, ["externalId"])
