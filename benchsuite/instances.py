"""Nodes and edges of the property graph."""

from __future__ import annotations

from pyspark.sql import functions as F

from benchsuite import domain as d
from benchsuite.registry import query
from tidemark.operators import instances as ops
from tidemark.operators import merge

BASE_SQL = 'space, \'{kind}\' AS "instanceType", "externalId", version, "lastUpdatedTime", "createdTime"'
NODE_SQL = BASE_SQL.format(kind="node")
EDGE_SQL = BASE_SQL.format(kind="edge")
PART_SQL = f'SELECT {NODE_SQL}, name, brand, size FROM ({d.NODES}) WHERE view = \'Part\''


@query("instances_flatten_nodes", PART_SQL.replace(" FROM (", ', "deletedTime" FROM ('))
def instances_flatten_nodes(spark, sf):
    return ops.flatten_nodes(d.nodes(spark, sf), d.PART)


@query(
    "instances_flatten_edges",
    f"""SELECT {EDGE_SQL}, 'plant' AS start_space, start_id, 'plant' AS end_space, end_id, quantity,
          "deletedTime" FROM ({d.EDGES})""",
)
def instances_flatten_edges(spark, sf):
    flat = ops.flatten_edges(d.edges(spark, sf), [d.SUPPLIES])
    return flat.select(
        *[c for c in flat.columns if c not in ops.ENDPOINTS],
        F.col("startNode.space").alias("start_space"),
        F.col("startNode.externalId").alias("start_id"),
        F.col("endNode.space").alias("end_space"),
        F.col("endNode.externalId").alias("end_id"),
    )


@query(
    "instances_split",
    f"""SELECT "externalId", "deletedTime" IS NULL AS live, coalesce("deletedTime", -1) AS deleted
        FROM ({d.NODES}) WHERE view = 'Supplier'""",
)
def instances_split(spark, sf):
    live, deleted = ops.split_deleted(ops.flatten_nodes(d.nodes(spark, sf), d.SUPPLIER))
    return live.select(
        "externalId", F.lit(True).alias("live"), F.lit(-1).cast("long").alias("deleted")
    ).unionByName(
        deleted.select("externalId", F.lit(False).alias("live"), F.col("deletedTime").alias("deleted"))
    )


@query(
    "instances_route_counts",
    f"""WITH n AS ({d.NODES}), routed AS (
          SELECT 'plant_' || view AS table_name, "deletedTime" FROM n
          UNION ALL SELECT 'plant_Premium', "deletedTime" FROM n WHERE price IS NOT NULL
          UNION ALL SELECT 'plant_edges', "deletedTime" FROM ({d.EDGES}))
        SELECT table_name, count(*) FILTER (WHERE "deletedTime" IS NULL) AS upserts,
          count(*) FILTER (WHERE "deletedTime" IS NOT NULL) AS deletes FROM routed GROUP BY 1""",
)
def instances_route_counts(spark, sf):
    return ops.route_counts(d.instances(spark, sf), d.VIEWS)


@query(
    "instances_delete",
    f"""WITH e AS ({d.EDGES}) SELECT "externalId", start_id, end_id FROM e
        WHERE "externalId" NOT IN (SELECT "externalId" FROM e WHERE "deletedTime" IS NOT NULL)""",
)
def instances_delete(spark, sf):
    flat = ops.flatten_edges(d.edges(spark, sf))
    _, deleted = ops.split_deleted(flat)
    return merge.delete_by_key(flat, deleted).select(
        "externalId",
        F.col("startNode.externalId").alias("start_id"),
        F.col("endNode.externalId").alias("end_id"),
    )


HISTORY_SQL = f"""WITH p AS ({PART_SQL}) SELECT * FROM p
  UNION ALL SELECT space, "instanceType", "externalId", 2, "lastUpdatedTime" + 500, "createdTime", name, 'New ' || brand, size
  FROM p WHERE size > 25"""


def _second_versions(rows):
    """Newer versions of the larger parts, as the feed reports them."""
    part = F.col("properties.Part")
    changed = part.withField("brand", F.concat(F.lit("New "), F.col("properties.Part.brand")))
    return rows.where(F.col("properties.Part.size") > 25).select(
        *[c for c in rows.columns if c not in ("version", "lastUpdatedTime", "properties")],
        F.lit(2).alias("version"),
        (F.col("lastUpdatedTime") + 500).alias("lastUpdatedTime"),
        F.col("properties").withField("Part", changed).alias("properties"),
    )


@query("instances_history_append", HISTORY_SQL)
def instances_history_append(spark, sf):
    nodes = d.nodes(spark, sf)
    table = ops.flatten_nodes(nodes, d.PART).drop("deletedTime")
    newer = ops.flatten_nodes(_second_versions(nodes), d.PART).drop("deletedTime")
    return merge.append_evolving(table, newer)


@query(
    "instances_apply_batch",
    f"""WITH h AS ({HISTORY_SQL}) SELECT * FROM h WHERE "externalId" NOT IN
        (SELECT "externalId" FROM ({d.NODES}) WHERE view = 'Part' AND size > 25 AND "deletedTime" IS NOT NULL)""",
)
def instances_apply_batch(spark, sf):
    nodes = d.nodes(spark, sf)
    table = ops.flatten_nodes(nodes, d.PART).drop("deletedTime")
    return ops.apply_batch(table, ops.flatten_nodes(_second_versions(nodes), d.PART))


@query(
    "instances_changes",
    f"""SELECT "externalId", "lastUpdatedTime" FROM ({d.EDGES})
        WHERE "lastUpdatedTime" > 920000000000 AND "lastUpdatedTime" <= 980000000000""",
)
def instances_changes(spark, sf):
    return ops.changes_since(d.edges(spark, sf), 920000000000, 980000000000).select(
        "externalId", "lastUpdatedTime"
    )


@query(
    "instances_bootstrap",
    f"""WITH e AS ({d.EDGES}), s AS (SELECT * FROM e WHERE "createdTime" < 950000000000 AND "lastUpdatedTime" < 950000000000)
        SELECT "externalId", "lastUpdatedTime" FROM s
        UNION ALL SELECT "externalId", "lastUpdatedTime" FROM e
          WHERE "lastUpdatedTime" > (SELECT max("lastUpdatedTime") FROM s)""",
)
def instances_bootstrap(spark, sf):
    edges = d.edges(spark, sf).select("externalId", "lastUpdatedTime", "createdTime")
    early = (F.col("createdTime") < 950000000000) & (F.col("lastUpdatedTime") < 950000000000)
    return ops.bootstrap(edges.where(early), edges).drop("createdTime")


@query(
    "view_has_data",
    f"""SELECT "externalId", price FROM ({d.NODES}) WHERE price IS NOT NULL""",
)
def view_has_data(spark, sf):
    return ops.has_data(d.instances(spark, sf), d.PREMIUM).select(
        "externalId", F.col("properties.Premium.price").alias("price")
    )


@query(
    "edge_type_filter",
    f"""SELECT "externalId", quantity FROM ({d.EDGES}) WHERE type_id = 'flag_N'""",
)
def edge_type_filter(spark, sf):
    return ops.of_type(d.edges(spark, sf), d.SPACE, "flag_N").select(
        "externalId", F.col("properties.Supplies.quantity").alias("quantity")
    )
