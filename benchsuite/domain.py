"""The test tables seen as the feeds and tables the operators work on.

The SQL fragments are the same mappings for the oracle; keep the two in step.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.instances import View

FEED_PAGE = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ms(column: str | Column) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return F.unix_millis(column.cast("timestamp"))


# ---- points ----------------------------------------------------------------------------------

PTS = "SELECT 'user_' || user_id AS \"externalId\", ts AS \"timestamp\", value, event_id FROM events"


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("user_"), F.col("user_id")).alias("externalId"),
        F.col("ts").alias("timestamp"),
        "value",
        "event_id",
    )


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points as change-feed records: per user and page of consecutive event ids.

    A page holds at most FEED_PAGE events, so no record grows with the data.
    """
    point = F.struct("event_id", ms("ts").alias("ms"), "value")
    return (
        table(spark, sf_dir, "events")
        .groupBy("user_id", F.floor(F.col("event_id") / FEED_PAGE).alias("page"))
        .agg(F.sort_array(F.collect_list(point)).alias("p"))
        .select(
            F.concat(F.lit("user_"), F.col("user_id")).alias("external_id"),
            F.struct(
                F.col("p.ms").alias("timestamp"),
                F.col("p.value").alias("value"),
            ).alias("upserts"),
            F.col("page").cast("long").alias("cursor"),
        )
    )


# ---- events ----------------------------------------------------------------------------------

EVT = """SELECT 'order_' || o_orderkey AS "externalId", epoch_ms(o_orderdate) AS "createdTime",
  epoch_ms(o_orderdate) AS "startTime", o_orderpriority AS "dataSet", o_orderstatus AS "type" FROM orders"""


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("order_"), F.col("o_orderkey")).alias("externalId"),
        ms("o_orderdate").alias("createdTime"),
        ms("o_orderdate").alias("startTime"),
        F.col("o_orderpriority").alias("dataSet"),
        F.col("o_orderstatus").alias("type"),
    )


# ---- RAW rows --------------------------------------------------------------------------------

RAW = """SELECT l_orderkey || '-' || l_linenumber AS "key", epoch_ms(l_shipdate) AS last_updated_time,
  l_partkey AS part, l_returnflag AS flag, l_quantity AS quantity FROM lineitem"""


def raw_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RAW rows with a struct of columns, one of which clashes with the fixed ``key``."""
    return table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("key"),
        F.struct(
            F.col("l_partkey").alias("part"),
            F.col("l_returnflag").alias("flag"),
            F.col("l_quantity").alias("quantity"),
            F.col("l_linestatus").alias("key"),
        ).alias("columns"),
        ms("l_shipdate").alias("last_updated_time"),
    )


# ---- series ----------------------------------------------------------------------------------


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as series: some lack a unit, a description, metadata or an asset."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("externalId"),
        F.col("c_name").alias("name"),
        F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment")).alias("description"),
        (F.col("c_mktsegment") == "MACHINERY").alias("isString"),
        (F.col("c_acctbal") < 0).alias("isStep"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("unit"),
        F.when(
            F.col("c_nationkey") > 5, F.create_map(F.lit("segment"), F.col("c_mktsegment"))
        ).otherwise(F.create_map().cast("map<string,string>")).alias("metadata"),
        F.when(F.col("c_nationkey") != 3, F.col("c_nationkey").cast("long")).alias("assetId"),
    )


def assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("long").alias("id"), F.col("n_name").alias("externalId")
    )


# ---- instances -------------------------------------------------------------------------------

SPACE = "plant"
PART = View(SPACE, "Part", "1", "node", ("name", "brand", "size"))
PREMIUM = View(SPACE, "Premium", "1", "node", ("price",))
SUPPLIER = View(SPACE, "Supplier", "1", "node", ("name", "nation"))
SUPPLIES = View(SPACE, "Supplies", "1", "edge", ("quantity",))
VIEWS = (PART, PREMIUM, SUPPLIER, SUPPLIES)

# ids carry apostrophes on purpose
NODES = """
  SELECT 'plant' AS space, 'part ''' || p_partkey || '''' AS "externalId", 1 AS version,
    1700000000000 + p_partkey * 1000 AS "lastUpdatedTime", 1600000000000 + p_partkey AS "createdTime",
    CASE WHEN p_brand = 'Brand#10' THEN 1800000000000 + p_partkey END AS "deletedTime",
    p_name AS name, p_brand AS brand, p_size AS size, NULL AS nation,
    CASE WHEN p_retailprice > 950 THEN p_retailprice END AS price, 'Part' AS view
  FROM part
  UNION ALL
  SELECT 'plant', 'supplier ''' || s_suppkey || '''', 1,
    1700000000500 + s_suppkey * 1000, 1600000000000 + s_suppkey,
    CASE WHEN s_nationkey = 7 THEN 1800000000000 + s_suppkey END,
    s_name, NULL, NULL, s_nationkey, NULL, 'Supplier'
  FROM supplier"""
EDGES = """
  SELECT 'plant' AS space, l_partkey || '-' || l_suppkey AS "externalId", 1 AS version,
    max(epoch_ms(l_shipdate)) AS "lastUpdatedTime", min(epoch_ms(l_shipdate)) AS "createdTime",
    CASE WHEN max(l_returnflag) = 'A' THEN max(epoch_ms(l_shipdate)) END AS "deletedTime",
    'plant' AS type_space, 'flag_' || max(l_returnflag) AS type_id,
    'part ''' || l_partkey || '''' AS start_id, 'supplier ''' || l_suppkey || '''' AS end_id,
    max(l_quantity) AS quantity
  FROM lineitem GROUP BY l_partkey, l_suppkey"""

NO_TYPE = "struct<space:string,externalId:string>"
PROPERTIES = (
    "struct<Part:struct<name:string,brand:string,size:int>,Premium:struct<price:double>,"
    "Supplier:struct<name:string,nation:int>,Supplies:struct<quantity:double>>"
)


def _properties(**present: Column) -> Column:
    """The properties struct with the given views filled and the others null."""
    types = {
        "Part": "struct<name:string,brand:string,size:int>",
        "Premium": "struct<price:double>",
        "Supplier": "struct<name:string,nation:int>",
        "Supplies": "struct<quantity:double>",
    }
    return F.struct(
        *[present.get(v, F.lit(None)).cast(t).alias(v) for v, t in types.items()]
    ).alias("properties")


def _quoted_id(kind: str, key: str) -> Column:
    return F.concat(F.lit(f"{kind} '"), F.col(key), F.lit("'"))


def _reference(external_id: Column) -> Column:
    return F.struct(F.lit(SPACE).alias("space"), external_id.alias("externalId"))


def _instance(kind: str, external_id, updated, created, deleted, kind_ref, start, end, properties):
    return [
        F.lit(SPACE).alias("space"),
        F.lit(kind).alias("instanceType"),
        external_id.alias("externalId"),
        F.lit(1).alias("version"),
        updated.cast("long").alias("lastUpdatedTime"),
        created.cast("long").alias("createdTime"),
        deleted.cast("long").alias("deletedTime"),
        kind_ref.cast(NO_TYPE).alias("type"),
        start.cast(NO_TYPE).alias("startNode"),
        end.cast(NO_TYPE).alias("endNode"),
        properties,
    ]


def nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    none = F.lit(None)
    key = F.col("p_partkey")
    premium = F.when(F.col("p_retailprice") > 950, F.struct(F.col("p_retailprice").alias("price")))
    parts = table(spark, sf_dir, "part").select(
        *_instance(
            "node",
            _quoted_id("part", "p_partkey"),
            1700000000000 + key * 1000,
            1600000000000 + key,
            F.when(F.col("p_brand") == "Brand#10", 1800000000000 + key),
            none,
            none,
            none,
            _properties(
                Part=F.struct(
                    F.col("p_name").alias("name"),
                    F.col("p_brand").alias("brand"),
                    F.col("p_size").alias("size"),
                ),
                Premium=premium,
            ),
        )
    )
    key = F.col("s_suppkey")
    suppliers = table(spark, sf_dir, "supplier").select(
        *_instance(
            "node",
            _quoted_id("supplier", "s_suppkey"),
            1700000000500 + key * 1000,
            1600000000000 + key,
            F.when(F.col("s_nationkey") == 7, 1800000000000 + key),
            none,
            none,
            none,
            _properties(
                Supplier=F.struct(F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"))
            ),
        )
    )
    return parts.unionByName(suppliers)


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    shipped = ms("l_shipdate")
    pairs = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_partkey", "l_suppkey")
        .agg(
            F.max(shipped).alias("updated"),
            F.min(shipped).alias("created"),
            F.max("l_returnflag").alias("flag"),
            F.max("l_quantity").alias("quantity"),
        )
    )
    return pairs.select(
        *_instance(
            "edge",
            F.concat_ws("-", "l_partkey", "l_suppkey"),
            F.col("updated"),
            F.col("created"),
            F.when(F.col("flag") == "A", F.col("updated")),
            _reference(F.concat(F.lit("flag_"), F.col("flag"))),
            _reference(_quoted_id("part", "l_partkey")),
            _reference(_quoted_id("supplier", "l_suppkey")),
            _properties(Supplies=F.struct("quantity")),
        )
    )


def instances(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nodes(spark, sf_dir).unionByName(edges(spark, sf_dir))


TABLE_COLUMNS = (
    "table_name string, name string, brand string, size int, nation int, price double, startNode string, endNode string, "
    "quantity double"
)


def rows_per_table(tables: dict) -> DataFrame:
    """Every column of all tables, endpoints as ids; one no instance was routed to does not exist."""
    parts = []
    for name, table in tables.items():
        if table.exists():
            rows = table.read().withColumn("table_name", F.lit(name))
            for end in ("startNode", "endNode"):
                if end in rows.columns:
                    rows = rows.withColumn(end, F.col(f"{end}.externalId"))
            parts.append(rows)
    every = parts[0].sparkSession.createDataFrame([], TABLE_COLUMNS)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts, every)


_BASE = 'space, "externalId", version, "lastUpdatedTime", "createdTime"'
TABLES_SQL = f"""WITH n AS ({NODES}), e AS ({EDGES})
  SELECT 'plant_' || view AS table_name, {_BASE}, 'node' AS "instanceType", name, brand, size, nation, CAST(NULL AS DOUBLE) AS price,
    CAST(NULL AS VARCHAR) AS "startNode", CAST(NULL AS VARCHAR) AS "endNode", CAST(NULL AS DOUBLE) AS quantity
  FROM n WHERE "deletedTime" IS NULL
  UNION ALL SELECT 'plant_Premium', {_BASE}, 'node', NULL, NULL, NULL, NULL, price, NULL, NULL, NULL
  FROM n WHERE "deletedTime" IS NULL AND price IS NOT NULL
  UNION ALL SELECT 'plant_edges', {_BASE}, 'edge', NULL, NULL, NULL, NULL, NULL, start_id, end_id, quantity
  FROM e WHERE "deletedTime" IS NULL"""


# ---- files -----------------------------------------------------------------------------------


def page_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as catalog rows, the page id standing in for the modification time."""
    return table(spark, sf_dir, "pages").select(
        F.col("url").alias("external_id"), F.col("page_id").alias("source_modified_time")
    )


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as a listing of files: their path, time, length and bytes."""
    return table(spark, sf_dir, "pages").select(
        F.concat(F.col("url"), F.lit("/"), F.col("page_id")).alias("path"),
        F.timestamp_seconds(F.col("page_id") + 1_700_000_000).alias("modificationTime"),
        F.octet_length("html").cast("long").alias("length"),
        F.encode("html", "UTF-8").alias("content"),
    )


LISTING = """SELECT url || '/' || page_id AS external_id, CAST(page_id AS VARCHAR) AS name, CAST(123456 AS BIGINT) AS data_set_id,
  (page_id + 1700000000) * 1000 AS source_created_time, (page_id + 1700000000) * 1000 AS source_modified_time,
  strlen(html) AS length, md5(html) AS content FROM pages"""
