"""A third of the rows on one key: joins split it, aggregations reduce it before the shuffle.

Thresholds are lowered so that a small table shows what a large one does under the defaults.
"""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemark.operators import events, merge, scan, series

LOWERED = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "16",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}
ROWS = 300_000


@pytest.fixture
def lowered(spark):
    before = {k: spark.conf.get(k, None) for k in LOWERED}
    for k, v in LOWERED.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot(spark):
    """Points of 1000 series, one of which has a third of them."""
    series_id = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 1000))
    return spark.range(0, ROWS, 1, 8).select(
        series_id.alias("externalId"),
        F.timestamp_millis("id").alias("timestamp"),
        F.rand(1).alias("value"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    rows = df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return rows, plan


def bounds(spark):
    return spark.range(1000).select(
        F.concat(F.lit("s"), "id").alias("externalId"), F.timestamp_millis(F.lit(1000)).alias("since")
    ).unionByName(spark.sql("SELECT 'hot' AS externalId, timestamp_millis(5000) AS since"))


def test_series_scan_splits_the_hot_series(lowered):
    rows, plan = final_plan(scan.series_since(hot(lowered), bounds(lowered)))
    expected = sum(1 for i in range(ROWS) if i > (5000 if i % 3 == 0 else 1000))
    assert len(rows) == expected and "skew=true" in plan


def test_it_still_does_under_an_aggregation_by_series(lowered):
    fresh = scan.series_since(hot(lowered), bounds(lowered))
    rows, plan = final_plan(fresh.groupBy("externalId").agg(F.max("timestamp"), F.max("payload")))
    assert len(rows) == 1 + len({i % 1000 for i in range(1001, ROWS) if i % 3}) and "skew=true" in plan


def test_null_keys_of_the_target_are_split(lowered):
    target = hot(lowered).withColumn("externalId", F.when(F.col("externalId") != "hot", F.col("externalId")))
    # narrow keys, one row each, that do not bring the nulls together again
    source = lowered.range(1000).select(
        F.concat(F.lit("s"), "id").alias("externalId"), F.lit(None).cast("timestamp").alias("timestamp"),
        F.lit(0.5).alias("value"), F.lit("x").alias("payload"),
    )
    rows, plan = final_plan(merge.upsert(target, source, ["externalId"]).select("externalId", "payload"))
    assert sum(1 for r in rows if r.externalId is None) == ROWS // 3 and len(rows) == ROWS // 3 + 1000
    assert "skew=true" in plan


def test_a_shared_asset_list_is_split(lowered):
    ids = F.when(F.col("id") % 3 == 0, F.array(F.lit("a1"), F.lit("a2"))).otherwise(
        F.array(F.concat(F.lit("a"), F.col("id") % 500))
    )
    evs = lowered.range(0, ROWS, 1, 8).select(
        "id", ids.alias("assetExternalIds"), F.sha2(F.col("id").cast("string"), 256).alias("payload")
    )
    assets = lowered.range(500).select("id", F.concat(F.lit("a"), "id").alias("externalId"))
    rows, plan = final_plan(events.resolve_assets(evs, assets))
    assert len(rows) == ROWS and "skew=true" in plan
    assert all(r.assetIds == ([1, 2] if r.id % 3 == 0 else [r.id % 500]) for r in rows)


def test_distinct_keys_are_reduced_before_the_shuffle(lowered):
    unseen = series.unseen_ids(hot(lowered), lowered.createDataFrame([("s1",)], "externalId string"))
    plan = unseen._jdf.queryExecution().executedPlan().toString()
    exchange = plan.index("Exchange hashpartitioning")
    assert "HashAggregate" in plan[exchange:]
    assert "hot" in {r.externalId for r in unseen.collect()}


def test_a_shared_asset_of_series_is_split(lowered):
    asset = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 500)
    rows = lowered.range(0, ROWS, 1, 8).select(
        F.concat(F.lit("s"), "id").alias("externalId"),
        F.sha2(F.col("id").cast("string"), 256).alias("name"),
        F.lit(None).cast("string").alias("description"),
        F.lit(False).alias("isString"),
        F.lit(False).alias("isStep"),
        F.lit("u").alias("unit"),
        F.create_map().cast("map<string,string>").alias("metadata"),
        asset.alias("assetId"),
    )
    assets = lowered.range(500).select("id", F.concat(F.lit("a"), "id").alias("externalId"))
    stored, plan = final_plan(series.series_rows(rows, assets))
    assert len(stored) == ROWS and "skew=true" in plan
    assert sum(1 for r in stored if r.assetExternalId == "a7") == ROWS // 3 + sum(
        1 for i in range(ROWS) if i % 3 and i % 500 == 7
    )


def test_a_target_holding_a_key_many_times_is_split(lowered):
    source = lowered.range(1000).select(
        F.when(F.col("id") == 0, "hot").otherwise(F.concat(F.lit("s"), "id")).alias("externalId"),
        F.lit(2.0).alias("value"),
    )
    rows, plan = final_plan(merge.upsert(hot(lowered), source, ["externalId"]))
    assert sum(1 for r in rows if r.value == 2.0) == 1000 and "skew=true" in plan
