"""Keyed tables in buckets: reads and merges without a shuffle of what is stored."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from tidemark.sources import Shape
from tidemark.sources.bucketed import BucketedTable

KEYED = Shape(keys=("k",), order=("n",), hidden=("n",))


@pytest.fixture
def table(spark, tmp_path):
    name = f"bucketed_{tmp_path.name}".replace("-", "_")
    yield BucketedTable(spark, name, str(tmp_path / "t"), rows(spark, 1).schema, KEYED, buckets=6)
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def rows(spark, n, value=0, start=0):
    return spark.range(start, n).select(F.col("id").cast("string").alias("k"), F.lit(value).alias("v"), F.col("id").alias("n"))


def plan(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_the_last_row_of_a_key_counts_and_a_repeat_replaces_itself(spark, table):
    assert table.add(rows(spark, 50), ("w", 0)) == 50
    assert table.add(rows(spark, 60, 1, 40), ("w", 1)) == 20
    table.add(rows(spark, 45, 2, 40), ("w", 1))
    got = {r.k: r.v for r in table.read().collect()}
    assert got == {str(k): 2 if 40 <= k < 45 else 0 for k in range(50)} and table.read().columns == ["k", "v"]
    table.add(rows(spark, 1, 9).withColumn("n", F.lit(-5).cast("long")), ("x", 0))  # an older row
    assert table.read().where("k = '0'").first().v == 0


def test_nothing_stored_is_shuffled(spark, table):
    for k in range(3):
        table.add(rows(spark, 400, k), ("w", k))
    assert "Exchange" not in plan(table.read())
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        some = plan(table.matching(rows(spark, 5)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    stored = some[some.index("FileScan parquet"):]
    assert "SortMergeJoin" in some and "Bucketed: true" in stored
    before = some[:some.index("FileScan parquet")]
    assert before.count("Exchange") == 0 or before.rindex("Exchange") < before.rindex("SortMergeJoin")
    assert sorted(r.k for r in table.matching(rows(spark, 5)).collect()) == list("01234")


def test_a_batch_costs_its_own_size(spark, table, tmp_path):
    table.add(rows(spark, 5000), ("w", 0))

    def files():
        return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(tmp_path / "t") for f in fs if f.startswith("part-")}

    before = files()
    table.add(rows(spark, 18, 1, 17), ("w", 1))
    after = files()
    assert {f: after[f] for f in before} == before and len(after) == len(before) + 1
    assert table.read().where("v = 1").count() == 1 and table.read().count() == 5000


def test_another_session_finds_the_batches(spark, table, tmp_path):
    table.add(rows(spark, 9), ("w", 0))
    again = BucketedTable(spark, f"{table.name}_again", str(tmp_path / "t"), rows(spark, 1).schema, KEYED, buckets=6)
    assert again.read().count() == 9
    spark.sql(f"DROP TABLE {again.name}")


def test_null_keys_and_other_shapes(spark, table, tmp_path):
    nothing = spark.createDataFrame([(None, 1, 1), (None, 2, 2)], "k string, v int, n long")
    table.add(nothing, ("w", 0))
    assert table.read().count() == 2
    with pytest.raises(ValueError):
        BucketedTable(spark, "x", str(tmp_path / "x"), rows(spark, 1).schema, Shape(keys=("k",), day="n"))
