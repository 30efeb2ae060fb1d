from __future__ import annotations

from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators import merge


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_last_arrival_wins_and_null_keys_stay(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, "y"), (None, 1, "n"), (None, 1, "n")], "k string, seq int, v string"
    )
    assert rows(merge.dedupe_last(df, ["k"], ["seq"])) == Counter(
        {("a", 2, "y"): 1, (None, 1, "n"): 2}
    )


def test_rows_with_map_columns_can_be_deduplicated(spark):
    df = spark.createDataFrame([("a", 1, {"x": "1"}), ("a", 2, {"x": "2"})], "k string, seq int, m map<string,string>")
    assert merge.dedupe_last(df, ["k"], ["seq"]).first().m == {"x": "2"}


def test_key_only_rows(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    assert rows(merge.dedupe_last(df, ["k"])) == Counter({("a",): 1, (None,): 1})


def test_matched_rows_take_source_values_nulls_included(spark):
    target = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    source = spark.createDataFrame([("b", None), ("c", 4), (None, 5)], "k string, v int")
    assert rows(merge.upsert(target, source, ["k"])) == Counter(
        {("a", 1): 1, ("b", None): 1, (None, 3): 1, ("c", 4): 1, (None, 5): 1}
    )


def test_target_only_columns_survive_and_new_ones_are_added(spark):
    target = spark.createDataFrame([("a", 1, "t"), ("b", 2, "u")], "k string, v int, keep string")
    source = spark.createDataFrame([("b", 20, 0.5), ("c", 30, 0.6)], "k string, v int, extra double")
    merged = merge.upsert(target, source, ["k"]).select("k", "v", "keep", "extra")
    assert rows(merged) == Counter(
        {("a", 1, "t", None): 1, ("b", 20, "u", 0.5): 1, ("c", 30, None, 0.6): 1}
    )


def test_a_repeated_target_key_is_held_once_after_a_match(spark):
    """Whether the source has all columns or not; keys it doesn't hold stay as they are."""
    target = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 3, "z"), ("b", 3, "z")], "k string, v int, w string")
    source = spark.createDataFrame([("a", 9)], "k string, v int")
    assert rows(merge.upsert(target.drop("w"), source, ["k"])) == Counter({("a", 9): 1, ("b", 3): 2})
    assert rows(merge.upsert(target, source, ["k"]).select("k", "v")) == Counter({("a", 9): 1, ("b", 3): 2})


def test_order_columns_can_be_left_out(spark):
    target = spark.createDataFrame([("a", 1)], "k string, v int")
    source = spark.createDataFrame([("a", 3, 1), ("a", 2, 2)], "k string, v int, seq int")
    merged = merge.upsert(target, source, ["k"], ["seq"], ["seq"])
    assert merged.columns == ["k", "v"] and rows(merged) == Counter({("a", 2): 1})


def test_upsert_twice_changes_nothing(spark):
    target = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    source = spark.createDataFrame([("b", 5), ("c", 6)], "k string, v int")
    once = merge.upsert(target, source, ["k"])
    assert rows(merge.upsert(once, source, ["k"])) == rows(once)


def test_delete_takes_every_version_and_ids_with_quotes(spark):
    target = spark.createDataFrame([("o'neil", 1), ("o'neil", 2), ("b", 1), (None, 1)], "externalId string, v int")
    deleted = spark.createDataFrame([("o'neil",), ("o'neil",), (None,)], "externalId string")
    assert rows(merge.delete_by_key(target, deleted)) == Counter({("b", 1): 1, (None, 1): 1})


def test_append_adds_columns_by_name(spark):
    old = spark.createDataFrame([(1, "a")], "id int, x string")
    new = spark.createDataFrame([(0.5, 2)], "y double, id int")
    assert rows(merge.append_evolving(old, new)) == Counter({(1, "a", None): 1, (2, None, 0.5): 1})


KEY = st.one_of(st.none(), st.sampled_from("abcd"))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.dictionaries(st.sampled_from("abcdef"), st.integers(0, 9)),
    st.lists(st.tuples(KEY, st.integers(0, 9), st.integers(0, 5)), max_size=12),
)
def test_upsert_equals_brute_force(spark, target, source):
    left = spark.createDataFrame(list(target.items()), "k string, v int")
    right = spark.createDataFrame(source, "k string, v int, seq int")
    latest, loose = {}, Counter()
    for k, v, seq in source:
        if k is None:
            loose[(None, v)] += 1
        elif k not in latest or (seq, v) > latest[k]:
            latest[k] = (seq, v)
    expected = {**target, **{k: v for k, (_, v) in latest.items()}}
    merged = merge.upsert(left, right, ["k"], ["seq"], ["seq"])
    assert rows(merged) == Counter(expected.items()) + loose


def test_a_key_holding_most_rows_is_reduced_before_the_shuffle(spark):
    hot = spark.range(100_000).select(F.lit("hot").alias("k"), F.col("id").alias("seq"))
    reduced = merge.dedupe_last(hot, ["k"], ["seq"])
    assert [tuple(r) for r in reduced.collect()] == [("hot", 99_999)]
    plan = reduced._jdf.queryExecution().executedPlan().toString()
    exchange = plan.index("Exchange hashpartitioning")
    assert "partial_max" in plan[exchange:]


@pytest.mark.parametrize("more", [[], ["w"]])
def test_no_side_is_forced_to_broadcast(spark, more):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        source = spark.range(10).select(F.col("id").alias("k"), F.col("id").alias("v"))
        target = source.withColumns({w: F.lit(1) for w in more})
        plan = merge.upsert(target, source, ["k"])._jdf.queryExecution().executedPlan().toString()
        assert "Broadcast" not in plan and "CartesianProduct" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_keys_of_different_types_still_match(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    source = spark.createDataFrame([(2, "c"), (5_000_000_000, "d")], "k long, v string")
    assert rows(merge.upsert(target, source, ["k"])) == Counter(
        {(1, "a"): 1, (2, "c"): 1, (5_000_000_000, "d"): 1}
    )


def scans(df, path):
    conf = df.sparkSession.conf
    conf.set("spark.sql.maxMetadataStringLength", "4096")  # plans cut longer paths
    try:
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        return plan.split("Initial Plan")[0].count(f"[file:{path}]")
    finally:
        conf.unset("spark.sql.maxMetadataStringLength")


def test_how_often_each_side_is_read(spark, tmp_path):
    target, source = str(tmp_path / "target"), str(tmp_path / "source")
    spark.range(100).select(F.col("id").alias("k"), F.col("id").alias("v")).write.parquet(target)
    spark.range(50, 150).select(F.col("id").alias("k"), F.col("id").alias("v")).write.parquet(source)
    left, right = spark.read.parquet(target), spark.read.parquet(source)
    assert scans(merge.dedupe_last(right, ["k"]), source) == 1
    merged = merge.upsert(left, right, ["k"])
    assert scans(merged, target) == 1 and scans(merged, source) <= 2
