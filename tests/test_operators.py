"""Golden values per operator."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from benchsuite import domain
from benchsuite.streams import _tile
from tidemark import schemas
from tidemark.operators import events, files, instances, points, raw, scan, series, watermark
from tidemark.operators.instances import View


def tuples(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


# ---- points ----------------------------------------------------------------------------------


def test_feed_records_become_one_row_per_point(spark):
    feed = spark.createDataFrame(
        [("id1", ([1631234567000, 1631234568000], [1.23, 4.56]), 1), ("id2", ([], []), 2)],
        schemas.POINTS_FEED,
    )
    got = points.explode_feed(feed).withColumn("timestamp", F.col("timestamp").cast("string"))
    assert tuples(got.drop("cursor"), "timestamp") == [
        ("id1", "2021-09-10 00:42:47", 1.23),
        ("id1", "2021-09-10 00:42:48", 4.56),
    ]


def test_surplus_values_are_ignored(spark):
    feed = spark.createDataFrame([("id1", ([1000], [1.0, 2.0]), 1)], schemas.POINTS_FEED)
    assert points.explode_feed(feed).count() == 1


def test_wide_frame(spark):
    df = spark.createDataFrame([(1, "a", 0.5), (1, "b", 0.6), (2, "a", 0.7)], "timestamp int, externalId string, value double")
    assert tuples(points.wide(df, ["a", "b"]), "timestamp") == [(1, 0.5, 0.6), (2, 0.7, None)]
    assert points.wide(df, ["b", "c"]).columns == ["timestamp", "b", "c"]


def test_a_wide_frame_of_many_series(spark):
    names = [f"s{n}" for n in range(1001)]
    df = spark.createDataFrame([(1, n, float(k)) for k, n in enumerate(names)], "timestamp int, externalId string, value double")
    row = points.wide(df, names).first()
    assert len(row) == 1002 and row.s1000 == 1000.0


def test_prefix(spark):
    df = spark.createDataFrame([("id1", 1.0)], "externalId string, value double")
    assert tuples(points.prefix_ids(df, "test_ts_")) == [("test_ts_id1", 1.0)]


# ---- series ----------------------------------------------------------------------------------

SERIES = (
    "externalId string, name string, description string, isString boolean, isStep boolean, "
    "unit string, metadata map<string,string>, assetId long"
)


def test_series_metadata_is_resolved_and_defaulted(spark):
    rows = [
        ("id1", "test_ts", "test_description", False, False, "u", {"key": "value"}, 123),
        ("id2", "n", None, False, False, "u", {}, None),
        ("id3", None, None, False, False, "u", {}, None),
        ("id4", "n", None, False, False, None, {}, 123),
        ("id5", "n", None, False, False, "u", None, 999),
    ]
    assets = spark.createDataFrame([(123, "test_asset")], "id long, externalId string")
    got = tuples(series.series_rows(spark.createDataFrame(rows, SERIES), assets, "svc"), "externalId")
    assert got == [
        ("id1", "test_ts", "test_description", False, False, "u", {"key": "value"}, "test_asset"),
        ("id2", "n", "", False, False, "u", {"source": "svc"}, ""),
        ("id5", "n", "", False, False, "u", {"source": "svc"}, ""),
    ]


def test_missing_series_are_named_after_their_id(spark):
    pts = spark.createDataFrame([("id1",), ("id1",), ("id2",)], "externalId string")
    known = spark.createDataFrame([("id2",)], "externalId string")
    assert tuples(series.missing_series(pts, known, 7)) == [("id1", "id1", True, 7)]


# ---- events ----------------------------------------------------------------------------------


def test_asset_ids_keep_order_and_skip_unknown(spark):
    evs = spark.createDataFrame(
        [(1, ["b", "x", "a", "b"]), (2, []), (3, None), (4, ["x"]), (5, ["b", "x", "a", "b"])],
        "id int, assetExternalIds array<string>",
    )
    assets = spark.createDataFrame([(10, "a"), (20, "b")], "id long, externalId string")
    assert tuples(events.resolve_assets(evs, assets), "id") == [
        (1, [20, 10, 20]), (2, []), (3, None), (4, []), (5, [20, 10, 20]),
    ]
    assert tuples(events.unknown_assets(evs, assets)) == [("x",)]


def test_event_shape_fills_absent_columns(spark):
    evs = spark.createDataFrame([("e1", 5)], "externalId string, startTime long")
    row = events.event_rows(evs, 123456).first().asDict()
    assert row == {
        "externalId": "e1", "startTime": 5, "endTime": None, "type": None, "subtype": None,
        "metadata": None, "description": None, "assetExternalIds": None, "dataSetId": 123456,
    }


@pytest.mark.parametrize("last, expected", [(None, ["a", "b", "c"]), (10, ["b", "c"]), (11, ["c"])])
def test_events_start_one_after_the_last_created(spark, last, expected):
    evs = spark.createDataFrame(
        [("zero", 0, "d"), ("a", 10, "d"), ("b", 11, "d"), ("c", 12, "d"), ("other", 13, "e")],
        "externalId string, createdTime long, dataSet string",
    )
    assert [r[0] for r in tuples(scan.events_since(evs, last, "d"), "createdTime")] == expected
    first = [r.externalId for r in scan.events_since(evs, last, "d", 1).collect()]
    assert first == expected[:1]


# ---- RAW -------------------------------------------------------------------------------------


def test_raw_columns_are_promoted_and_fixed_ones_win(spark):
    rows = spark.sql(
        "SELECT 'k1' AS `key`, named_struct('type', 'N', 'key', 'clash') AS columns, 17 AS last_updated_time"
    )
    assert raw.flatten_rows(rows).columns == ["type", "key", "last_updated_time"]
    assert tuples(raw.flatten_rows(rows)) == [("N", "k1", 17)]


def test_raw_maps_keep_undeclared_names(spark):
    kind = "key string, columns map<string,string>, last_updated_time long"
    rows = spark.createDataFrame([("k", {"a": "1", "b": "2", "key": "x"}, 5)], kind)
    assert tuples(raw.flatten_rows(rows, ["a", "b"])) == [("1", "2", None, "k", 5)]
    assert tuples(raw.flatten_rows(rows, ["a"])) == [("1", {"b": "2"}, "k", 5)]
    assert tuples(raw.flatten_rows(rows)) == [({"a": "1", "b": "2"}, "k", 5)]
    many = spark.createDataFrame([("k", {f"n{n}": str(n) for n in range(10_001)}, 5)], kind)
    got = raw.flatten_rows(many, ["n7"]).first()
    assert got.n7 == "7" and len(got.other_columns) == 10_000


def test_a_key_column_of_the_table_stays(spark):
    df = spark.createDataFrame([("a-b", "c", "x"), ("a", "b-c", "y"), ("a\\", "-b", "z")], "p string, q string, key string")
    out = raw.export_rows(df, ["p", "q"])
    assert sorted(r.key for r in out.collect()) == ["x", "y", "z"]
    assert len({r.row_key for r in out.collect()}) == 3  # separators within values are escaped
    assert [r.row_key for r in raw.export_rows(df, ["p"]).orderBy("key").collect()] == ["a-b", "a", "a\\"]


@pytest.mark.parametrize("fields, md5", [(["a"], False), (["a", "b"], True), (None, True), (None, False)])
def test_exported_rows_have_a_stable_key(spark, fields, md5):
    df = spark.createDataFrame([(1, "x"), (2, None)], "a int, b string")
    keys = [r.row_key for r in raw.export_rows(df, fields, md5).orderBy("a").collect()]
    if fields == ["a"]:
        assert keys == ["1", "2"]
    else:
        assert all(len(k) == 32 for k in keys) and len(set(keys)) == 2


# ---- scans -----------------------------------------------------------------------------------


def batches(df, size):
    watermark_value, seen = None, []
    while True:
        batch = [r.v for r in scan.next_batch(df, "v", size, watermark_value).collect()]
        if not batch:
            return seen
        seen.append(sorted(batch, key=lambda v: (v is not None, v)))
        tops = [v for v in batch if v is not None]
        if not tops:
            return seen
        watermark_value = max(tops)


@pytest.mark.parametrize("size", [1, 2, 3, 10, 1000])
def test_batch_size_does_not_change_what_is_read(spark, size):
    data = [5, 1, 1, 1, 2, 3, 3, None, 8, 9]
    df = spark.createDataFrame([(v,) for v in data], "v int")
    read = [v for batch in batches(df, size) for v in batch]
    assert sorted(read, key=str) == sorted(data, key=str)


def test_a_batch_ends_with_all_ties_of_its_last_value(spark):
    df = spark.createDataFrame([(v,) for v in [1, 2, 2, 2, 3]], "v int")
    assert batches(df, 2) == [[1, 2, 2, 2], [3]]


@pytest.mark.parametrize("size", [10, 500, 5000, 60_000, 99_999])
def test_large_batches_are_cut_exactly(spark, size):
    df = spark.range(100_000).select(F.shiftright(F.xxhash64("id"), 20).alias("v"))
    ranked = sorted(r.v for r in df.collect())
    got = scan.next_batch(df, "v", size).agg(F.max("v"), F.count("v")).first()
    assert got[0] == ranked[size - 1] and got[1] >= size


def test_batches_over_text_fields(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",)], "v string")
    assert sorted(r.v for r in scan.next_batch(df, "v", 2).collect()) == ["a", "b"]


def test_incremental_filters_reach_the_scan(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/events.parquet")
    for watermark_value, field in (("2024-01-15 00:00:00.000000+0000", "ts"), ("50", "event_id")):
        plan = scan.since(df, field, watermark_value)._jdf.queryExecution().executedPlan().toString()
        assert f"GreaterThan({field}" in plan


def test_only_one_column_is_read_for_ids(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/events.parquet")
    plan = scan.distinct_ids(df, "user_id")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<user_id:bigint>" in plan


def test_each_series_continues_after_its_own_watermark(spark):
    pts = spark.createDataFrame(
        [("a", datetime(2024, 1, d), 1.0) for d in (1, 2, 3)] + [("b", datetime(2024, 1, 1), 2.0)],
        "externalId string, timestamp timestamp, value double",
    )
    half = pts.where("externalId = 'a' AND timestamp < '2024-01-03'")
    states = watermark.series_watermark(half, "Tables/Raw-TS")
    bounds = watermark.series_bounds(states, "Tables/Raw-TS")
    got = scan.series_since(pts, bounds).select("externalId", F.dayofmonth("timestamp"))
    assert tuples(got, "externalId") == [("a", 3), ("b", 1)]


def test_members_cover_all_series_with_an_id(spark):
    df = spark.createDataFrame([(f"s{i}",) for i in range(50)] + [(None,)], "externalId string")
    got = scan.subscription_members(df, 4).collect()
    assert len(got) == 50 and {r.partition for r in got} == {0, 1, 2, 3}


# ---- watermarks ------------------------------------------------------------------------------

STATE = "state_id string, low string, high string, value_type string"


def test_setting_one_side_keeps_the_other_and_empty_values_change_nothing(spark):
    old = spark.createDataFrame([("a", "1", "9", "int"), ("b", "5", None, "int")], STATE)
    new = spark.createDataFrame(
        [("a", "2", None, "int"), ("b", None, None, "int"), ("c", "0", None, "int"), ("d", None, "7", "int")], STATE
    )
    assert tuples(watermark.advance(old, new), "state_id") == [
        ("a", "2", "9", "int"), ("b", "5", None, "int"), ("d", None, "7", "int"),
    ]


@pytest.mark.parametrize("start, expected", [(12345600, True), (12345601, False)])
def test_recent_updates_are_noticed(spark, start, expected):
    df = spark.createDataFrame([(12345600,), (1,)], "lastUpdatedTime long")
    assert watermark.has_recent_update(df, start).first()[0] is expected
    assert watermark.has_recent_update(df.limit(0), start).first()[0] is False


# ---- instances -------------------------------------------------------------------------------

TEST_VIEW = View("test_space", "test_view", "1", "node", ("prop1",))
OTHER_VIEW = View("test_space", "other", "1", "node", ("prop1", "version"))


def change_feed(spark):
    ref = "named_struct('space', 'test_space', 'externalId', '{}')"
    row = """SELECT 'test_space' AS space, '{kind}' AS instanceType, '{id}' AS externalId, 1 AS version,
        12345600L AS lastUpdatedTime, 12345600L AS createdTime, {deleted} AS deletedTime,
        {type} AS type, {start} AS startNode, {end} AS endNode,
        named_struct('test_view', named_struct('prop1', 'value1'),
                     'other', {other}) AS properties"""
    other = "CAST(NULL AS struct<prop1:string,version:int>)"
    null_ref = "CAST(NULL AS struct<space:string,externalId:string>)"
    parts = []
    for kind, type_name in (("node", "test_type_node"), ("edge", "test_type_edge")):
        ends = (ref.format("id1"), ref.format("id2")) if kind == "edge" else (null_ref, null_ref)
        for id_, deleted in (("id1", "12378900L"), ("id2", "CAST(NULL AS BIGINT)")):
            parts.append(
                row.format(kind=kind, id=id_, deleted=deleted, type=ref.format(type_name), start=ends[0], end=ends[1],
                           other="named_struct('prop1', 'later', 'version', 9)" if (kind, id_) == ("edge", "id2") else other)
            )
    return spark.sql(" UNION ALL ".join(parts))


def test_nodes_are_flattened_and_deletes_split(spark):
    nodes = change_feed(spark).where("instanceType = 'node'")
    live, deleted = instances.split_deleted(instances.flatten_nodes(nodes, TEST_VIEW))
    base = {
        "space": "test_space", "instanceType": "node", "version": 1,
        "lastUpdatedTime": 12345600, "createdTime": 12345600, "prop1": "value1",
    }
    assert [r.asDict() for r in live.collect()] == [{**base, "externalId": "id2"}]
    assert [r.asDict() for r in deleted.collect()] == [{**base, "externalId": "id1", "deletedTime": 12378900}]


def test_edges_carry_endpoints_and_the_later_view_wins(spark):
    edges = change_feed(spark).where("instanceType = 'edge'")
    live, deleted = instances.split_deleted(instances.flatten_edges(edges, [TEST_VIEW, OTHER_VIEW]))
    row = live.first().asDict(recursive=True)
    assert row["startNode"] == {"space": "test_space", "externalId": "id1"}
    assert row["endNode"] == {"space": "test_space", "externalId": "id2"}
    assert (row["prop1"], row["version"]) == ("later", 9)
    assert deleted.first()["prop1"] == "value1"


def test_instances_are_routed_per_view_and_space(spark):
    counts = instances.route_counts(change_feed(spark), [TEST_VIEW, OTHER_VIEW])
    assert tuples(counts, "table_name") == [
        ("test_space_edges", 1, 1), ("test_space_test_view", 1, 1),
    ]


def test_view_and_type_filters(spark):
    feed = change_feed(spark)
    assert instances.has_data(feed, OTHER_VIEW).count() == 1
    assert instances.of_type(feed, "test_space", "test_type_edge").count() == 2
    assert instances.of_type(feed, "elsewhere", "test_type_edge").count() == 0


def test_a_batch_appends_history_then_deletes(spark):
    flat = instances.flatten_nodes(change_feed(spark).where("instanceType = 'node'"), TEST_VIEW)
    before = flat.drop("deletedTime")
    after = instances.apply_batch(before, flat)
    assert [r.externalId for r in after.collect()] == ["id2", "id2"]


def test_bootstrap_continues_after_the_snapshot(spark):
    snapshot = spark.createDataFrame([("a", 5)], "externalId string, lastUpdatedTime long")
    changes = spark.createDataFrame([("a", 5), ("a", 6)], "externalId string, lastUpdatedTime long")
    assert tuples(instances.bootstrap(snapshot, changes), "lastUpdatedTime") == [("a", 5), ("a", 6)]
    assert instances.bootstrap(snapshot.limit(0), changes).count() == 2


# ---- files -----------------------------------------------------------------------------------


def test_file_catalog_and_changes(spark, tmp_path):
    from tidemark.sources.feeds import list_files

    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "test_file.csv").write_bytes(b"test_data")
    (tmp_path / "other.txt").write_bytes(b"x")
    catalog = files.catalog_rows(list_files(spark, str(tmp_path), content=True), 7)
    row = catalog.where("name = 'test_file.csv'").first()
    assert bytes(row.content) == b"test_data" and row.length == 9 and row.data_set_id == 7
    assert row.source_modified_time == int((tmp_path / "sub" / "test_file.csv").stat().st_mtime * 1000)
    known = catalog.select(
        "external_id",
        (F.col("source_modified_time") + F.when(F.col("name") == "other.txt", 1).otherwise(0)).alias("stored_time"),
    )
    assert [r.name for r in files.changed_files(catalog, known).collect()] == ["other.txt"]
    assert files.changed_files(catalog, known.limit(0)).count() == 2
    assert "content" not in files.catalog_rows(list_files(spark, str(tmp_path))).columns


def test_batches_over_uneven_values(spark):
    df = spark.range(50_000).select(
        F.when(F.col("id") < 30_000, 7).when(F.col("id") == 49_999, 10**15).otherwise(F.col("id")).cast("long").alias("v")
    )
    ranked = sorted(r.v for r in df.collect())
    for size in (1, 30_000, 30_001, 49_999, 50_000, 60_000):
        expected = ranked[min(size, 50_000) - 1]
        got = scan.next_batch(df, "v", size).agg(F.max("v"), F.count("v")).first()
        assert tuple(got) == (expected, sum(1 for v in ranked if v <= expected))


def test_batches_over_dates_and_doubles(spark):
    df = spark.range(100).select(F.date_add(F.lit("2024-01-01"), F.col("id").cast("int")).alias("d"), (F.col("id") / 7).alias("x"))
    assert scan.next_batch(df, "d", 10).count() == 10 and scan.next_batch(df, "x", 10).count() == 10
    assert scan.next_batch(df, "d", 10, "2024-01-31").count() == 10


def test_json_columns_are_found(spark):
    rows = spark.createDataFrame([
        ("1", '{"a": 1, "b": "x", "c": 1.5, "key": "no"}', 1), ("2", '{"a": 2, "c": 3, "d": true, "n": {"x": [1, 2]}}', 2),
        ("3", '{"b": 7, "o\'dd \\"name\\"": 1}', 3), ("4", "not json", 4), ("5", None, 5), ("6", "[1]", 6), ("7", '{"a": null}', 7),
    ], "key string, columns string, last_updated_time long")
    found = raw.found_columns(rows)
    assert found == [
        ("a", "bigint"), ("b", "string"), ("c", "double"), ("d", "boolean"), ("key", "string"), ("n", "string"), ("o'dd \"name\"", "bigint"),
    ]
    got = {r.key: r.asDict() for r in raw.flatten_json(rows).collect()}
    assert len(got) == 7 and got["1"] == {
        "a": 1, "b": "x", "c": 1.5, "d": None, "n": None, "o'dd \"name\"": None, "key": "1", "last_updated_time": 1}
    assert got["2"]["n"] == '{"x":[1,2]}' and got["2"]["c"] == 3.0 and got["3"]["b"] == "7" and got["3"]["o'dd \"name\""] == 1
    assert all(got[k]["a"] is None for k in "4567")
    assert raw.flatten_json(rows.limit(0)).columns == ["key", "last_updated_time"]


def test_a_frame_of_any_width(spark):
    """20,000 series: as many places are held as there are points."""
    at = F.timestamp_seconds(F.col("id") % 7)
    rows = spark.range(40_000).select(F.concat(F.lit("s"), F.col("id") % 20_000).alias("externalId"), at.alias("timestamp"), F.col("id").cast("double").alias("value"))
    numbers = points.dictionary(rows)
    index = {r.externalId: r["index"] for r in numbers.collect()}
    assert sorted(index.values()) == list(range(20_000)) and index == {r.externalId: r["index"] for r in points.dictionary(rows.repartition(3)).collect()}
    got = {r.timestamp.timestamp() % 7: dict(zip(r.indices, r["values"])) for r in points.wide_sparse(rows, numbers).collect()}
    want = {}
    for r in rows.collect():
        row = want.setdefault(r.timestamp.timestamp() % 7, {})
        row[index[r.externalId]] = max(r.value, row.get(index[r.externalId], r.value))
    assert got == want


def test_wide_frames_look_at_each_point_once(spark):
    rows = spark.createDataFrame([("a", 1, 1.0), ("a", 1, 2.0), ("b", 2, 3.0), ("c", 3, 4.0), (None, 4, 5.0)], "externalId string, timestamp int, value double")
    wide = points.wide(rows, ["b", "a", "none"])
    assert sorted(map(tuple, wide.collect())) == [(1, None, 2.0, None), (2, 3.0, None, None), (3, None, None, None), (4, None, None, None)]
    assert "pivotfirst" in wide._jdf.queryExecution().executedPlan().toString().lower()


@pytest.mark.parametrize("kind", ["long", "int", "double", "date", "timestamp", "timestamp_ntz"])
def test_batches_cover_a_table_once_and_in_order(spark, tmp_path, kind):
    value = {"long": "id % 900", "int": "cast(id % 900 as int)", "double": "if(id % 50 = 0, double('NaN'), id / 7)", "date": "date_add(date'2024-01-01', cast(id % 300 as int))"}
    values = value.get(kind, f"cast(timestamp_seconds(id * 100 % 77700) as {kind})")
    spark.sql(f"SELECT id, if(id % 97 = 0, null, {values}) AS v FROM range(3000)").write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    parts = [[(r.id, r.v) for r in part.collect()] for part in scan.in_batches(table, "v", 400)]
    assert sorted(i for part in parts for i, _ in part) == list(range(3000))
    known = [[v for _, v in part if v is not None and v == v] for part in parts]
    assert all(max(a) < min(b) for a, b in zip(known, known[1:])) and all(200 <= len(k) <= 600 for k in known[:-1])
    plan = list(scan.in_batches(table, "v", 400))[1]._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(v" in plan and "LessThanOrEqual(v" in plan


def test_batches_of_ties_and_of_nothing(spark):
    same = spark.range(500).select(F.lit(3).alias("v"))
    assert [part.count() for part in scan.in_batches(same, "v", 10)] == [500]
    none = same.withColumn("v", F.lit(None).cast("int"))
    assert [part.count() for part in scan.in_batches(none, "v", 10)] == [500]
    assert [part.count() for part in scan.in_batches(same.limit(0), "v", 10)] == [0]
    with pytest.raises(TypeError):
        list(scan.in_batches(same.select(F.lit("x").alias("v")), "v", 10))


@pytest.mark.parametrize("kind", ["long", "double", "date", "timestamp"])
def test_numbered_batches_are_those_taken_one_by_one(spark, tmp_path, kind):
    value = {"long": "9007199254740993 + id % 900", "double": "if(id % 50 = 0, double('NaN'), id / 7)", "date": "date_add(date'2024-01-01', cast(id % 300 as int))"}
    values = value.get(kind, "timestamp_micros(1700000000000000 + id * 7 % 2500)")
    spark.sql(f"SELECT id, if(id % 97 = 0, null, {values}) AS v FROM range(3000)").write.parquet(str(tmp_path / "t"))
    batches = scan.in_batches(spark.read.parquet(str(tmp_path / "t")), "v", 400)
    singly = {r.id: k for k, part in enumerate(batches) for r in part.collect()}
    assert len(singly) == 3000 and {r.id: r.batch for r in batches.numbered("batch").collect()} == singly
    empty = scan.in_batches(spark.range(0).select("id", F.col("id").alias("v")), "v", 400).numbered("batch")
    assert empty.columns == ["id", "v", "batch"] and empty.count() == 0


def test_small_batches_of_a_large_table_are_even(spark):
    """A sketch of the whole table alone is off by more rows than such a batch has."""
    table = spark.range(1_000_000).select((F.col("id") * 7919 % 1_000_003).alias("v"))
    sizes = [r["count"] for r in scan.in_batches(table, "v", 100).numbered("b").groupBy("b").count().collect()]
    assert sum(sizes) == 1_000_000 and 50 <= min(sizes) and max(sizes) <= 100


def test_rows_are_numbered_within_cells(spark, monkeypatch):
    monkeypatch.setattr(scan, "CELL", 100)
    rows = spark.range(3001).select("id", F.when(F.col("id") % 50 > 0, F.col("id") * 7919 % 1500).alias("v"))
    numbered = scan.row_numbers(rows, "v", "row", "id")
    expected = sorted(((-1 if r.v is None else r.v), r.id) for r in rows.collect())
    assert [(-1 if r.v is None else r.v, r.id) for r in numbered.orderBy("row").collect()] == expected
    assert sorted(r.row for r in numbered.collect()) == list(range(1, 3002))
    assert scan.row_numbers(rows.limit(0), "v", "row").count() == 0
    assert {r.row for r in scan.row_numbers(rows.where("v is null"), "v", "row").collect()} == set(range(1, 62))


@pytest.mark.parametrize("rows", [5, 12, 100, 144])
def test_tiles_are_those_of_ntile(spark, rows):
    table = spark.range(rows).select((F.col("id") + 1).alias("row"))
    tiles = table.select(_tile(F.col("row"), rows, 12).alias("mine"), F.ntile(12).over(Window.orderBy("row")).alias("theirs"))
    assert tiles.where("mine = theirs").count() == rows


def test_rows_are_counted_before_they_are_routed(spark, sf_dir):
    changes = domain.instances(spark, sf_dir)
    counts = instances.route_counts(changes, domain.VIEWS)
    deleted = F.col("deletedTime").isNotNull()
    plain = instances.routed(changes, domain.VIEWS).groupBy("table_name").agg(F.count_if(~deleted), F.count_if(deleted))
    assert sorted(tuples(counts)) == sorted(tuples(plain))
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode") < plan.index("count_if" if "count_if" in plan else "count(")
