"""The cursor-paged feed: page limits, restarts, cursors the feed no longer knows."""

from __future__ import annotations

import json
import shutil

import pytest

from tidemark import schemas
from tidemark.plans.config import Subscription
from tidemark.plans.jobs import Jobs
from tidemark.sources.paged import HandoverReader, PagedReader, Pages, paged_feed
from tidemark.streaming.run import catch_up, start


def land(spark, feed, partition, *names):
    """One record to a page; its value is the page's number."""
    for name in names:
        rows = spark.createDataFrame([(f"id{partition}", ([1000 * int(name)], [float(name)]), int(name))], schemas.POINTS_FEED)
        rows.coalesce(1).write.parquet(f"{feed}/partition={partition}/page={name}")


@pytest.fixture
def feed(spark, tmp_path):
    path = str(tmp_path / "feed")
    land(spark, path, 0, *[f"{n:02d}" for n in range(1, 6)])
    land(spark, path, 1, "01")
    return path


def reader(feed, pages=2, **more):
    return PagedReader({"path": feed, "pages": str(pages), **more}, schemas.POINTS_FEED)


def names(parts):
    return [p.value for p in parts]


def test_pages_are_taken_up_to_the_limit(feed):
    r = reader(feed)
    start = r.initialOffset()
    assert start == {"0": "", "1": ""}
    end = r.latestOffset()
    assert end == {"0": "02", "1": "01"}
    assert names(r.partitions(start, end)) == [("0", "01"), ("0", "02"), ("1", "01")]
    assert r.latestOffset() == {"0": "04", "1": "01"}
    rows = [row for p in r.partitions(start, end) for b in r.read(p) for row in b.to_pylist()]
    assert [row["upserts"]["value"] for row in rows] == [[1.0], [2.0], [1.0]]


def test_a_restarted_reader_goes_on_where_spark_says_it_was(feed):
    r = reader(feed)
    assert names(r.partitions({"0": "02", "1": "01"}, {"0": "02", "1": "01"})) == []
    assert r.latestOffset() == {"0": "04", "1": "01"}
    assert names(r.partitions({"0": "02", "1": "01"}, {"0": "04", "1": "01"})) == [("0", "03"), ("0", "04")]


def test_an_unknown_cursor_starts_its_partition_over(spark, feed):
    r = reader(feed, pages=3)
    at = {"0": "04", "1": "01"}
    shutil.rmtree(f"{feed}/partition=0")
    land(spark, feed, 0, "11", "12")
    r.partitions(at, at)
    end = r.latestOffset()
    assert end == {"0": "12", "1": "01"}
    assert names(r.partitions(at, end)) == [("0", "11"), ("0", "12")]
    # a batch that was planned before and whose pages are gone reads nothing, and then starts over
    r = reader(feed, pages=3)
    assert names(r.partitions({"0": "02", "1": ""}, {"0": "04", "1": "01"})) == [("1", "01")]
    assert r.latestOffset() == end


def test_partitions_and_a_feed_that_is_not_there_yet(spark, feed, tmp_path):
    assert reader(feed, partitions=json.dumps([1, 7])).latestOffset() == {"1": "01", "7": ""}
    r = reader(str(tmp_path / "later"))
    assert r.initialOffset() == r.latestOffset() == {}
    assert Pages(f"file:{feed}").partitions() == ["0", "1"]


def test_a_stream_of_pages_with_a_new_partition(spark, feed, tmp_path):
    taken = []

    def follow():
        def apply(batch, batch_id):
            taken.append(sorted((r.external_id, r.cursor) for r in batch.collect()))

        catch_up(start(paged_feed(spark, feed, schemas.POINTS_FEED, pages=2), apply, str(tmp_path / "cp"), 0))

    follow()
    assert taken == [[("id0", 1), ("id0", 2), ("id1", 1)], [("id0", 3), ("id0", 4)], [("id0", 5)]]
    taken.clear()
    land(spark, feed, 2, "01")
    land(spark, feed, 1, "02")
    follow()
    assert taken == [[("id1", 2), ("id2", 1)]]


def test_a_paged_subscription(spark, feed, tmp_path):
    job = Jobs(spark, str(tmp_path / "state"))
    series = spark.createDataFrame([], "externalId string, name string, description string, isString boolean, "
                                   "isStep boolean, unit string, metadata map<string,string>, assetId long")
    sub = Subscription("sub", feed, str(tmp_path / "p"), str(tmp_path / "s"), partitions=(0,), pages=2)
    job.replicate_points([sub], series, spark.createDataFrame([], "id long, externalId string"))
    assert sorted(r.value for r in job.table(sub.points_table).read().collect()) == [1.0, 2.0, 3.0, 4.0, 5.0]
    assert job.log.read().where("status = 'success'").count() == 3


def test_changes_follow_the_snapshot_they_are_not_in(spark, tmp_path):
    feed = str(tmp_path / "feed")
    land(spark, feed, "snapshot", "01", "02", "03")
    land(spark, feed, "changes", "11", "12", "13")
    make = lambda: HandoverReader({"path": feed, "pages": "2"}, schemas.POINTS_FEED)
    r, seen = make(), []

    def step(reader):
        start = reader.position or reader.initialOffset()
        end = reader.latestOffset()
        seen.append(names(reader.partitions(start, end)))
        return end

    assert step(r)["phase"] == "snapshot" and step(r)["snapshot"] == "03"
    assert step(r) == {"phase": "snapshot", "snapshot": "03"}  # not said to be complete yet
    (tmp_path / "feed" / "_handover").write_text("11")
    assert step(r) == {"phase": "changes", "snapshot": "03", "changes": "11"}
    again = make()  # stopped between the phases
    again.partitions(r.position, r.position)
    assert step(again) == {"phase": "changes", "snapshot": "03", "changes": "13"}
    assert seen == [[("snapshot", "01"), ("snapshot", "02")], [("snapshot", "03")], [], [], [("changes", "12"), ("changes", "13")]]
    shutil.rmtree(f"{feed}/partition=changes")  # what came after 13 may be lost: the snapshot is taken again
    land(spark, feed, "changes", "31")
    assert step(again) == {"phase": "snapshot", "snapshot": "02"} and seen[-1] == [("snapshot", "01"), ("snapshot", "02")]
