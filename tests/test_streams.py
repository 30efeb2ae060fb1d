"""Streams with state, streams that stop themselves, what streams report, and the pools they run in."""

from __future__ import annotations

import threading
import time

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from benchsuite import QUERIES, domain
from tidemark import schemas
from tidemark.plans.config import SERIES
from tidemark.session import in_pool
from tidemark.sources import Table
from tidemark.sources.feeds import stream_feed
from tidemark.sources.paged import paged_feed
from tidemark.streaming.handlers import adding_handler, series_seen
from tidemark.streaming.progress import Progress, counted
from tidemark.streaming.run import drain, poll_until, start

METADATA = (
    "externalId string, name string, description string, isString boolean, isStep boolean, unit string, "
    "metadata map<string,string>, assetId long"
)


def land(spark, feed, *ids):
    rows = [(i, ([1000], [1.0]), 1) for i in ids]
    spark.createDataFrame(rows, schemas.POINTS_FEED).coalesce(1).write.mode("append").parquet(feed)


def test_series_are_emitted_once(spark, tmp_path):
    feed, checkpoint = str(tmp_path / "feed"), str(tmp_path / "cp")
    emitted = Table(spark, str(tmp_path / "emitted"))
    apply = adding_handler(emitted, "s")
    assets = spark.createDataFrame([], "id long, externalId string")

    def follow(known, handle=apply):
        series = spark.createDataFrame([(i, "n", None, False, False, "u", {}, None) for i in known], METADATA)
        drain(series_seen(stream_feed(spark, feed, schemas.POINTS_FEED), series, assets), handle, checkpoint)

    def killed(batch, batch_id):
        apply(batch, batch_id)
        raise RuntimeError("lost the driver")

    def ids():
        return sorted(r.externalId for r in emitted.read().collect())

    land(spark, feed, "a", "b", "a", None, "late")
    with pytest.raises(StreamingQueryException):
        follow("abc", killed)
    follow("abc")
    assert ids() == ["a", "b"]
    land(spark, feed, "b", "c", "a")
    follow("abc")
    assert ids() == ["a", "b", "c"]
    land(spark, feed, "late", "late", "unknown")  # its metadata came meanwhile
    follow(["a", "b", "c", "late"])
    assert ids() == ["a", "b", "c", "late"]


def test_series_of_a_lost_checkpoint_are_stored_once(spark, tmp_path):
    feed, table = str(tmp_path / "feed"), Table(spark, str(tmp_path / "series"), SERIES)
    series = spark.createDataFrame([("a", "n", None, False, False, "u", {}, None)], METADATA)
    assets = spark.createDataFrame([], "id long, externalId string")
    land(spark, feed, "a")
    for k in range(2):
        drain(series_seen(stream_feed(spark, feed, schemas.POINTS_FEED), series, assets), adding_handler(table, "s"), str(tmp_path / f"cp{k}"))
    assert table.read().count() == 1


def pages(spark, path, values):
    for k, value in enumerate(values):
        spark.createDataFrame([(value,)], "at long").coalesce(1).write.parquet(f"{path}/partition=0/page={k:03d}")
    return paged_feed(spark, path, spark.createDataFrame([], "at long").schema, pages=1)


def test_polling_stops_where_the_run_began_and_goes_on_next_time(spark, tmp_path):
    feed, table = pages(spark, str(tmp_path / "feed"), [1, 5, 9, 12, 20]), Table(spark, str(tmp_path / "t"))
    apply, checkpoint = adding_handler(table, "t"), str(tmp_path / "cp")
    poll_until(feed, apply, checkpoint, "at", 9, 0)
    assert sorted(r["at"] for r in table.read().collect()) == [1, 5, 9]
    poll_until(feed, apply, checkpoint, "at", 15, 0)
    assert sorted(r["at"] for r in table.read().collect()) == [1, 5, 9, 12, 20]


def test_a_failing_poll_raises(spark, tmp_path):
    def fail(batch, batch_id):
        raise RuntimeError("no")

    with pytest.raises(Exception, match="no"):
        poll_until(pages(spark, str(tmp_path / "feed"), [1]), fail, str(tmp_path / "cp"), "at", 9, 0)


def test_progress_counts_a_repeated_batch_once(spark, tmp_path):
    feed, progress = str(tmp_path / "feed"), Progress()
    land(spark, feed, "a", "b")
    table = Table(spark, str(tmp_path / "t"))
    apply = adding_handler(table, "t")

    def killed(batch, batch_id):
        apply(batch, batch_id)
        raise RuntimeError("lost the driver")

    spark.streams.addListener(progress)
    try:
        for handle in (killed, apply, apply):
            query = start(counted(stream_feed(spark, feed, schemas.POINTS_FEED)), handle, str(tmp_path / "cp"), name="p")
            try:
                query.awaitTermination()
            except StreamingQueryException:
                pass
            progress.wait(query)
        assert [tuple(r) for r in progress.frame(spark).collect()] == [("p", 1, 1, 2)]
        with pytest.raises(TimeoutError):
            progress.wait(type("Never", (), {"runId": "x"})(), seconds=0.1)
    finally:
        spark.streams.removeListener(progress)


def test_a_large_feed_does_not_hold_up_a_small_one(spark, tmp_path):
    """Two streams at once: the one with many slow tasks runs longer than the one with few."""
    assert spark.sparkContext.getConf().get("spark.scheduler.mode") == "FAIR"
    ends, pools = {}, {}

    def slow(x):
        time.sleep(0.15)
        return x

    def work(name, tasks):
        def apply(batch, batch_id):
            pools[name] = spark.sparkContext.getLocalProperty("spark.scheduler.pool")
            spark.sparkContext.parallelize(range(tasks), tasks).map(slow).count()
            ends[name] = time.monotonic()

        return apply

    queries = []
    for name, tasks in (("large", 160), ("small", 4)):
        land(spark, str(tmp_path / name), "a")
        with in_pool(spark, name):
            queries.append(start(stream_feed(spark, str(tmp_path / name), schemas.POINTS_FEED), work(name, tasks), str(tmp_path / f"cp-{name}")))
        time.sleep(0.5)  # the large one is well under way
    for query in queries:
        query.awaitTermination()
    assert pools == {"large": "large", "small": "small"}
    assert ends["small"] < ends["large"]
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None and threading.current_thread()


@pytest.mark.parametrize("name, built", [("stream_instances_handover", "edges"), ("stream_replay", "feed")])
def test_what_lands_is_built_once(spark, sf_dir, monkeypatch, name, built):
    passed, build = spark.sparkContext.accumulator(0), getattr(domain, built)
    key = {"edges": "externalId", "feed": "external_id"}[built]

    @F.udf("string")
    def seen(value):
        passed.add(1)
        return value

    monkeypatch.setattr(domain, built, lambda *at: build(*at).withColumn(key, seen(key)))
    QUERIES[name](spark, sf_dir).count()
    assert passed.value == build(spark, sf_dir).count()
