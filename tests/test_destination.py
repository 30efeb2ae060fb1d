"""Batches of a destination appear whole: failed tasks, killed runs, repeats."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from tidemark.sources import Shape, Table, open_table
from tidemark.sources.destination import RECEIPT, StagedTable, StagedWriter, Wrote

DAYS = Shape(keys=("k",), day="at")


@pytest.fixture
def table(spark, tmp_path):
    return open_table(spark, str(tmp_path / "out"), DAYS, "staged")


def rows(spark, n, start=0):
    at = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 40_000)
    return spark.range(start, n).select(F.col("id").cast("string").alias("k"), at.alias("at"), F.array("id").alias("v"))


def held(table):
    return sorted(int(r.k) for r in table.read().collect())


def files(table):
    return {os.path.relpath(os.path.join(d, f), table.path) for d, _, names in os.walk(table.path) for f in names}


def test_counts_come_from_what_tasks_wrote(spark, table):
    assert isinstance(table, StagedTable)
    assert table.add(rows(spark, 20).union(rows(spark, 20)).repartition(6), ("w", 1)) == 20
    assert table.add(rows(spark, 0), ("w", 2)) == 0
    assert held(table) == list(range(20)) and not any("_staged" in f for f in files(table))
    assert open_table(spark, table.path).read().schema == Table(spark, table.path).read().schema == table.read().schema
    plan = table.read("2023-11-20")._jdf.queryExecution().executedPlan().toString()
    assert "tm_day" in plan[plan.index("PartitionFilters"):]
    assert all(r.at.strftime("%Y-%m-%d") >= "2023-11-20" for r in table.read("2023-11-20").collect())


def test_a_failing_task_publishes_nothing(spark, table):
    table.add(rows(spark, 5), ("w", 1))
    before = files(table)
    broken = rows(spark, 40, 5).withColumn("k", F.when(F.col("k") == "33", F.raise_error(F.lit("bad row"))).otherwise(F.col("k")))
    with pytest.raises(Exception, match="bad row"):
        table.add(broken.repartition(8), ("w", 2))
    assert files(table) == before and held(table) == list(range(5))


def test_what_a_killed_run_staged_is_not_read_and_goes_with_the_next(spark, table):
    table.add(rows(spark, 3), ("w", 1))
    left = f"{table.path}/_staged/ww-b2/dead"
    os.makedirs(left)
    rows(spark, 9).write.parquet(f"{left}/x")
    assert held(table) == [0, 1, 2]
    assert table.add(rows(spark, 6, 3), ("w", 2)) == 3
    assert held(table) == list(range(6)) and not os.path.exists(f"{table.path}/_staged/ww-b2")


def test_a_repeated_batch_replaces_itself(spark, table):
    table.add(rows(spark, 9), ("w", 1))
    assert table.add(rows(spark, 4), ("w", 1)) == 4
    assert held(table) == [0, 1, 2, 3]


def test_a_commit_drops_what_failed_attempts_wrote(tmp_path):
    stage = tmp_path / "out" / "_staged" / "b" / "run"
    stage.mkdir(parents=True)
    for name in ("part-0", "part-0-failed", "part-1"):
        (stage / name).write_text("x")
    writer = StagedWriter({"path": str(tmp_path / "out" / "batch"), "staged": str(stage.parent), "run": "run"})
    writer.commit([Wrote([str(stage / "part-0")], 3), None, Wrote([str(stage / "part-1")], 4)])
    assert sorted(p.name for p in (tmp_path / "out" / "batch").iterdir()) == [RECEIPT, "part-0", "part-1"]
    assert (tmp_path / "out" / "batch" / RECEIPT).read_text() == '{"rows": 7, "files": 2}'


def test_an_aborted_run_leaves_nothing(tmp_path):
    stage = tmp_path / "s" / "run"
    stage.mkdir(parents=True)
    writer = StagedWriter({"path": str(tmp_path / "batch"), "staged": str(stage.parent), "run": "run"})
    writer.abort([])
    writer.abort([])
    assert not stage.exists() and not (tmp_path / "batch").exists()
