"""Runs that are killed at any of their steps and repeated, against runs that were not."""

from __future__ import annotations

import itertools
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.plans.audit import RunLog
from tidemark.plans.config import Destination, RawExport
from tidemark.plans.jobs import Jobs
from tidemark.plans.state import Watermarks
from tidemark.sources import Table

STEPS = [(Table, "add"), (Watermarks, "_end"), (RunLog, "write_all")]


class Killed(BaseException):
    """Nothing catches it, as nothing runs after a kill."""


def kill_at(patch, step):
    """The process ends after the step-th write of whatever kind; returns how many there were."""
    count = itertools.count()
    for owner, name in STEPS:

        def run(*args, _call=getattr(owner, name), **more):
            out = _call(*args, **more)
            if next(count) == step:
                raise Killed
            return out

        patch.setattr(owner, name, run)
    return count


def points(spark, n):
    begin = datetime(2024, 1, 1)
    data = [(f"s{i % 2}", begin + timedelta(hours=7 * i), float(i)) for i in range(n)]
    return spark.createDataFrame(data, "externalId string, timestamp timestamp, value double")


def export_points(spark, job, to, n):
    job.export_points(points(spark, n).where(F.col("externalId") != ("s1" if n < 6 else "")), "p", to)


def export_events(spark, job, to, n):
    events = spark.range(n).select(
        F.concat(F.lit("e"), "id").alias("externalId"), F.col("id").alias("startTime"), F.array(F.lit("a")).alias("assetExternalIds")
    )
    job.export_events(events, "ev", to, spark.createDataFrame([(1, "a")], "id long, externalId string"), "startTime")


def export_raw(spark, job, to, n):
    rows = spark.range(n).select(F.col("id").alias("k"), F.col("id").alias("at"))
    job.export_raw(rows, RawExport("db", "t", ("k",), "at"), to)


def export_files(spark, job, to, n):
    at = F.timestamp_seconds(F.lit(1000) + F.when(F.col("id") < 2, n).otherwise(0))  # two of them change each time
    files = spark.range(n).select(F.concat(F.lit("/f/"), "id").alias("path"), at.alias("modificationTime"), F.col("id").alias("length"))
    job.export_files(files, "files", to)


TABLES = {export_points: ["points", "series"], export_events: ["events"], export_raw: ["db/t"], export_files: ["files"]}


def held(job, to, names):
    return {n: Counter(map(str, job.table(f"{to.tables}/{n}").read().collect())) for n in names}


@pytest.mark.parametrize("run", TABLES, ids=lambda f: f.__name__)
def test_a_killed_export_and_its_repeat_equal_one_run(spark, tmp_path, monkeypatch, run):
    def job_of(name):
        return Jobs(spark, str(tmp_path / name / "state")), Destination(str(tmp_path / name / "out"), "x_", 7)

    job, to = job_of("whole")
    run(spark, job, to, 10)
    want = held(job, to, TABLES[run])
    assert all(want.values())
    for step in itertools.count():
        job, to = job_of(f"step{step}")
        with monkeypatch.context() as patch:
            count = kill_at(patch, step)
            try:
                run(spark, job, to, 5)
            except Killed:
                pass
        done = next(count) <= step
        job, to = job_of(f"step{step}")  # another process
        run(spark, job, to, 10)
        assert held(job, to, TABLES[run]) == want, step
        if done:
            break
    assert step >= 3


def test_states_of_a_run_that_was_killed_while_writing_them_do_not_count(spark, tmp_path):
    states = Watermarks(spark, str(tmp_path / "states"))
    states.set_values({"a": 1, "b": 2}, "low", states.run("p"))
    assert states.run("p") == ("p", 2)
    states.set_values({"a": 5}, "low", states.run("p"))
    (tmp_path / "states" / "owner=p" / "run=2" / "_SUCCESS").unlink()
    assert states.run("p") == ("p", 2) and states.get_all(["a", "b"]) == {"a": "1", "b": "2"}
    for n in range(3, 6):
        states.set_values({"b": n}, "low", states.run("p"))
    assert states.get_all(["a", "b"]) == {"a": "1", "b": "5"}
    assert len(list((tmp_path / "states" / "owner=p").glob("run=*"))) == 2
