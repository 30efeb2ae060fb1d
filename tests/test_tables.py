"""Tables that are only ever added to: what a batch costs, what repeats change, how rows are read."""

from __future__ import annotations

import inspect
import os
import re
import sys
from collections import Counter
from concurrent.futures import ThreadPoolExecutor
from types import ModuleType
from unittest.mock import MagicMock

import pytest
from pyspark.sql import functions as F

from tidemark.plans import jobs
from tidemark.streaming import handlers
from tidemark.sources import Shape, Table, open_table
from tidemark.sources.tables import GIVEN

KEYED = Shape(keys=("k",))


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def frame(spark, data, schema="k string, v int"):
    return spark.createDataFrame(data, schema)


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "table")


def files(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.startswith("part-")}


def test_the_last_row_of_a_key_counts(spark, path):
    table = Table(spark, path, KEYED)
    assert not table.exists()
    with pytest.raises(FileNotFoundError):
        table.read()
    assert table.add(frame(spark, [("a", 1), ("b", 3), (None, 4)])) == 3
    assert table.add(frame(spark, [("b", 30), ("c", 40), (None, 5)])) == 3
    assert rows(table.read()) == Counter({("a", 1): 1, ("b", 30): 1, ("c", 40): 1, (None, 4): 1, (None, 5): 1})


def test_a_batch_costs_its_own_size(spark, path):
    """One row added to a table of many changes no file that was there."""
    table = Table(spark, path, KEYED)
    table.add(spark.range(5000).select(F.col("id").cast("string").alias("k"), F.lit(0).alias("v")))
    before = {f: os.stat(f).st_mtime_ns for f in files(path)}
    table.add(frame(spark, [("17", 1)]))
    after = files(path)
    assert {f: os.stat(f).st_mtime_ns for f in before} == before
    assert sum(os.path.getsize(f) for f in after - set(before)) < 5000
    assert table.read().where("v = 1").count() == 1 and table.read().count() == 5000


def test_a_repeated_batch_replaces_itself(spark, path):
    table = Table(spark, path)
    table.add(frame(spark, [("a", 1)]), ("w", 0))
    table.add(frame(spark, [("b", 1)]), ("w/x y", "1-2"))
    table.add(frame(spark, [("a", 1), ("c", 1)]), ("w", 0))
    assert rows(table.read()) == Counter({("a", 1): 1, ("b", 1): 1, ("c", 1): 1})
    assert rows(table.read_batch(("w/x y", "1-2"))) == Counter({("b", 1): 1})


def test_writers_at_once_lose_nothing(spark, path):
    table = Table(spark, path)
    with ThreadPoolExecutor(6) as pool:
        list(pool.map(lambda n: Table(spark, path).add(frame(spark, [(str(n), n)]), (f"w{n}", 0)), range(18)))
    assert rows(table.read()) == Counter({(str(n), n): 1 for n in range(18)})


def test_an_order_beats_the_time_of_arrival(spark, path):
    table = Table(spark, path, Shape(keys=("k",), order=("cursor",), hidden=("cursor",)))
    kind = "k string, v int, cursor long"
    table.add(frame(spark, [("a", 1, 9), ("a", 0, 8), ("b", 1, 1)], kind))
    table.add(frame(spark, [("a", 2, 3), ("b", 2, 1)], kind))  # equal cursors: the later arrival
    assert table.read().columns == ["k", "v"] and rows(table.read()) == Counter({("a", 1): 1, ("b", 2): 1})


def test_columns_that_a_write_lacks_keep_what_they_were(spark, path):
    table = Table(spark, path, KEYED)
    table.add(frame(spark, [("a", 1, "x"), ("b", 2, "y"), ("c", 3, "z")], "k string, v int, w string"))
    table.add(frame(spark, [("a", 10), ("d", 40), (None, 7)]))
    table.add(frame(spark, [("b", None, None)], "k string, v int, w string"))
    want = {("a", 10, "x"): 1, ("b", None, None): 1, ("c", 3, "z"): 1, ("d", 40, None): 1, (None, 7, None): 1}
    assert rows(table.read()) == Counter(want)


def test_columns_are_added_and_widened(spark, path):
    table = Table(spark, path)
    table.add(frame(spark, [(1, "a")], "id long, x string"))
    table.add(frame(spark, [(2, 0.5, None)], "id int, y double, z void"))
    assert table.read().columns == ["id", "x", "y"]
    assert rows(table.read()) == Counter({(1, "a", None): 1, (2, None, 0.5): 1})
    with pytest.raises(TypeError, match="id"):
        table.add(frame(spark, [("text",)], "id string"))
    assert table.read().count() == 2


def test_nested_fields_are_added(spark, path):
    table = Table(spark, path)
    table.add(frame(spark, [(1, (1,), [(1,)])], "id int, s struct<a:int>, l array<struct<a:int>>"))
    table.add(frame(spark, [(2, (2, "x"), [(2,)])], "id int, s struct<a:int,b:string>, l array<struct<a:int>>"))
    table.add(frame(spark, [(3, (3,), [(3,)])], "id int, s struct<a:int>, l array<struct<a:int>>"))
    got = {r.id: (r.s.a, r.s.b) for r in table.read().collect()}
    assert got == {1: (1, None), 2: (2, "x"), 3: (3, None)}


HISTORY = Shape(gone=("id", "changed", "deleted"))


@pytest.mark.parametrize("cut", [1, 2, 5])
def test_deletes_remove_what_was_changed_before_them(spark, tmp_path, cut):
    """However the changes are cut into batches."""
    changes = [("o'a", 1, None), ("o'a", 2, 5), ("b", 2, None), ("o'a", 7, None), ("b", 3, None)]
    table = Table(spark, str(tmp_path / str(cut)), HISTORY)
    for lo in range(0, len(changes), cut):
        table.add(frame(spark, changes[lo:lo + cut], "id string, changed long, deleted long"))
    assert rows(table.read()) == Counter({("o'a", 7): 1, ("b", 2): 1, ("b", 3): 1})


def test_days_are_read_from_one_on(spark, path):
    table = Table(spark, path, Shape(keys=("k",), day="at"))
    data = spark.sql("SELECT cast(id AS string) AS k, timestamp '2024-01-01 23:30:00' + make_interval(0, 0, 0, id) AS at FROM range(4)")
    table.add(data)
    assert sorted(r.k for r in table.read("2024-01-03").collect()) == ["2", "3"]
    plan = table.read("2024-01-03")._jdf.queryExecution().executedPlan().toString()
    assert "tm_day" in plan[plan.index("PartitionFilters"):]


def test_a_fold_holds_the_same_in_one_batch(spark, path, tmp_path):
    table = Table(spark, path, Shape(keys=("k",), order=("n",), hidden=("n",)))
    for n in range(4):
        table.add(frame(spark, [("a", n, n), (str(n), n, n)], "k string, v int, n int"))
    folded = table.fold(str(tmp_path / "folded"))
    assert rows(folded.read()) == rows(table.read())
    folded.add(frame(spark, [("a", 9, 1)], "k string, v int, n int"))  # an older row, still
    assert rows(folded.read()) == rows(table.read())


def test_a_table_keeps_its_shape(spark, path):
    Table(spark, path, KEYED).add(frame(spark, [("a", 1)]))
    assert rows(Table(spark, path).read()) == Counter({("a", 1): 1})
    Table(spark, path).add(frame(spark, [("a", 2)]))
    assert rows(Table(spark, path).read()) == Counter({("a", 2): 1})
    with pytest.raises(ValueError, match="not"):
        Table(spark, path, Shape(keys=("v",))).add(frame(spark, [("a", 1)]))


def test_empty_batches(spark, path):
    table = Table(spark, path, KEYED)
    assert table.add(frame(spark, [])) == 0
    assert table.exists() and table.read().count() == 0


@pytest.fixture
def delta(monkeypatch):
    """A stand-in for the Delta package, which is not available here."""
    module, tables = ModuleType("delta"), ModuleType("delta.tables")
    tables.DeltaTable = MagicMock()
    monkeypatch.setitem(sys.modules, "delta", module)
    monkeypatch.setitem(sys.modules, "delta.tables", tables)
    monkeypatch.delitem(sys.modules, "tidemark.sources.delta", raising=False)
    yield tables.DeltaTable
    sys.modules.pop("tidemark.sources.delta", None)


def test_delta_merges_unless_older(spark, path, delta, monkeypatch):
    table = open_table(spark, path, Shape(keys=("k",), order=("n",)), "delta")
    merged = delta.forPath.return_value.alias.return_value.merge.return_value.withSchemaEvolution.return_value
    merged.whenMatchedUpdateAll.return_value.whenNotMatchedInsertAll.return_value.execute.side_effect = (
        lambda: delta.forPath.return_value.alias.return_value.merge.call_args[0][0].collect()
    )
    table.add(frame(spark, [("a", 1), ("a", 2)], "k string, n int"))
    assert delta.forPath.return_value.alias.return_value.merge.call_args[0][1] == "s.`k` = t.`k`"
    assert "s.`n` >= t.`n`" in merged.whenMatchedUpdateAll.call_args[0][0]


def test_both_kinds_of_table_offer_what_jobs_call(delta):
    """Every method and argument that jobs and handlers use of a table, with the same names and defaults."""
    from tidemark.sources.delta import DeltaLakeTable

    sources = [inspect.getsource(m) for m in (jobs, handlers)]
    called = {m for s in sources for m in re.findall(r"\b(?:table|target|series|misses|known|series_table)\.(\w+)\(", s)}
    assert {"add", "read", "read_batch", "exists"} <= called
    for name in called & set(dir(Table)):
        ours, theirs = (inspect.signature(getattr(c, name)) for c in (Table, DeltaLakeTable))
        assert list(ours.parameters) == list(theirs.parameters), name
        assert [p.default for p in ours.parameters.values()] == [p.default for p in theirs.parameters.values()], name


def test_delta_knows_a_repeated_append(spark, path, delta, monkeypatch):
    writer = MagicMock()
    writer.format.return_value = writer.mode.return_value = writer.option.return_value = writer
    writer.save.side_effect = lambda p: written[0].collect()
    written = []
    monkeypatch.setattr(type(spark.range(1)), "write", property(lambda df: written.append(df) or writer))
    assert open_table(spark, path, fmt="delta").add(frame(spark, [("a", 1)]), ("event_state", 3)) == 1
    assert [c.args for c in writer.option.call_args_list] == [("mergeSchema", "true"), ("txnAppId", "event_state"), ("txnVersion", 3)]
    row = written[0].first()
    assert (row.tm_writer, row.tm_batch) == ("event_state", 3)


def test_delta_needs_its_package(spark, path):
    with pytest.raises(ImportError):
        open_table(spark, path, fmt="delta")


def test_whole_rows_are_not_read_as_parts(spark, tmp_path):
    """The table that made the folder goes on adding whole rows: no row lists the columns it was given."""
    table = Table(spark, str(tmp_path / "t"), Shape(keys=("k",)))
    for value in (1, 2):
        table.add(spark.createDataFrame([("a", value)], "k string, v long"))
    assert GIVEN not in table._stored().columns and [tuple(r) for r in table.read().collect()] == [("a", 2)]
    table.add(spark.createDataFrame([("a",)], "k string"))
    assert GIVEN in table._stored().columns and [tuple(r) for r in table.read().collect()] == [("a", 2)]
