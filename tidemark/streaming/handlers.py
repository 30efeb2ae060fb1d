"""What each feed does with a micro-batch."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import events as event_ops
from tidemark.operators import instances as graph
from tidemark.operators import points as point_ops
from tidemark.operators import raw as raw_ops
from tidemark.operators import series as series_ops
from tidemark.plans.audit import RunLog

Handler = Callable[[DataFrame, int], None]


@contextmanager
def kept(df: DataFrame) -> Iterator[DataFrame]:
    """Hold rows that several writes read; they spill to disk and are recomputed if lost."""
    held = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield held
    finally:
        held.unpersist()


def _writer(batch: DataFrame, name: str) -> str:
    """The name batch ids count under: a new checkpoint starts counting anew, so it is part of it."""
    query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"{name}/{query}" if query else name


def points_handler(table, name: str, log: RunLog | None = None) -> Handler:
    """Unnest a points feed and add it."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        count = table.add(point_ops.explode_feed(batch), (_writer(batch, name), batch_id))
        if log:
            log.success(name, count, "points written")

    return apply


def series_seen(feed: DataFrame, series: DataFrame, assets: DataFrame) -> DataFrame:
    """The stored rows of series that a points feed names for the first time, as a stream of their own.

    Which ids have been seen is the stream's state, one entry an id, so a micro-batch costs its own ids and
    not what is stored; a repeated micro-batch starts from the state before it and finds the same ones.  Ids
    whose metadata is not there yet, or not complete, do not enter the state: a later record finds them.
    """
    rows = series_ops.series_rows(series, assets)
    ids = feed.select(F.col("external_id").alias("externalId")).join(rows.select("externalId"), "externalId", "left_semi")
    return ids.dropDuplicates(["externalId"]).join(rows, "externalId")


def adding_handler(table, name: str) -> Handler:
    """Add every micro-batch as it is."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        table.add(batch, (_writer(batch, name), batch_id))

    return apply


def events_handler(table, name: str, log: RunLog | None = None) -> Handler:
    """Append events with their metadata as JSON, each micro-batch exactly once."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        count = table.add(event_ops.metadata_as_json(batch), (_writer(batch, name), batch_id))
        if log and count:
            log.success(name, count, "events written to the table")

    return apply


def raw_handler(
    table, name: str, columns: Sequence[str] | None = None, log: RunLog | None = None
) -> Handler:
    """Promote the columns of RAW rows and add them under their key, latest update last."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        count = table.add(raw_ops.flatten_rows(batch, columns), (_writer(batch, name), batch_id))
        if log:
            log.success(name, count, "rows written to the table")

    return apply


def instances_handler(
    open_named: Callable[[str], object],
    space: str,
    views: Sequence[graph.View],
    name: str,
    log: RunLog | None = None,
) -> Handler:
    """Add one batch of instance changes to every table it concerns.

    ``open_named`` returns the table of a given name.  One count over the batch tells which tables
    have anything to do; it has at most a row per view.  Nodes come before edges.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        writer = _writer(batch, name)
        wanted = [c for c in batch.columns if c in graph.READ]
        with kept(batch.where(F.col("space") == space).select(*wanted)) as changes:
            counts = {r["table_name"]: r for r in graph.route_counts(changes, views).collect()}
            for table_name, flatten in graph.flows(space, views).items():
                if table_name in counts:
                    open_named(table_name).add(flatten(changes), (writer, batch_id))
            if log:
                log.success(name, sum(r["upserts"] for t, r in counts.items() if t), "instances written")
                lost = counts.get(None)
                if lost:
                    log.success(name, lost["upserts"] + lost["deletes"], "instances without a view left out")

    return apply
