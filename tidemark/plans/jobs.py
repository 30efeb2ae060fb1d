"""The entry points.  Lake-bound jobs replicate feeds, export jobs replicate lake tables.

Every incremental job reads its upper bound before it copies anything: rows are taken from
``(watermark, bound]``, written, and only then does the bound become the watermark.  Rows that
arrive meanwhile are above the bound and wait for the next run.

A run has a number, one more than that of the last run that set its pipeline's states, and its batches
are named after it.  Setting the states ends the run, in one step; whatever stops it before then leaves
batches that no state rests on, which the next run reads as if they were not there, and replaces.
"""

from __future__ import annotations

import time
from collections.abc import Iterable
from contextlib import nullcontext

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import events as event_ops
from tidemark.operators import files as file_ops
from tidemark.operators import instances as graph
from tidemark.operators import points as point_ops
from tidemark.operators import raw as raw_ops
from tidemark.operators import scan
from tidemark.operators import series as series_ops
from tidemark.operators import watermark as marks
from tidemark.plans import config
from tidemark.plans.audit import RunLog
from tidemark.plans.config import Destination, EventFeed, RawExport, RawFeed, Space, Subscription
from tidemark.plans.state import Watermarks
from tidemark.session import apply_settings, in_pool
from tidemark.sources.feeds import stream_feed
from tidemark.sources.paged import paged_feed
from tidemark.sources.tables import Shape, Table, open_table
from tidemark.streaming.handlers import adding_handler, events_handler, kept, points_handler, raw_handler, series_seen
from tidemark.streaming.run import catch_up, start

EVENT_STATE = "event_state"


class Jobs:
    """The jobs of one deployment: a session, its state and log tables, a table format."""

    def __init__(self, spark: SparkSession, home: str, fmt: str = "parquet") -> None:
        self.spark, self.home, self.fmt = apply_settings(spark), home.rstrip("/"), fmt
        self.states = Watermarks(spark, f"{self.home}/watermarks")
        self.log = RunLog(spark, f"{self.home}/run_log")

    def table(self, path: str, shape: Shape | None = None):
        return open_table(self.spark, path, shape, self.fmt)

    def destination(self, path: str, shape: Shape | None = None):
        """A table that exports write to: its batches appear whole."""
        return open_table(self.spark, path, shape, "staged" if self.fmt == "parquet" else self.fmt)

    # ---- feeds into the lake -----------------------------------------------------------------

    def replicate_points(
        self,
        subscriptions: Iterable[Subscription],
        series: DataFrame,
        assets: DataFrame,
        poll_seconds: float | None = None,
    ) -> list:
        """Stream each subscription's feed into its points and series tables, all at once.

        Points and series are two streams over the feed, each with a checkpoint.  A subscription's streams
        have a scheduler pool of their own, so a large one does not hold up the others.
        """
        queries = []
        for sub in subscriptions:
            named = f"{self.home}/checkpoints/{sub.external_id}"
            into = points_handler(self.table(sub.points_table, config.POINTS), sub.external_id, self.log)
            seen = adding_handler(self.table(sub.series_table, config.SERIES), sub.external_id)
            poll = 0 if sub.pages and poll_seconds is None else poll_seconds
            with in_pool(self.spark, sub.external_id):
                queries.append((sub, start(self._feed(sub), into, named, poll)))
                queries.append((sub, start(series_seen(self._feed(sub), series, assets), seen, f"{named}-series", poll)))
        if poll_seconds is None:
            for sub, query in queries:
                catch_up(query) if sub.pages else query.awaitTermination()
        return [query for _, query in queries]

    def _feed(self, sub: Subscription) -> DataFrame:
        schema = schemas.points_feed(sub.value_type)
        if sub.pages:
            return paged_feed(self.spark, sub.feed, schema, sub.pages, sub.partitions)
        return stream_feed(
            self.spark, sub.feed, schema, max_files=sub.max_files, max_bytes=sub.max_bytes, partitions=sub.partitions
        )

    def replicate_events(self, events: DataFrame, feed: EventFeed) -> int:
        """Append the events created since the last run."""
        table = self.table(feed.table)
        with self.log.watching(EVENT_STATE):
            last = self.states.get(EVENT_STATE, "high")
            rows = scan.events_since(events, int(last) if last else None, feed.data_set)
            bound, count = _bound(rows, "createdTime")
            if not count:
                self.log.seen(EVENT_STATE)
                return 0
            rows = scan.since(rows, "createdTime", up_to=bound)
            batch = self.states.run(EVENT_STATE)
            count = table.add(event_ops.metadata_as_json(rows), batch)
            self.states.set_value(EVENT_STATE, bound, "high", batch)
            self.log.success(EVENT_STATE, count, "events written to the table")
        return count

    def stream_events(self, landing: str, schema, feed: EventFeed, poll_seconds: float | None = None):
        """The streaming form of ``replicate_events`` over landed files."""
        events = stream_feed(self.spark, landing, schema)
        events = events.where(F.col("dataSet") == feed.data_set)
        apply = events_handler(self.table(feed.table), EVENT_STATE, self.log)
        query = start(events, apply, f"{self.home}/checkpoints/{EVENT_STATE}", poll_seconds)
        if poll_seconds is None:
            query.awaitTermination()
        return query

    def replicate_raw(self, rows: DataFrame, feed: RawFeed) -> int:
        """Add the RAW rows updated since the last run under their key."""
        table = self.table(feed.table, config.RAW_ROWS)
        with self.log.watching(feed.state_id):
            last = self.states.get(feed.state_id)
            fresh = scan.since(rows, "last_updated_time", last)
            bound, count = _bound(fresh, "last_updated_time")
            if not count:
                return 0
            if bound is not None:
                within = scan.since(fresh, "last_updated_time", up_to=bound)
                # the first run also takes rows without a time; no later run could
                fresh = within if last else within.unionByName(fresh.where(F.col("last_updated_time").isNull()))
            batch = self.states.run(feed.state_id)
            count = table.add(raw_ops.flatten_rows(fresh, feed.columns), batch)
            self.states.set_values({feed.state_id: bound}, "low", batch)
            self.log.success(feed.state_id, count, "rows written to the table")
        return count

    def stream_raw(self, landing: str, schema, feed: RawFeed, poll_seconds: float | None = None):
        rows = stream_feed(self.spark, landing, schema)
        apply = raw_handler(self.table(feed.table, config.RAW_ROWS), feed.state_id, feed.columns, self.log)
        query = start(rows, apply, f"{self.home}/checkpoints/{feed.state_id}", poll_seconds)
        if poll_seconds is None:
            query.awaitTermination()
        return query

    def replicate_instances(
        self, space: Space, changes: DataFrame, snapshot: DataFrame | None = None, run_start: int | None = None
    ) -> None:
        """Bring every view table of a space, and its edge table, up to date.

        A flow without a watermark takes the snapshot and starts from its newest change (from the
        change feed's beginning when none is given); later runs follow the feed up to their start, now
        unless ``run_start`` (epoch milliseconds) tells another.  A watermark never moves back.  The changes of a later run are read once and held for all tables.
        """
        run_start = int(time.time() * 1000) if run_start is None else run_start
        flows = graph.flows(space.space, space.views)
        state_ids = {name: f"state_{space.space}_{name}" for name in flows}
        stored = self.states.get_all(list(state_ids.values()), "high")
        last = {name: None if stored[s] is None else int(stored[s]) for name, s in state_ids.items()}
        fresh = [name for name in flows if last[name] is None and snapshot is not None]
        follow = [name for name in flows if name not in fresh]
        owner, number = self.states.run(f"state_{space.space}")
        reached, entries = {}, []

        def load(rows: DataFrame, names: list[str], lowest: int | None) -> None:
            # a first load is read per table, as little of it as each needs, rather than held
            rows = scan.since(rows, "lastUpdatedTime", lowest)
            with nullcontext(rows) if lowest is None else kept(rows) as held:
                bound, _ = _bound(held, "lastUpdatedTime")
                for name in names:
                    state_id = state_ids[name]
                    with self.log.watching(state_id):
                        if bound is None or (last[name] is not None and int(bound) <= last[name]):
                            entries.append((state_id, "seen", None, ""))
                            continue
                        flat = flows[name](scan.since(held, "lastUpdatedTime", last[name]))
                        count = self.table(f"{space.tables}/{name}", config.INSTANCES).add(flat, (state_id, number))
                        reached[state_id] = bound
                        entries.append((state_id, "success", count, f"{count} instances written"))

        if fresh:
            load(snapshot, fresh, None)
        if follow:
            known = [last[name] for name in follow]
            load(graph.changes_since(changes, None, run_start), follow, None if None in known else min(known))
        if reached:
            self.states.set_values(reached, "high", (owner, number))
        self.log.write_all(entries)

    # ---- lake tables out ---------------------------------------------------------------------

    def export_points(self, points: DataFrame | Table, path: str, to: Destination) -> int:
        """Add each series' points newer than its watermark under the prefixed id.

        Of a ``Table`` only the batches are read that came after those of the last run: what earlier ones
        hold has been taken, or is at or below the watermark of its series.  Which batches those are is
        kept with the watermarks.

        One pass over the points writes them; what was written then tells which series the
        destination lacks and how far each series came.  One watermark per series, at the end, so a
        run that stops before it is repeated whole.
        """
        with self.log.watching(path):
            states, batches = self.states.frame(path), {}
            if not isinstance(points, DataFrame):
                points, batches = self._new_batches(points, path)
            fresh = scan.series_since(points, marks.series_bounds(states, path))
            target = self.destination(f"{to.tables}/points", config.OUT_POINTS)
            batch = self.states.run(path)
            count = target.add(point_ops.prefix_ids(fresh, to.series_prefix), batch)
            if not count:
                self.log.seen(path)
                return 0
            written = target.read_batch(batch)
            latest = written.groupBy("externalId").agg(F.max("timestamp").alias("timestamp"))
            with kept(latest) as latest:
                series = self.destination(f"{to.tables}/series", config.SERIES)
                known = series.read(without=batch) if series.exists() else self._empty("externalId string")
                series.add(series_ops.missing_series(latest, known, to.data_set_id), batch)
                own = F.substr("externalId", F.lit(len(to.series_prefix) + 1))
                reached = marks.series_watermark(latest.withColumn("externalId", own), path)
                self.states.set(reached.unionByName(self.states.rows(batches, "high")), batch)
            self.log.success(path, count, "points inserted")
            return count

    def export_events(
        self,
        events: DataFrame,
        path: str,
        to: Destination,
        assets: DataFrame,
        incremental_field: str | None = None,
        strict: bool = False,
    ) -> int:
        """Add the lake's new events under their external id, asset references resolved.

        A reference to an unknown asset is skipped, or with ``strict`` fails the run, all of them
        listed in the table ``unknown_assets`` of the destination.
        """
        state_id = f"{path}-state"
        with self.log.watching(path):
            fresh, bound = self._fresh(events, incremental_field, state_id)
            batch = self.states.run(state_id)
            shaped = event_ops.event_rows(fresh, to.data_set_id, incremental_field or "startTime")
            if strict:
                misses = self.destination(f"{to.tables}/unknown_assets")
                unknown = misses.add(event_ops.unknown_assets(shaped, assets), batch)
                if unknown:
                    raise LookupError(f"{unknown} references to assets that do not exist, see {misses.path}")
            rows = event_ops.resolve_assets(shaped, assets)
            target = self.destination(f"{to.tables}/events", config.OUT_EVENTS)
            count = target.add(rows, batch)
            if not count:
                self.log.seen(path)
                return 0
            self.states.set_values({state_id: bound}, "low", batch)
            self.log.success(path, count, "events inserted")
            return count

    def export_raw(self, df: DataFrame, spec: RawExport, to: Destination) -> int:
        """Add the table's new rows as RAW rows under their key."""
        with self.log.watching(spec.state_id):
            fresh, bound = self._fresh(df, spec.incremental_field, spec.state_id)
            rows = raw_ops.export_rows(fresh, spec.key_fields, spec.md5_key)
            target = self.destination(f"{to.tables}/{spec.db_name}/{spec.table_name}", spec.shape)
            batch = self.states.run(spec.state_id)
            count = target.add(rows, batch)
            if not count:
                self.log.seen(spec.state_id)
                return 0
            self.states.set_values({spec.state_id: bound}, "low", batch)
            self.log.success(spec.state_id, count, f"rows inserted to {spec.table_name}")
            return count

    def export_files(self, files: DataFrame, name: str, to: Destination) -> int:
        """Add the catalog rows (the bytes, where given) of new and changed ones of the listed files.

        ``files`` is a listing (path, modificationTime, length[, content]), such as ``list_files``
        makes of a folder or a table of pages holds.
        """
        with self.log.watching(name):
            listing = file_ops.catalog_rows(files, to.data_set_id)
            target = self.destination(f"{to.tables}/files", config.FILES)
            batch = self.states.run(f"files/{name}")
            stored = target.read(without=batch) if target.exists() else self._empty(schemas.FILES)
            state = stored.select("external_id", F.col("source_modified_time").alias("stored_time"))
            count = target.add(file_ops.changed_files(listing, state), batch)
            if count:
                self.states.set_values({}, "low", batch)
                self.log.success(name, count, f"files uploaded from {name}")
            return count

    def _new_batches(self, table: Table, path: str) -> tuple[DataFrame, dict[str, int]]:
        """(the rows of the batches that no run has taken, the states that tell the next run of them)."""
        last = table.batches()
        ids = {writer: marks.batch_state_id(path, writer) for writer in last}
        stored = self.states.get_all(list(ids.values()), "high")
        seen = {writer: int(stored[name]) for writer, name in ids.items() if stored[name] is not None}
        return table.read_new(seen, last), {ids[writer]: number for writer, number in last.items()}

    def _empty(self, schema) -> DataFrame:
        return self.spark.createDataFrame([], schema)

    def _fresh(self, df: DataFrame, field: str | None, state_id: str) -> tuple[DataFrame, object]:
        """(rows of this run, their upper bound); everything without a field."""
        if not field:
            return df, None
        watermark = self.states.get(state_id)
        rows = scan.since(df, field, watermark)
        bound, _ = _bound(rows, field)
        within = rows if bound is None else scan.since(rows, field, up_to=bound)
        if watermark is None and bound is not None:
            # the first run also takes rows without a value; no later run could
            within = within.unionByName(rows.where(F.col(field).isNull()))
        return within, bound

    def space_tables(self, space: Space) -> list[str]:
        """Table paths of a space, its edge table included."""
        return [f"{space.tables}/{name}" for name in graph.flows(space.space, space.views)]


def _bound(df: DataFrame, field: str) -> tuple[str | None, int]:
    """Highest value of the field as watermark text, and the row count, in one pass."""
    top = marks.value_text(F.max(field), df.schema[field].dataType)
    row = df.agg(top.alias("top"), F.count(F.lit(1)).alias("rows")).first()
    return row["top"], row["rows"]
