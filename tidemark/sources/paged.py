"""A change feed paged by cursor, as a streaming data source.

The feed hands out pages per partition: ask with a cursor, get what follows it and a new cursor.  Here pages
land as ``partition=<n>/page=<name>`` folders of Parquet files, whose names sort in the feed's order, and a
cursor is the name of the last page taken.  The offsets of a stream are these cursors, one for each
partition, so Spark's checkpoint holds them and moves them once a micro-batch is written.  A micro-batch
takes at most so many pages of a partition.  A cursor whose page is gone is unknown to the feed, and that
partition starts over from the oldest page there is, as upserts do no harm when they come again.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.dataset as ds
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.session import ship_package

FORMAT = "tidemark_pages"
PAGES = 10


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path as Spark writes it, and the path there."""
    if not re.match(r"\w+:", path):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))


class Pages:
    """The pages of a feed's folder."""

    def __init__(self, path: str) -> None:
        self.files, self.root = file_system(path.rstrip("/"))

    def _names(self, folder: str, prefix: str) -> list[str]:
        found = self.files.get_file_info(fs.FileSelector(folder, allow_not_found=True))
        return sorted(f.base_name.removeprefix(prefix) for f in found if f.base_name.startswith(prefix))

    def partitions(self) -> list[str]:
        return self._names(self.root, "partition=")

    def names(self, partition: str) -> list[str]:
        return self._names(f"{self.root}/partition={partition}", "page=")

    def after(self, partition: str, cursor: str) -> list[str]:
        """The pages that follow a cursor; all of them where the feed does not know it."""
        names = self.names(partition)
        return names[names.index(cursor) + 1:] if cursor in names else names

    def between(self, partition: str, start: str, end: str) -> list[str]:
        """The pages after a cursor up to another; none where the feed no longer knows that one."""
        names = self.after(partition, start)
        return names[: names.index(end) + 1] if end in names else []

    def note(self, name: str) -> str | None:
        """A small text beside the partitions."""
        path = f"{self.root}/{name}"
        if self.files.get_file_info(path).type == fs.FileType.NotFound:
            return None
        with self.files.open_input_stream(path) as stream:
            return stream.read().decode()

    def read(self, partition: str, name: str) -> Iterator[pa.RecordBatch]:
        page = ds.dataset(f"{self.root}/partition={partition}/page={name}", filesystem=self.files, format="parquet")
        yield from page.to_batches()


class Page(InputPartition):
    def __init__(self, partition: str, name: str) -> None:
        super().__init__((partition, name))


class PagedReader(DataSourceStreamReader):
    """Offsets are {partition: cursor}; ``end`` of the last planned batch is where the next one starts."""

    def __init__(self, options: dict[str, str], schema: T.StructType) -> None:
        self.pages, self.schema = Pages(options["path"]), schema
        self.limit = int(options.get("pages", PAGES))
        self.followed = json.loads(options.get("partitions", "null"))
        self.position: dict[str, str] | None = None

    def _followed(self) -> list[str]:
        return self.pages.partitions() if self.followed is None else [str(p) for p in self.followed]

    def initialOffset(self) -> dict:
        return {p: "" for p in self._followed()}

    def latestOffset(self) -> dict:
        if self.position is None:
            self.position = self.initialOffset()
        end = dict(self.position)
        for p in self._followed():
            taken = self.pages.after(p, end.get(p, ""))[: self.limit]
            if taken:
                end[p] = taken[-1]
        return end

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        self.position = end  # also how Spark tells a restarted reader where it was
        wanted = {p: cursor for p, cursor in end.items() if cursor != start.get(p, "")}
        return [Page(p, name) for p, cursor in wanted.items() for name in self.pages.between(p, start.get(p, ""), cursor)]

    def read(self, partition: Page) -> Iterator[pa.RecordBatch]:
        wanted = to_arrow_schema(self.schema)
        for batch in self.pages.read(*partition.value):
            missing = [n for n in wanted.names if n not in batch.schema.names]
            table = pa.Table.from_batches([batch])
            for name in missing:
                table = table.append_column(name, pa.nulls(batch.num_rows, wanted.field(name).type))
            yield from table.select(wanted.names).cast(wanted).to_batches()


SNAPSHOT, CHANGES = "snapshot", "changes"


class HandoverReader(PagedReader):
    """A snapshot and then the changes after it, as one stream whose offsets tell the phase it is in.

    The feed has the two as partitions.  Once its snapshot is complete, ``_handover`` holds the cursor of the
    last change that the snapshot includes.  No change is taken before the snapshot's last page, and the first
    one taken follows that cursor, so a stream stopped anywhere goes on where it was, between the phases too.
    A cursor of the changes that the feed no longer knows means that changes may be lost: the stream goes
    back to the snapshot, whose rows then come again.
    """

    def initialOffset(self) -> dict:
        return {"phase": SNAPSHOT, SNAPSHOT: ""}

    def latestOffset(self) -> dict:
        at = self.position = self.position or self.initialOffset()
        if at["phase"] == CHANGES:
            known = self.pages.names(CHANGES)
            if at[CHANGES] in known or at[CHANGES] == self.pages.note("_handover"):
                taken = self.pages.after(CHANGES, at[CHANGES])[: self.limit]
                return {**at, CHANGES: taken[-1]} if taken else at
            at = self.initialOffset()
        taken = self.pages.after(SNAPSHOT, at[SNAPSHOT])[: self.limit]
        if taken:
            return {"phase": SNAPSHOT, SNAPSHOT: taken[-1]}
        handover = self.pages.note("_handover")
        return at if handover is None else {"phase": CHANGES, SNAPSHOT: at[SNAPSHOT], CHANGES: handover}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        self.position = end
        phase = end["phase"]
        if start == end or phase not in start and phase == CHANGES:  # the step between the phases has no rows
            return []
        since = start[phase] if start["phase"] == phase else ""
        return [Page(phase, name) for name in self.pages.between(phase, since, end[phase])]


class PagedFeed(DataSource):
    """Options: ``path``, ``schema`` (JSON), ``pages`` (of a partition in a micro-batch), ``partitions`` (JSON list), ``handover``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.options["schema"]))

    def streamReader(self, schema: T.StructType) -> PagedReader:
        kind = HandoverReader if self.options.get("handover") == "true" else PagedReader
        return kind(dict(self.options), schema)


def paged_feed(
    spark: SparkSession, path: str, schema: T.StructType, pages: int = PAGES, partitions: Sequence[int] | None = None,
    handover: bool = False,
) -> DataFrame:
    """The feed as a stream of at most ``pages`` pages of each partition at a time, of all partitions or some.

    With ``handover`` it is a snapshot followed by the changes after it (see ``HandoverReader``).
    """
    ship_package(spark)
    spark.dataSource.register(PagedFeed)
    reader = spark.readStream.format(FORMAT).option("schema", schema.json()).option("pages", pages)
    if handover:
        reader = reader.option("handover", "true")
    if partitions is not None:
        reader = reader.option("partitions", json.dumps(list(partitions)))
    return reader.load(path)
