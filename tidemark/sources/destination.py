"""Destination tables: batches that are staged by tasks and published by one commit.

Tasks write their rows under ``_staged``, which readers do not look at, and tell the commit what they wrote.
The commit drops what failed attempts left, adds a receipt with the counts, and moves the whole folder to
where the batch belongs, in place of what an earlier try of the same batch left there.  So a batch is there
whole or not at all, on file systems that move folders in one step; elsewhere its receipt comes last.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.dataset as ds
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from tidemark.session import ship_package
from tidemark.sources import folders
from tidemark.sources.paged import file_system
from tidemark.sources.tables import BATCH, WRITER, Table

FORMAT = "tidemark_staged"
STAGED, RECEIPT = "_staged", "_receipt"
GROUP_ROWS = 100_000  # of a Parquet row group, at least where there are as many


@dataclass
class Wrote(WriterCommitMessage):
    """What one task staged."""

    files: list[str]
    rows: int


class StagedWriter(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str]) -> None:
        self.files, self.target = file_system(options["path"])
        self.attempts = file_system(options["staged"])[1]  # of this batch, by whichever run
        self.stage = f"{self.attempts}/{options['run']}"
        self.filed = json.loads(options.get("filed", "[]"))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Wrote:
        task, wrote = TaskContext.get(), Wrote([], 0)
        first = next(iterator, None)
        if first is None:
            return wrote

        def batches() -> Iterator[pa.RecordBatch]:
            yield first
            yield from iterator

        def visit(written) -> None:
            wrote.files.append(written.path)
            wrote.rows += written.metadata.num_rows

        by = ds.partitioning(pa.schema([first.schema.field(n) for n in self.filed]), flavor="hive") if self.filed else None
        ds.write_dataset(
            batches(), self.stage, schema=first.schema, filesystem=self.files, format="parquet", partitioning=by,
            basename_template=f"part-{task.partitionId():05d}-{task.taskAttemptId()}-{{i}}.parquet",
            existing_data_behavior="overwrite_or_ignore", min_rows_per_group=GROUP_ROWS, max_rows_per_group=10 * GROUP_ROWS,
            file_visitor=visit,
        )
        return wrote

    def commit(self, messages: list[Wrote | None]) -> None:
        wrote = [m for m in messages if m is not None]
        kept = {name for m in wrote for name in m.files}
        self.files.create_dir(self.stage, recursive=True)
        for found in self.files.get_file_info(fs.FileSelector(self.stage, recursive=True)):
            if found.type == fs.FileType.File and found.path not in kept:
                self.files.delete_file(found.path)
        with self.files.open_output_stream(f"{self.stage}/{RECEIPT}") as out:
            out.write(json.dumps({"rows": sum(m.rows for m in wrote), "files": len(kept)}).encode())
        if self.files.get_file_info(self.target).type != fs.FileType.NotFound:
            self.files.delete_dir(self.target)
        self.files.create_dir(self.target.rsplit("/", 1)[0], recursive=True)
        self.files.move(self.stage, self.target)
        self.files.delete_dir(self.attempts)  # what killed runs staged of the batch

    def abort(self, messages: list[Wrote | None]) -> None:
        if self.files.get_file_info(self.stage).type != fs.FileType.NotFound:
            self.files.delete_dir(self.stage)


class StagedBatches(DataSource):
    """Options: ``path`` (of the batch), ``staged`` (where its tries go), ``run`` (this try), ``filed`` (JSON list of columns)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: T.StructType, overwrite: bool) -> StagedWriter:
        return StagedWriter(dict(self.options))


class StagedTable(Table):
    """A table whose batches appear whole; ``add`` returns the rows its tasks reported to the commit."""

    def _write(self, rows: DataFrame, folder: str, filed: list[str]) -> int:
        ship_package(self.spark)
        self.spark.dataSource.register(StagedBatches)
        name = folder.removeprefix(f"{self.path}/").replace(f"{WRITER}=", "").replace(f"/{BATCH}=", "-")
        writer = rows.write.format(FORMAT).mode("append").option("filed", json.dumps(filed)).option("run", uuid.uuid4().hex)
        writer.option("staged", f"{self.path}/{STAGED}/{name}").save(folder)
        return json.loads(folders.read_text(self.spark, f"{folder}/{RECEIPT}"))["rows"]
