"""The run log: what each job saw, wrote or failed on."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import RUN_LOG

STATUSES = ("seen", "success", "failure")
STORED = T.StructType([*RUN_LOG.fields, T.StructField("day", T.DateType())])


class RunLog:
    """Entries filed by day, and within a day by the process that wrote them, so that writers never meet."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self._me, self._lock = uuid.uuid4().hex, threading.Lock()

    def write_all(self, entries: Iterable[tuple[str, str, int | None, str]]) -> None:
        """Append (pipeline, status, rows, message) entries; any number of jobs may do so at once."""
        now = datetime.now(timezone.utc)
        rows = [(pipeline, status, message, count, now) for pipeline, status, count, message in entries]
        if any(status not in STATUSES for _, status, *_ in rows):
            raise ValueError(f"status must be one of {STATUSES}")
        with self._lock:  # streams of one process share its folder
            lines = self.spark.createDataFrame(rows, RUN_LOG).coalesce(1)
            lines.write.mode("append").parquet(f"{self.path}/day={now.date()}/writer=w{self._me}")

    def read(self, since: date | None = None) -> DataFrame:
        """The entries, of a day on or all; other days are not listed beyond their names."""
        entries = self.spark.read.schema(STORED).option("basePath", self.path).parquet(self.path)
        if since:
            entries = entries.where(F.col("day") >= F.lit(since))
        return entries.select(*RUN_LOG.names)

    def write(self, pipeline: str, status: str, rows: int | None = None, message: str = "") -> None:
        self.write_all([(pipeline, status, rows, message)])

    def seen(self, pipeline: str) -> None:
        self.write(pipeline, "seen")

    def success(self, pipeline: str, rows: int, what: str) -> None:
        self.write(pipeline, "success", rows, f"{rows} {what}")

    @contextmanager
    def watching(self, pipeline: str) -> Iterator[None]:
        """Log a failure and let it through."""
        try:
            yield
        except Exception as error:
            self.write(pipeline, "failure", message=f"{type(error).__name__}: {error}")
            raise


def counters(log: DataFrame) -> DataFrame:
    """Per pipeline: runs that wrote, runs that failed, rows written in all."""
    succeeded = F.col("status") == "success"
    return log.groupBy("pipeline").agg(
        F.count_if(succeeded).alias("writes"),
        F.count_if(F.col("status") == "failure").alias("failures"),
        F.coalesce(F.sum(F.when(succeeded, F.col("rows"))), F.lit(0)).alias("rows"),
    )
