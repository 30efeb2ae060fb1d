"""The stored watermarks of all jobs."""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import watermark as marks
from tidemark.schemas import WATERMARKS
from tidemark.sources import folders

HISTORY = T.StructType([*WATERMARKS.fields, T.StructField("seq", T.LongType())])
#: Who sets states that no run sets.
BY_HAND = "by hand"

Batch = tuple[str, int]


class Watermarks:
    """The states of every pipeline as its last run left them; set only after the sinks of a run have committed.

    A run writes all states of its pipeline to ``owner=<pipeline>/run=<number>``, which counts once Spark has
    marked it whole.  So a pipeline's states and the number of its next run change in one step, and the
    batches of a run, named after its number, are either what a state rests on or replaced by the next try.
    Only the last two runs are kept.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    # ---- runs --------------------------------------------------------------------------------

    def _folder(self, owner: str) -> str:
        return f"{self.path}/owner={quote(owner, safe='')}"

    def _whole(self, folder: str) -> list[int]:
        runs = [int(n.removeprefix("run=")) for n in folders.names(self.spark, folder) if n.startswith("run=")]
        return sorted(n for n in runs if folders.exists(self.spark, f"{folder}/run={n}/_SUCCESS"))

    def run(self, owner: str) -> Batch:
        """(owner, number) of the run that comes next: one more than the last that set its states."""
        return owner, max(self._whole(self._folder(owner)), default=0) + 1

    # ---- reading -----------------------------------------------------------------------------

    def _history(self, owners: Sequence[str] | None = None) -> DataFrame:
        if owners is None:
            all_of = [f"{self.path}/{n}" for n in folders.names(self.spark, self.path) if n.startswith("owner=")]
        else:
            all_of = [self._folder(o) for o in dict.fromkeys([*owners, BY_HAND])]
        last = [f"{folder}/run={runs[-1]}" for folder in all_of if (runs := self._whole(folder))]
        if not last:
            return self.spark.createDataFrame([], HISTORY)
        return self.spark.read.schema(HISTORY).parquet(*last)

    def frame(self, *owners: str) -> DataFrame:
        """The states of the named pipelines, of all where none is named; what was set by hand is among them."""
        return marks.latest(self._history(owners or None))

    def get_all(self, state_ids: Sequence[str], side: str = "low") -> dict[str, str | None]:
        """Stored values of the named states, read in one go; None where there is none."""
        wanted = self._history().where(F.col("state_id").isin(list(state_ids)))
        stored = {r["state_id"]: r[side] for r in marks.latest(wanted).collect()}
        return {state_id: stored.get(state_id) for state_id in state_ids}

    def get(self, state_id: str, side: str = "low") -> str | None:
        return self.get_all([state_id], side)[state_id]

    # ---- setting -----------------------------------------------------------------------------

    def set(self, new: DataFrame, batch: Batch | None = None) -> None:
        """End a run: from here on its states are the new ones, and the next run has the next number."""
        self._end(marks.set_rows(new), batch)

    def _end(self, rows: DataFrame, batch: Batch | None) -> None:
        owner, number = batch or self.run(BY_HAND)
        folder = self._folder(owner)
        before = self._whole(folder)
        # the clock orders settings of one state, which only one job, and whoever sets it by hand, makes
        rows = rows.select(*WATERMARKS.names, F.lit(time.time_ns()).alias("seq"))
        if before:
            rows = self.spark.read.schema(HISTORY).parquet(f"{folder}/run={before[-1]}").unionByName(rows)
        marks.settled(rows).write.mode("overwrite").parquet(f"{folder}/run={number}")
        for old in before[:-1]:
            folders.remove(self.spark, f"{folder}/run={old}")

    def rows(self, values: Mapping[str, object], side: str = "low") -> DataFrame:
        """Values as the rows that set them."""
        rows = [
            (k, str(v) if side == "low" else None, str(v) if side == "high" else None, type(v).__name__)
            for k, v in values.items()
            if v is not None
        ]
        return self.spark.createDataFrame(rows, WATERMARKS).coalesce(1)

    def set_values(self, values: Mapping[str, object], side: str = "low", batch: Batch | None = None) -> None:
        if batch or any(v is not None for v in values.values()):
            self.set(self.rows(values, side), batch)

    def set_value(self, state_id: str, value: object, side: str = "low", batch: Batch | None = None) -> None:
        self.set_values({state_id: value}, side, batch)

    def clear(self, state_id: str) -> None:
        """Forget a state, so that its job reads everything again."""
        rows = [(state_id, marks.CLEARED, marks.CLEARED, None)]
        self._end(self.spark.createDataFrame(rows, WATERMARKS).coalesce(1), None)
