"""Job parameters, and the shapes of the tables that jobs keep."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

from tidemark.operators.instances import View
from tidemark.operators.points import POINT_KEYS
from tidemark.sources.tables import Shape

#: The point with the highest cursor counts, however a feed's pages were cut into batches.
POINTS = Shape(keys=POINT_KEYS, order=("cursor",), hidden=("cursor",), day="timestamp")
SERIES = Shape(keys=("externalId",))
RAW_ROWS = Shape(keys=("key",), order=("last_updated_time",))
INSTANCES = Shape(gone=("externalId", "lastUpdatedTime", "deletedTime"))
FILES = Shape(keys=("external_id",))
OUT_POINTS = Shape(keys=POINT_KEYS, day="timestamp")
OUT_EVENTS = Shape(keys=("externalId",), order=("__order",), hidden=("__order",))


@dataclass(frozen=True)
class Subscription:
    """A points feed and the two tables it keeps.

    With ``partitions`` the feed folder is laid out as ``partition=N`` and only those are followed.  With
    ``pages`` it is paged by cursor (see ``sources/paged.py``), and a micro-batch takes at most so many pages
    of a partition.
    """

    external_id: str
    feed: str
    points_table: str
    series_table: str
    partitions: tuple[int, ...] | None = None
    value_type: T.DataType = T.DoubleType()
    max_files: int | None = None
    max_bytes: str | None = None
    pages: int | None = None


@dataclass(frozen=True)
class Space:
    """A data-model space: its views and the folder holding its tables."""

    space: str
    views: tuple[View, ...]
    tables: str


@dataclass(frozen=True)
class EventFeed:
    table: str
    data_set: str


@dataclass(frozen=True)
class RawFeed:
    db_name: str
    table_name: str
    table: str
    columns: tuple[str, ...] | None = None

    @property
    def state_id(self) -> str:
        return f"{self.db_name}_{self.table_name}_raw_state"


@dataclass(frozen=True)
class RawExport:
    db_name: str
    table_name: str
    key_fields: tuple[str, ...] | None = None
    incremental_field: str | None = None
    md5_key: bool = False

    @property
    def state_id(self) -> str:
        return f"raw/{self.db_name}/{self.table_name}"

    @property
    def shape(self) -> Shape:
        return Shape(keys=("row_key",), order=(self.incremental_field,) if self.incremental_field else ())


@dataclass(frozen=True)
class Destination:
    """Where exports from the lake land."""

    tables: str
    series_prefix: str = ""
    data_set_id: int | None = None
