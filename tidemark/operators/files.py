"""File catalog rows and change detection against the stored modification times."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import base_name
from tidemark.operators.joins import join_aggregated


def catalog_rows(files: DataFrame, data_set_id: int | None = None) -> DataFrame:
    """Listed files as catalog rows.

    The listing has no creation time, so both times carry the modification time.
    """
    modified = F.unix_millis("modificationTime")
    content = ["content"] if "content" in files.columns else []
    return files.select(
        F.col("path").alias("external_id"),
        base_name("path").alias("name"),
        F.lit(data_set_id).cast("long").alias("data_set_id"),
        modified.alias("source_created_time"),
        modified.alias("source_modified_time"),
        "length",
        *content,
    )


def changed_files(catalog: DataFrame, state: DataFrame) -> DataFrame:
    """Files whose modification time differs from the stored one, new files included.

    ``state`` is (external_id, stored_time).  A time that moved backwards is a change as well.
    """
    joined = join_aggregated(catalog, state.select("external_id", "stored_time"), ["external_id"], "left")
    same = F.col("source_modified_time").eqNullSafe(F.col("stored_time"))
    return joined.where(~same).select(*catalog.columns)
