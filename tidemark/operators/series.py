"""Series metadata and the checks for series not known yet."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.joins import join_aggregated

# Fixed value: what an empty metadata map is replaced with.
DEFAULT_METADATA_KEY = "source"


def series_rows(series: DataFrame, assets: DataFrame, service: str = "tidemark") -> DataFrame:
    """Series metadata as stored, with the asset id resolved and defaults filled in.

    ``series`` has assetId and the raw metadata columns, ``assets`` is (id, externalId).  A series
    whose name, unit or any other stored column is null after defaulting is left out; it stays
    unseen, so a later run picks it up.
    """
    lookup = assets.groupBy(F.col("id").alias("assetId")).agg(
        F.max("externalId").alias("assetExternalId")
    )
    empty = F.col("metadata").isNull() | (F.size("metadata") == 0)
    default = F.create_map(F.lit(DEFAULT_METADATA_KEY), F.lit(service))
    complete = series.dropna(subset=["externalId", "name", "isString", "isStep", "unit"])
    return join_aggregated(complete, lookup, ["assetId"], "left").select(
        "externalId",
        "name",
        F.coalesce("description", F.lit("")).alias("description"),
        "isString",
        "isStep",
        "unit",
        F.when(empty, default).otherwise(F.col("metadata")).alias("metadata"),
        F.coalesce("assetExternalId", F.lit("")).alias("assetExternalId"),
    )


def unseen_ids(points: DataFrame, known: DataFrame) -> DataFrame:
    """Distinct external ids of the points with no row in ``known``."""
    return (
        points.select("externalId")
        .distinct()
        .join(known.select("externalId"), "externalId", "left_anti")
    )


def missing_series(points: DataFrame, known: DataFrame, data_set_id: int | None = None) -> DataFrame:
    """Rows creating the series the destination lacks: named after their id, string-valued."""
    return unseen_ids(points, known).select(
        "externalId",
        F.col("externalId").alias("name"),
        F.lit(True).alias("isString"),
        F.lit(data_set_id).cast("long").alias("dataSetId"),
    )
