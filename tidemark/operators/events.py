"""Event shapes on both sides, and resolving the assets an event refers to."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import json_text
from tidemark.operators.joins import join_aggregated
from tidemark.schemas import EVENT_OPTIONAL


def metadata_as_json(events: DataFrame, column: str = "metadata") -> DataFrame:
    """The metadata object as JSON text; null where it is absent, unchanged without the column."""
    if column not in events.columns:
        return events
    return events.withColumn(column, json_text(column, events.schema[column].dataType))


def event_rows(
    events: DataFrame, data_set_id: int | None = None, order: str | None = None
) -> DataFrame:
    """Lake rows projected to the event shape: absent optional columns become typed nulls.

    ``order`` names a column to carry along as ``__order``, for picking the latest of an id.
    """
    optional = [
        F.col(name) if name in events.columns else F.lit(None).cast(dtype).alias(name)
        for name, dtype in EVENT_OPTIONAL.items()
    ]
    carried = [F.col(order).alias("__order")] if order else []
    data_set = F.lit(data_set_id).cast("long").alias("dataSetId")
    return events.select("externalId", "startTime", *optional, data_set, *carried)


def resolve_assets(events: DataFrame, assets: DataFrame) -> DataFrame:
    """``assetExternalIds`` replaced by ``assetIds``: same order, unknown ids skipped.

    Each distinct id list is resolved once and joined back by two 64-bit hashes of it, so events are never
    exploded and need no row identity, and a list moves once; lists shared by many events collapse before
    that.  ``assets`` is (id, externalId).
    """
    name = ["__list", "__list_again"]
    named = events.withColumns({
        name[0]: F.xxhash64("assetExternalIds"), name[1]: F.xxhash64(F.lit(1), F.size("assetExternalIds"), "assetExternalIds")
    })
    lists = named.where(F.size("assetExternalIds") > 0).groupBy(*name).agg(F.first("assetExternalIds").alias("listed"))
    ids = assets.groupBy("externalId").agg(F.min("id").alias("id"))
    resolved = (
        lists.select(*name, F.posexplode("listed").alias("pos", "externalId"))
        .transform(join_aggregated, ids, ["externalId"], "inner")
        .groupBy(*name)
        .agg(F.sort_array(F.collect_list(F.struct("pos", "id"))).alias("__hits"))
        .select(*name, F.transform("__hits", lambda h: h["id"]).alias("__ids"))
    )
    listed = F.when(F.col("assetExternalIds").isNotNull(), F.array().cast("array<bigint>"))
    kept = [c for c in events.columns if c != "assetExternalIds"]
    return join_aggregated(named, resolved, name, "left").select(
        *kept, F.coalesce(F.col("__ids").cast("array<bigint>"), listed).alias("assetIds")
    )


def unknown_assets(events: DataFrame, assets: DataFrame) -> DataFrame:
    """Distinct asset external ids events refer to and no asset has."""
    return (
        events.select(F.explode("assetExternalIds").alias("externalId"))
        .distinct()
        .join(assets.select("externalId"), "externalId", "left_anti")
    )
