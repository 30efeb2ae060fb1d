"""Time-series points: feed unnesting, prefixing and the wide frame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.operators.joins import join_aggregated

POINT_KEYS = ("externalId", "timestamp")


def explode_feed(feed: DataFrame) -> DataFrame:
    """One row per point from records of parallel ``timestamp``/``value`` arrays.

    The timestamp array decides how many points there are; surplus values are ignored.  The
    feed's ``cursor``, when present, is kept as the arrival order.  ``deletes`` are not applied.
    """
    order = ["cursor"] if "cursor" in feed.columns else []
    return (
        feed.select("external_id", *order, F.inline(F.arrays_zip("upserts.timestamp", "upserts.value")))
        .where(F.col("timestamp").isNotNull())
        .select(
            F.col("external_id").alias("externalId"),
            F.timestamp_millis("timestamp").alias("timestamp"),
            "value",
            *order,
        )
    )


def prefix_ids(points: DataFrame, prefix: str) -> DataFrame:
    return points.withColumn("externalId", F.concat(F.lit(prefix), F.col("externalId")))


def wide(points: DataFrame, ids: Sequence[str]) -> DataFrame:
    """One row per timestamp, one column per listed series.

    The caller names the series; others are left out, and one without points is a column of nulls.  The
    long form is what tables store.  Values are first reduced to one a series and timestamp, then put in
    their places, so each point is looked at once, however many series there are.  Aggregating with ``max``
    rather than ``first`` keeps the result the same however rows arrive.
    """
    listed = F.when(F.col("externalId").isin(list(ids)), F.col("externalId"))
    return points.select("timestamp", listed.alias("externalId"), "value").groupBy("timestamp").pivot("externalId", list(ids)).max("value")


#: Into how many parts ids are dealt to be numbered.
PARTS = 256


def dictionary(points: DataFrame) -> DataFrame:
    """(externalId, index): the different ids, numbered from 0 without gaps, the same way in every run.

    Ids are numbered within parts by their hash, and parts start where those before them end, so no task
    sees all ids.
    """
    part = F.pmod(F.xxhash64("externalId"), F.lit(PARTS)).alias("part")
    ids = points.where("externalId is not null").select("externalId").distinct().select("externalId", part)
    ends = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # over PARTS rows
    starts = ids.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select("part", F.coalesce(F.sum("n").over(ends), F.lit(0)).alias("start"))
    place = F.row_number().over(Window.partitionBy("part").orderBy("externalId")) - 1
    return ids.withColumn("place", place).join(starts, "part").select("externalId", (F.col("start") + F.col("place")).cast("int").alias("index"))


def wide_sparse(points: DataFrame, numbers: DataFrame) -> DataFrame:
    """(timestamp, indices, values): the wide frame of any width, a row holding the series that have a point then.

    ``numbers`` is (externalId, index); series that it lacks are left out.  The highest of several values of
    one series and timestamp counts, null values have no place.  Work goes by points, not by points times
    series, and a row is as long as what it holds.
    """
    coded = join_aggregated(points.where("value is not null"), numbers, ["externalId"], "inner")
    one = coded.groupBy("timestamp", "index").agg(F.max("value").alias("value"))
    row = F.sort_array(F.collect_list(F.struct("index", "value"))).alias("row")
    return one.groupBy("timestamp").agg(row).select("timestamp", F.col("row.index").alias("indices"), F.col("row.value").alias("values"))
