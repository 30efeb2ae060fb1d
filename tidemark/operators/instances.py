"""Property-graph instances: flattening per view, routing, history and deletes.

A change-feed row has the base fields, ``deletedTime``, optional endpoints, and ``properties``:
a struct with one nullable struct per view.  A view is known by space, external id and version; its
struct is named after its external id, or, where views share one, as the view's ``named`` says.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.joins import join_aggregated
from tidemark.operators.merge import append_evolving
from tidemark.operators.scan import since

BASE = ("space", "externalId", "version", "lastUpdatedTime", "createdTime")
ENDPOINTS = ("startNode", "endNode")
#: The columns of a change-feed row that become something in a table.
READ = (*BASE, "instanceType", "deletedTime", *ENDPOINTS, "properties")


@dataclass(frozen=True)
class View:
    """One entry of the view catalog."""

    space: str
    external_id: str
    version: str = "1"
    used_for: str = "node"
    properties: tuple[str, ...] = field(default_factory=tuple)
    named: str | None = None

    @property
    def table(self) -> str:
        return f"{self.space}_{self.external_id}" if self.named is None else f"{self.space}_{self.named}"

    @property
    def data(self) -> str:
        return f"properties.`{self.named or self.external_id}`"


def views_of(catalog: DataFrame, space: str) -> tuple[View, ...]:
    """The views of a space from the view catalog: (space, externalId, version, usedFor,
    properties).  A catalog has a row per view, and each becomes one lazy DataFrame."""
    rows = catalog.where(F.col("space") == space).orderBy("externalId", "version").collect()
    shared = Counter(r["externalId"] for r in rows)
    return tuple(
        View(
            r["space"], r["externalId"], r["version"], r["usedFor"], tuple(sorted(r["properties"])),
            f"{r['externalId']}_{r['version']}" if shared[r["externalId"]] > 1 else None,
        )
        for r in rows
    )


def edge_table(space: str) -> str:
    return f"{space}_edges"


def has_data(instances: DataFrame, view: View) -> DataFrame:
    """Instances carrying properties of the view."""
    return instances.where(F.col(view.data).isNotNull())


def of_type(edges: DataFrame, space: str, external_id: str) -> DataFrame:
    """Edges whose type is the given (space, externalId)."""
    return edges.where(
        (F.col("type.space") == space) & (F.col("type.externalId") == external_id)
    )


def _endpoint(name: str) -> Column:
    return F.struct(
        F.col(f"{name}.space").alias("space"), F.col(f"{name}.externalId").alias("externalId")
    ).alias(name)


def _promoted(views: Sequence[View]) -> dict[str, Column]:
    """Property columns of the views; of two views holding a name, the later present one wins."""
    columns: dict[str, Column] = {}
    for view in views:
        for name in view.properties:
            value = F.col(f"{view.data}.`{name}`")
            if name in columns:
                value = F.when(F.col(view.data).isNotNull(), value).otherwise(columns[name])
            columns[name] = value
    return columns


def _flatten(instances: DataFrame, kind: str, views: Sequence[View], extra: list[Column]) -> DataFrame:
    promoted = _promoted(views)
    base = {name: F.col(name) for name in BASE}
    base["instanceType"] = F.lit(kind)
    # a property named like a base field replaces it
    fixed = [c.alias(n) for n, c in base.items() if n not in promoted]
    return instances.select(
        *fixed, *extra, *[c.alias(n) for n, c in promoted.items()], "deletedTime"
    )


def flatten_nodes(instances: DataFrame, view: View) -> DataFrame:
    """Rows of the view's table: base fields plus its properties, deletedTime last."""
    return _flatten(has_data(instances, view), "node", [view], [])


def flatten_edges(edges: DataFrame, views: Sequence[View] = ()) -> DataFrame:
    """Rows of the edge table: base fields, both endpoints, properties of the given views."""
    return _flatten(edges, "edge", views, [_endpoint(name) for name in ENDPOINTS])


def split_deleted(flat: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(live rows without deletedTime, deleted rows with it)."""
    deleted = F.col("deletedTime").isNotNull()
    return flat.where(~deleted).drop("deletedTime"), flat.where(deleted)


def _routes(views: Sequence[View], edge: Column, present: Sequence[Column]) -> Column:
    """The tables a row goes to, by whether it is an edge and which node views it has data in."""
    tables = F.filter(F.array(*[F.when(p, F.lit(v.table)) for p, v in zip(present, views)]), lambda t: t.isNotNull())
    return F.when(edge, F.array(F.concat(F.col("space"), F.lit("_edges")))).otherwise(tables)


def _node_views(views: Sequence[View]) -> list[View]:
    return [v for v in views if v.used_for != "edge"]


def routed(instances: DataFrame, views: Sequence[View]) -> DataFrame:
    """One row per destination: nodes once per view they have data in, edges to their space's
    edge table.  A node without any view has a row without a table, so it is counted."""
    own = _node_views(views)
    tables = _routes(own, F.col("instanceType") == "edge", [F.col(v.data).isNotNull() for v in own])
    return instances.withColumn("table_name", F.explode_outer(tables))


def route_counts(instances: DataFrame, views: Sequence[View]) -> DataFrame:
    """Live and deleted rows per destination table; rows that go the same ways are counted before they are routed."""
    own, deleted = _node_views(views), F.col("deletedTime").isNotNull()
    present = [f"has_{k}" for k in range(len(own))]
    ways = instances.groupBy(
        "space", (F.col("instanceType") == "edge").alias("edge"), *[F.col(v.data).isNotNull().alias(n) for n, v in zip(present, own)]
    ).agg(F.count_if(~deleted).alias("upserts"), F.count_if(deleted).alias("deletes"))
    tables = F.explode_outer(_routes(own, F.col("edge"), [F.col(n) for n in present]))
    return ways.withColumn("table_name", tables).groupBy("table_name").agg(F.sum("upserts").alias("upserts"), F.sum("deletes").alias("deletes"))


def flows(space: str, views: Sequence[View]) -> dict[str, Callable[[DataFrame], DataFrame]]:
    """The tables of a space, and how the changes of its instances become rows of each."""
    kind, own = F.col("instanceType"), F.col("space") == space
    edge_views = [v for v in views if v.used_for == "edge"]

    def nodes(view: View) -> Callable[[DataFrame], DataFrame]:
        return lambda changes: flatten_nodes(changes.where((kind == "node") & own), view)

    out = {v.table: nodes(v) for v in views if v.used_for != "edge"}
    out[edge_table(space)] = lambda changes: flatten_edges(changes.where((kind == "edge") & own), edge_views)
    return out


def apply_batch(target: DataFrame, flat: DataFrame) -> DataFrame:
    """A table after one batch: live rows are appended as history, then deleted ids go.

    A delete removes the versions changed up to its time; an id created again later stays, however
    its changes are cut into batches.
    """
    live, deleted = split_deleted(flat)
    until = deleted.groupBy("externalId").agg(F.max("deletedTime").alias("tm_until"))
    rows = join_aggregated(append_evolving(target, live), until, ["externalId"], "left")
    return rows.where(F.col("tm_until").isNull() | (F.col("lastUpdatedTime") > F.col("tm_until"))).drop("tm_until")


def changes_since(instances: DataFrame, watermark: int | None, up_to: int | None = None) -> DataFrame:
    """Changes of one run: above the stored watermark, not beyond the run's start."""
    return since(instances, "lastUpdatedTime", watermark, up_to)


def bootstrap(snapshot: DataFrame, changes: DataFrame) -> DataFrame:
    """First load followed by the run after it.

    The start position is the snapshot's newest change, so a change is never in both parts and
    none falls between them.
    """
    start = snapshot.agg(F.max("lastUpdatedTime")).scalar()
    newer = start.isNull() | (F.col("lastUpdatedTime") > start)
    return append_evolving(snapshot, changes.where(newer))
