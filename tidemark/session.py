"""Session settings the jobs rely on, and the shared folder they write scratch data to."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# UTC keeps epoch/text conversions independent of the cluster's zone.  The rest lets AQE size
# shuffles, split skewed join partitions and split oversized partitions before a write.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join even where an aggregation on the same key would reuse its partitioning:
    # the extra shuffle then only moves partial results
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # what a map task aggregates or sorts before its shuffle goes by what it reads
    "spark.sql.files.maxPartitionBytes": "64m",
    # the state of streams on the executors' disks rather than in their heaps
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


#: Taken when a session is started: streams get pools of their own (see ``in_pool``), which share alike.
AT_START = {"spark.scheduler.mode": "FAIR"}


def build_session(app_name: str = "tidemark", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **AT_START, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session somebody else built."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def in_pool(spark: SparkSession, name: str) -> Iterator[None]:
    """Jobs and streams started within run in a scheduler pool of that name: pools share the cluster alike."""
    context, key = spark.sparkContext, "spark.scheduler.pool"
    before = context.getLocalProperty(key)
    context.setLocalProperty(key, name)
    try:
        yield
    finally:
        context.setLocalProperty(key, before)


ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def ship_package(spark: SparkSession) -> None:
    """Python workers import this package from where the driver has it, whatever folder that was started in.

    On a cluster whose machines don't share that folder, ship it with ``--py-files``.
    """
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, paths)])


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder under ``spark.checkpoint.dir``, the storage every executor can reach."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        raise ValueError("spark.checkpoint.dir is not set; point it at storage all executors share")
    return f"{base.rstrip('/')}/tidemark/{name}-{uuid.uuid4().hex}"
