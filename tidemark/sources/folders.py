"""Small files and folders on whatever storage Spark reaches."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    system, where = _at(spark, path)
    return system.exists(where)


def names(spark: SparkSession, path: str) -> list[str]:
    """What a folder holds, in order; nothing where there is none."""
    system, where = _at(spark, path)
    return sorted(f.getPath().getName() for f in system.listStatus(where)) if system.exists(where) else []


def read_text(spark: SparkSession, path: str) -> str | None:
    system, where = _at(spark, path)
    if not system.exists(where):
        return None
    stream = system.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> bool:
    """Whether this writer's text is the one that stays: the first counts."""
    system, where = _at(spark, path)
    try:
        stream = system.create(where, False)
    except Exception:
        if system.exists(where):
            return False
        raise
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    return True


def remove(spark: SparkSession, path: str) -> None:
    system, where = _at(spark, path)
    system.delete(where, True)
