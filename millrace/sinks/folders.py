"""Small file operations through Hadoop's FileSystem, so any cluster store works."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _system(spark, path).exists(_path(spark, path))


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; empty when it does not exist."""
    if not exists(spark, path):
        return []
    return sorted(s.getPath().getName() for s in _system(spark, path).listStatus(_path(spark, path)))


def create_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a new small file; raises when it exists, so two writers cannot both win."""
    stream = _system(spark, path).create(_path(spark, path), False)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()


def read_text(spark: SparkSession, path: str) -> str:
    stream = _system(spark, path).open(_path(spark, path))
    try:
        reader = spark.sparkContext._jvm.org.apache.commons.io.IOUtils
        return reader.toString(stream, "UTF-8")
    finally:
        stream.close()


def remove(spark: SparkSession, path: str) -> None:
    _system(spark, path).delete(_path(spark, path), True)


def set_time(spark: SparkSession, path: str, milliseconds: int) -> None:
    """Sets a file's modification time, where the store keeps one that can be set."""
    _system(spark, path).setTimes(_path(spark, path), milliseconds, -1)
