"""Sources other than delimited text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.catalogue import FileFormat
from millrace.sources.delimited import read_delimited


def read_files(
    spark: SparkSession,
    path: str | Sequence[str],
    fmt: str | FileFormat = "parquet",
    lineage: bool = False,
    **options: str,
) -> DataFrame:
    """A path read by format name or extension (``.csv``, ``parquet``, ``json``, ``delta`` …)."""
    if isinstance(fmt, FileFormat):
        name, layout = fmt.read_format, fmt
    else:
        name, layout = fmt.lstrip(".").lower(), FileFormat()
    if name == "csv":
        return read_delimited(spark, path, layout, lineage=lineage, **options)
    if name == "delta":
        return read_delta(spark, path, **options)
    frame = spark.read.format(name).options(**options).load(path)
    if not lineage:
        return frame
    return frame.select("*", "_metadata.file_name", "_metadata.file_modification_time")


def read_delta(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """A Delta table by path; needs the Delta package on the cluster."""
    try:
        return spark.read.format("delta").options(**options).load(path)
    except Exception as error:
        if "DATA_SOURCE_NOT_FOUND" in str(error) or "delta" in str(error).lower():
            raise RuntimeError("the Delta data source is not installed on this cluster") from error
        raise


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    partition_column: str | None = None,
    lower_bound: int | str | None = None,
    upper_bound: int | str | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """A database table; give a partition column and bounds to read it in parallel."""
    split = (partition_column, lower_bound, upper_bound, partitions)
    if any(v is not None for v in split) and any(v is None for v in split):
        raise ValueError("a parallel read needs partition_column, lower_bound, upper_bound and partitions")
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**dict(properties or {}))
    if partition_column:
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", str(lower_bound))
            .option("upperBound", str(upper_bound))
            .option("numPartitions", str(partitions))
        )
    return reader.load()


def read_whole_text(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """One row per file: its text, name and modification time."""
    frame = spark.read.text(path, wholetext=True)
    return frame.select(
        F.col("value").alias("text"), "_metadata.file_name", "_metadata.file_modification_time"
    )


def empty_like(spark: SparkSession, schema) -> DataFrame:
    """No rows in a given schema, so callers always see the target's columns."""
    return spark.createDataFrame([], schema)
