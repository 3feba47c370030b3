"""The processing log: one row per processed file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.functions.columns import join_path, time_literal
from millrace.operators.watermark import FIRST_MARK, LAST_MARK

# The log's columns and its folder of valid rows.
LOG_SCHEMA = "FilePath string, NumberOfRows int, FileName string, ProcessedDateTime timestamp"
CURRENT = "Status=Current"
_TIME_TEXT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def log_path(entity_path: str, entity: str) -> str:
    """``{entity_path}/{entity}.meta``."""
    return f"{entity_path.rstrip('/')}/{entity}.meta"


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """Current rows of the log (CSV with header, below ``Status=Current``)."""
    raw = spark.read.option("header", True).csv(f"{path.rstrip('/')}/{CURRENT}")
    return type_log(raw)


def type_log(raw: DataFrame) -> DataFrame:
    """The four log columns in their types; unreadable values become NULL."""
    return raw.select(
        F.col("FilePath").cast("string").alias("FilePath"),
        F.col("NumberOfRows").try_cast("int").alias("NumberOfRows"),
        F.col("FileName").cast("string").alias("FileName"),
        F.col("ProcessedDateTime").try_cast("timestamp").alias("ProcessedDateTime"),
    )


def append_log(rows: DataFrame, path: str) -> None:
    """Add rows (the four columns, in any order) to the current log."""
    named = rows.select("FilePath", "NumberOfRows", "FileName", F.col("ProcessedDateTime").cast("timestamp"))
    writer = named.write.mode("append").option("header", True).option("timestampFormat", _TIME_TEXT)
    writer.csv(f"{path.rstrip('/')}/{CURRENT}")


def files_to_process(
    log: DataFrame, root: str, lower: str | None = None, upper: str | None = None
) -> DataFrame:
    """Log rows with data, processed after ``lower`` and not after ``upper``.

    ``FilePathName`` is ``root/FilePath/FileName``. No rows when nothing is new.
    """
    after = F.col("ProcessedDateTime") > time_literal(lower or FIRST_MARK)
    until = F.col("ProcessedDateTime") <= time_literal(upper or LAST_MARK)
    found = log.filter((F.col("NumberOfRows") > 0) & after & until)
    return found.withColumn("FilePathName", join_path(root, F.col("FilePath"), F.col("FileName")))


def file_list(files: DataFrame) -> list[str]:
    """Paths for the reader. One entry per file, as many as the reader lists anyway."""
    return [row[0] for row in files.select("FilePathName").distinct().sort("FilePathName").toLocalIterator()]
