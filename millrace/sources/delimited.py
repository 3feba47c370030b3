"""Delimited files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.catalogue import FileFormat

Paths = str | Sequence[str]
LINEAGE = ("file_name", "file_modification_time")


def listed(paths: Paths) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def csv_options(fmt: FileFormat) -> dict[str, str]:
    """Spark CSV options of a file format."""
    options = {"encoding": fmt.encoding} if fmt.encoding else {}
    return options | {
        "header": str(fmt.header).lower(),
        "sep": fmt.delimiter,
        "escape": fmt.escape,
        "mode": "FAILFAST" if fmt.fail_fast else "PERMISSIVE",
        "multiLine": str(fmt.multiline).lower(),
        "unescapedQuoteHandling": fmt.unescaped_quotes,
        "inferSchema": "false",
    }


def read_delimited(
    spark: SparkSession,
    paths: Paths,
    fmt: FileFormat | None = None,
    columns: Sequence[str] | None = None,
    lineage: bool = True,
    path_filter: str | None = None,
    **options: str,
) -> DataFrame:
    """Delimited files as strings, with ``file_name`` and ``file_modification_time``.

    Paths may be folders, files or globs; ``path_filter`` is a glob on file
    names below a folder. Given ``columns`` the header is not read on the
    driver. ``FileFormat(multiline=False)`` lets Spark split large files; with
    line breaks inside fields a file is read by one task.
    """
    reader = spark.read.options(**{**csv_options(fmt or FileFormat()), **options})
    if path_filter:
        reader = reader.option("pathGlobFilter", path_filter).option("recursiveFileLookup", "true")
    if columns:
        # A file whose header names other columns, or in another order, stops the read.
        reader = reader.schema(", ".join(f"`{c}` string" for c in columns)).option("enforceSchema", "false")
    frame = reader.csv(listed(paths))
    if not lineage:
        return frame
    return frame.select("*", *[F.col(f"_metadata.{name}") for name in LINEAGE])


def check_headers(spark: SparkSession, paths: Paths, fmt: FileFormat, lineage: bool = True, **options: str) -> DataFrame:
    """Files as ``read_delimited`` reads them, with every file's header checked against the first one's.

    Without a schema Spark takes the columns from one file and applies them to all by
    position. Here the names are given back to it as a schema, and it stops at a file that differs.
    """
    if not fmt.header:
        return read_delimited(spark, paths, fmt, lineage=lineage, **options)
    names = read_delimited(spark, paths, fmt, lineage=False, **options).columns
    return read_delimited(spark, paths, fmt, columns=names, lineage=lineage, **options)


def headers_by_file(spark: SparkSession, paths: Paths) -> DataFrame:
    """``header``, ``paths``: the first line of each file, files grouped by it.

    One text scan; per task and file only the first line is shuffled.
    """
    lines = spark.read.text(listed(paths)).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
        F.col("value"),
    )
    first = (
        lines.filter("block = 0")
        .groupBy("path")
        .agg(F.min_by("value", "place").alias("header"))
    )
    return first.groupBy("header").agg(F.sort_array(F.collect_list("path")).alias("paths"))


def read_many(
    spark: SparkSession,
    paths: Sequence[str],
    fmt: FileFormat | None = None,
    by_name: bool = False,
    lineage: bool = True,
) -> DataFrame:
    """Several files as one frame.

    One scan over all paths, columns by position like a plain UNION ALL. With
    ``by_name`` files are grouped by header line (one scan per distinct header)
    and united by column name; columns a file lacks are NULL.
    """
    if not paths:
        raise ValueError("no files to read")
    if not by_name:
        return read_delimited(spark, paths, fmt, lineage=lineage)
    groups = [row["paths"] for row in headers_by_file(spark, paths).sort("header").collect()]
    frames = [read_delimited(spark, group, fmt, lineage=lineage) for group in groups]
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result


def write_delimited(df: DataFrame, path: str, fmt: FileFormat | None = None, mode: str = "overwrite") -> None:
    """Replace (or extend) a delimited folder, written by all tasks side by side."""
    fmt = fmt or FileFormat()
    (
        df.write.mode(mode)
        .option("header", str(fmt.header).lower())
        .option("sep", fmt.delimiter)
        .option("escape", fmt.escape)
        .csv(path)
    )
