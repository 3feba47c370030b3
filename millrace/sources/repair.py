"""Repair of malformed exports.

The files hold two bytes per character (or NUL after every byte), a delimiter
of several characters, quotes around every field but none escaped inside, and
line breaks within fields. A record ends at the first carriage return after its
last delimiter, so finding record ends means counting delimiters from the start
of the file. That count is a prefix sum, which Spark computes in parallel:

1. the text source splits files at carriage returns, many tasks per file;
2. delimiters are counted per file block, and summed over a file's blocks;
3. within a block a running count gives each segment its record number;
4. segments of one record are put together again, and fields unquoted.

No file, and no block, is ever held as one value.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.sources.blocks import joined_text, read_blocks, with_counts
from millrace.sources.delimited import Paths, listed

_MODES = ("FAILFAST", "PERMISSIVE", "DROPMALFORMED")


def _decoded(encoding: str) -> Column:
    """A segment's text. The reader hands on raw bytes, cut at the encoded CR."""
    raw = F.col("value").cast("binary")
    if encoding.upper() == "UTF-8":
        # NUL after every character, but otherwise plain single-byte text.
        return F.translate(F.col("value"), "\0", "")
    text = F.decode(raw, encoding)
    if not encoding.upper().startswith("UTF-16"):
        return text
    stop = F.raise_error(F.concat(
        F.lit("carriage return bytes inside a character pair in "), F.col("_metadata.file_path")
    ))
    return F.when(F.octet_length(raw) % 2 == 1, stop).otherwise(text)


def read_segments(spark: SparkSession, paths: Paths, encoding: str = "UTF-16LE") -> DataFrame:
    """Text between carriage returns with its place: file, block, position."""
    text = F.ltrim(_decoded(encoding), F.lit("﻿"))
    return read_blocks(spark, listed(paths), "\r", text, encoding)


def read_header(spark: SparkSession, paths: Paths, delimiter: str, encoding: str = "UTF-16LE") -> list[str]:
    """Column names from the first line of one of the files."""
    row = read_segments(spark, paths, encoding).filter("block = 0").select("segment").head()
    if row is None:
        raise ValueError("no text to read a header from")
    return [_unquote(name) for name in row[0].split("\n")[0].split(delimiter)]


def _unquote(text: str) -> str:
    return text[1:-1] if len(text) > 1 and text.startswith('"') and text.endswith('"') else text


def _count(delimiter: str) -> Column:
    shorter = F.length(F.replace(F.col("segment"), F.lit(delimiter), F.lit("")))
    return ((F.length("segment") - shorter) / len(delimiter)).cast("bigint")


def _number_records(segments: DataFrame, fields: int) -> DataFrame:
    """Adds ``record``: 0 for the header line, then 1, 2, … per file.

    ``edge`` marks records that may have pieces in a neighbouring block: the
    first and the last one of a block.
    """
    per_record = F.lit(fields - 1)
    placed = with_counts(segments, "delimiters")

    def record_at(count: Column) -> Column:
        return F.floor(count / per_record).cast("bigint")

    record = record_at(F.col("offset") + F.col("running"))
    first, last = record_at(F.col("offset")), record_at(F.col("offset") + F.col("total"))
    return placed.withColumns({"record": record, "edge": (record == first) | (record == last)})


def _assemble(pieces: DataFrame, *keys: str) -> DataFrame:
    return pieces.groupBy(*keys).agg(
        joined_text("\r").alias("text"),
        F.sum("delimiters").alias("delimiters"),
        F.first("file_name").alias("file_name"),
        F.first("file_modification_time").alias("file_modification_time"),
    ).select("path", "record", "delimiters", "file_name", "file_modification_time", "text")


def _field(position: int) -> Column:
    value = F.get("fields", F.lit(position))
    quoted = (F.length(value) > 1) & value.startswith('"') & value.endswith('"')
    return F.when(quoted, F.substring(value, F.lit(2), F.length(value) - 2)).otherwise(value)


def read_repaired(
    spark: SparkSession,
    paths: Paths,
    delimiter: str = "|*",
    encoding: str = "UTF-16LE",
    columns: Sequence[str] | None = None,
    mode: str = "FAILFAST",
) -> DataFrame:
    """Repaired files as string columns plus ``file_name`` and ``file_modification_time``.

    ``encoding="UTF-8"`` strips NULs from single-byte text instead of decoding.
    All files must share one header, which is checked. A text left over at the
    end of a file with too few fields stops the job (``FAILFAST``), fills the
    missing fields with NULL (``PERMISSIVE``) or is dropped (``DROPMALFORMED``).
    """
    if mode not in _MODES:
        raise ValueError(f"mode must be one of {_MODES}")
    header = list(columns) if columns else read_header(spark, paths, delimiter, encoding)
    if len(header) < 2:
        raise ValueError("record ends are found by counting delimiters: at least two columns are needed")
    segments = read_segments(spark, paths, encoding).withColumn("delimiters", _count(delimiter))
    numbered = _number_records(segments, len(header))
    # Whole records inside a block are put together where the running count
    # left them; only the few at block edges are shuffled once more.
    inside = _assemble(numbered.filter(~F.col("edge")), "path", "block", "record")
    across = _assemble(numbered.filter("edge"), "path", "record")
    split = inside.unionByName(across).select(
        "path", "record", "delimiters", "file_name", "file_modification_time",
        F.split(F.regexp_replace("text", "^\n", ""), re.escape(delimiter)).alias("fields"),
    )
    return _checked(split, header, mode).select(
        *[_field(i).alias(name) for i, name in enumerate(header)], "file_name", "file_modification_time"
    )


def _checked(records: DataFrame, header: list[str], mode: str) -> DataFrame:
    blank = (F.size("fields") == 1) & (F.trim(F.regexp_replace(F.get("fields", F.lit(0)), r"\s", "")) == "")
    where = F.concat(F.col("path"), F.lit(", record "), F.col("record").cast("string"))
    wrong_header = F.raise_error(F.concat(F.lit("another header than expected in "), F.col("path")))
    short = F.col("delimiters") < len(header) - 1
    expected = F.array(*[F.lit(name) for name in header])
    found = F.transform("fields", lambda field: F.regexp_replace(field, r'^"|"$|\n.*$', ""))
    keep = F.when((F.col("record") == 0) & (found != expected), wrong_header.cast("boolean"))
    keep = keep.when(F.col("record") == 0, F.lit(False)).when(blank, F.lit(False))
    if mode == "FAILFAST":
        stop = F.raise_error(F.concat(F.lit("incomplete record in "), where)).cast("boolean")
        keep = keep.when(short, stop)
    elif mode == "DROPMALFORMED":
        keep = keep.when(short, F.lit(False))
    return records.filter(keep.otherwise(F.lit(True)))
