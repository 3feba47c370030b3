"""Delimited files with line breaks inside fields, read by many tasks per file.

Spark's CSV reader gives such a file to one task. Here a line is told by what it does to the reader's state, which at
a line break is one of two: between records, or inside a quoted field. Patterns that follow fields, quotes,
escapes and delimiters through one line say in which state it ends when it begins in either. These maps are composed
over lines and blocks of a file, lines of one record are put together, and Spark's own CSV function parses each record.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from millrace.catalogue import FileFormat
from millrace.sources.blocks import in_block, joined_text, read_blocks, with_state
from millrace.sources.delimited import LINEAGE, Paths, csv_options, listed, read_delimited

_QUOTE, _END = '"', "_end_of_record"

#: How quotes that are not escaped may be handled for records to be found line by line.
SPLITTABLE = ("STOP_AT_DELIMITER", "STOP_AT_CLOSING_QUOTE")


def _wide(fmt: FileFormat) -> bool:
    """Whether characters are written in units of two or four bytes, in which a line feed's byte need not be one."""
    return (fmt.encoding or "").upper().replace("_", "-").startswith(("UTF-16", "UTF16", "UTF-32", "UTF32"))


def splits(spark: SparkSession, paths: Paths, fmt: FileFormat) -> bool:
    """Whether such files are read by many tasks each: as the format says, else if one is larger than a task's share.

    Only sizes are looked at. Files in folders that stand for columns are left to Spark's reader, which adds those.
    """
    if not fmt.multiline or fmt.unescaped_quotes not in SPLITTABLE or _wide(fmt):
        return False
    if fmt.split_multiline is not None:
        return fmt.split_multiline
    share = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    found = spark.read.format("binaryFile").load(listed(paths)).agg(
        F.max("length").alias("largest"), F.bool_or(F.col("path").rlike("/[^/=]+=[^/]*/")).alias("columns")
    ).first()
    return found["largest"] is not None and found["largest"] > share and not found["columns"]


def _line_patterns(fmt: FileFormat) -> tuple[str, str]:
    """Patterns of lines that end inside a quoted field, begun between records (a delimiter put before) and inside one.

    All repetitions are possessive, so a line is read once from left to right, whatever its length.
    """
    quote, delimiter = _QUOTE, re.escape(fmt.delimiter)
    escape = fmt.escape or quote
    if escape == quote:
        body = f'[^{quote}]*+(?:{quote}{quote}[^{quote}]*+)*+'
    else:
        e = re.escape(escape) if escape not in "\\^]-" else "\\" + escape
        # A quote right before the escape character closes nothing.
        body = f'[^{quote}{e}]*+(?:{quote}*{re.escape(escape)}(?:.|\\z)[^{quote}{e}]*+)*+'
    if fmt.unescaped_quotes == "STOP_AT_CLOSING_QUOTE":
        # A quote closes its field only before a delimiter or the line's end, blanks aside.
        body += f'(?:{quote}(?![\\x01-\\x20]*+(?:{delimiter}|\\z)){body})*+'
    rest = f"(?:(?!{delimiter}).)*+"  # whatever follows a closing quote, and any field that begins without one
    field = f"{delimiter}(?:{quote}{body}{quote}{rest}|(?!{quote}){rest})"
    opened = f"(?:{field})*+{delimiter}{quote}{body}\\z"
    return f"(?s)^{opened}", f"(?s)^{body}(?:\\z|{quote}{rest}{opened})"


def _with_maps(lines: DataFrame, fmt: FileFormat) -> DataFrame:
    """Adds what each line does to the state. A line without a quote leaves it."""
    outside, inside = _line_patterns(fmt)
    text = F.regexp_replace("segment", "\r$", "")
    has_quote = F.contains("segment", F.lit(_QUOTE))
    return lines.withColumn(
        "from_outside", F.when(has_quote, F.concat(F.lit(fmt.delimiter), text).rlike(outside)).otherwise(False)
    ).withColumn("from_inside", F.when(has_quote, text.rlike(inside)).otherwise(True))


def _lineage() -> list[Column]:
    return [F.first(name).alias(name) for name in LINEAGE]


def _records(lines: DataFrame) -> DataFrame:
    """One row per record: ``text``, ``first`` (the file's first record) and lineage."""
    local = with_state(lines).withColumn("opens", (~F.col("inside")).cast("bigint"))
    local = local.withColumn("local", F.sum("opens").over(in_block()))
    pieces = local.groupBy("path", "block", "local").agg(
        joined_text("\n").alias("segment"), *_lineage()
    )
    # Only the first and the last piece of a block can belong to a record that
    # crosses its edge: one row each, told apart by the block's count of opens.
    per_block = Window.partitionBy("path", "block")
    pieces = pieces.withColumn("opened", F.max("local").over(per_block))
    crossing = (F.col("local") == 0) | (F.col("local") == F.col("opened"))
    inside = pieces.filter(~crossing).select(
        "segment", ((F.col("block") == 0) & (F.col("local") == 1)).alias("first"), *LINEAGE
    )
    before = Window.partitionBy("path").orderBy("block", "local")
    edges = pieces.filter(crossing).withColumn("owner", F.sum((F.col("local") > 0).cast("bigint")).over(before))
    across = edges.groupBy("path", "owner").agg(
        F.array_join(F.transform(
            F.sort_array(F.collect_list(F.struct("block", "local", "segment"))), lambda p: p["segment"]
        ), "\n").alias("segment"),
        F.bool_or((F.col("block") == 0) & (F.col("local") == 1)).alias("first"), *_lineage(),
    ).select("segment", "first", *LINEAGE)
    return inside.unionByName(across)


def read_multiline(
    spark: SparkSession,
    paths: Paths,
    fmt: FileFormat | None = None,
    columns: Sequence[str] | None = None,
    lineage: bool = True,
) -> DataFrame:
    """Like ``read_delimited`` with line breaks inside fields, for files of any size.

    Quotes may be escaped, doubled, or stand unescaped inside fields, as ``unescaped_quotes`` says; it must be
    one of ``SPLITTABLE``. Lines end with a line feed, with or without a carriage return; a last line without is read
    as if it had one. What a quote that is not escaped means right before an escape character is not defined.
    """
    fmt = fmt or FileFormat()
    if fmt.unescaped_quotes not in SPLITTABLE or _wide(fmt):
        raise ValueError(f"files with unescaped quotes {fmt.unescaped_quotes} in {fmt.encoding or 'UTF-8'} cannot be split; read them by one task each")
    names = list(columns) if columns else read_delimited(spark, paths, fmt, lineage=False).columns
    value = F.col("value") if fmt.encoding is None else F.decode(F.col("value").cast("binary"), fmt.encoding)
    lines = read_blocks(spark, listed(paths), "\n", value)
    records = _records(_with_maps(lines, fmt)).withColumn("segment", F.regexp_replace("segment", "\r$", ""))
    options = {k: v for k, v in csv_options(fmt).items() if k not in ("header", "inferSchema", "encoding")}
    schema = ", ".join(f"`{name}` string" for name in names)
    if fmt.header:
        header = F.from_csv("segment", schema, options)
        differs = F.lower(F.concat_ws(fmt.delimiter, *[header[n] for n in names])) != F.lit(fmt.delimiter.join(names).lower())
        stop = F.raise_error(F.concat(F.lit("a file's header differs from the expected columns: "), F.col("segment")))
        records = records.filter(F.when(F.col("first"), F.when(differs, stop).isNotNull()).otherwise(True))
    # Ended by a delimiter: the parser takes odd quotes before the end of its text otherwise than before a line's
    # end. Not so a field still open, which the end of the file cuts off.
    cut = F.contains("segment", F.lit(_QUOTE)) & F.concat(F.lit(fmt.delimiter), "segment").rlike(_line_patterns(fmt)[0])
    ended = F.concat("segment", F.when(cut, "").otherwise(fmt.delimiter))
    parsed = records.filter(F.length("segment") > 0).select(
        F.from_csv(ended, f"{schema}, `{_END}` string", options).dropFields(_END).alias("record"), *LINEAGE
    )
    return parsed.select("record.*", *(LINEAGE if lineage else ()))
