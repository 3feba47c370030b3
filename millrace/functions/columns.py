"""Derived columns used by several operators."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, functions as F


def time_literal(value=None, as_type: str = "timestamp") -> Column:
    """A time as a column: given value, or the query's current timestamp."""
    if value is None:
        return F.current_timestamp().cast(as_type)
    if isinstance(value, Column):
        return value.cast(as_type)
    if isinstance(value, (datetime, date)):
        value = value.isoformat()
    return F.lit(str(value)).cast(as_type)


def hash_key(*columns: str | Column, separator: str = "||", null_marker: str | None = None) -> Column:
    """SHA-256 over the joined key columns.

    ``concat_ws`` skips NULLs, so (a, NULL, b) and (a, b) hash alike. Give a
    ``null_marker`` to keep them apart.
    """
    parts = [F.col(c) if isinstance(c, str) else c for c in columns]
    parts = [c.cast("string") for c in parts]
    if null_marker is not None:
        parts = [F.coalesce(c, F.lit(null_marker)) for c in parts]
    return F.sha2(F.concat_ws(separator, *parts), 256)


def mask_column(column: str | Column, method: str = "mask") -> Column:
    """``mask`` keeps the shape (X, x, n), ``sha2`` keeps equality, ``redact`` keeps nothing."""
    value = (F.col(column) if isinstance(column, str) else column).cast("string")
    if method == "mask":
        return F.mask(value)
    if method == "sha2":
        return F.sha2(value, 256)
    if method == "redact":
        return F.when(value.isNotNull(), F.lit("***"))
    raise ValueError(f"unknown masking method {method!r}: use mask, sha2 or redact")


def business_year(day: str | Column, first_month: int = 4) -> Column:
    """The year a business year starts in; April by default."""
    value = F.col(day) if isinstance(day, str) else day
    return F.year(F.add_months(value, 1 - first_month))


def file_columns(
    path: str | Column = "_metadata.file_path",
    date_pattern: str = r"(\d{4}-?\d{2}-?\d{2})",
    first_month: int = 4,
) -> dict[str, Column]:
    """filePath, fileName, fileDate and businessYear from a file path.

    The date is the first match of ``date_pattern`` in the file name, with or
    without dashes; names without a valid date give NULL.
    """
    full = F.col(path) if isinstance(path, str) else path
    name = F.element_at(F.split(full, "/"), -1)
    digits = F.replace(F.regexp_extract(name, date_pattern, 1), F.lit("-"), F.lit(""))
    day = F.try_to_timestamp(F.nullif(digits, F.lit("")), F.lit("yyyyMMdd")).cast("date")
    return {
        "filePath": full,
        "fileName": name,
        "fileDate": day,
        "businessYear": business_year(day, first_month),
    }


def join_path(*parts: str | Column) -> Column:
    """``a/b/c`` from literals (str) and columns; NULL when any part is NULL."""
    pieces: list[Column] = []
    for part in parts:
        if pieces:
            pieces.append(F.lit("/"))
        pieces.append(F.lit(part) if isinstance(part, str) else part)
    return F.concat(*pieces)
