"""High-water marks: lower bound, filter, next value."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.columns import time_literal
from millrace.operators.projection import INSERTED, UPDATED

# Marks used where nothing has been stored.
FIRST_MARK = "1970-01-01T00:00:00.000+0000"
LAST_MARK = "3000-01-01T00:00:00.000+0000"
OLDEST_FILE_MARK = "1900-01-01 00:00:00.000"


@dataclass(frozen=True)
class HwmPolicy:
    """How a load finds new rows and what it stores afterwards.

    ``kind``: ``date`` compares the day of ``column``, ``timestamp`` its full
    value, ``file_mtime`` the file's modification time (before the read),
    ``audit`` the inserted/updated times. ``next``: ``max`` of the compared
    values, or ``run_ts``. ``inclusive`` also takes rows equal to the mark, so
    that late arrivals of the same day are seen; the merge absorbs repeats.
    """

    kind: str = "date"
    column: str = "fileDate"
    next: str = "max"
    inclusive: bool = False

    def __post_init__(self) -> None:
        if self.kind not in ("date", "timestamp", "file_mtime", "audit"):
            raise ValueError(f"unknown high-water mark kind {self.kind!r}")
        if self.next not in ("max", "run_ts"):
            raise ValueError("next must be 'max' or 'run_ts'")


def _day(mark: str) -> Column:
    return F.lit(str(mark)[:10]).cast("date")


def _has(df: DataFrame, column: str) -> bool:
    return column.lower() in {c.lower() for c in df.columns}


def change_filter(
    df: DataFrame, lower: str, upper: str | None = None, inserted: str = INSERTED, updated: str = UPDATED
) -> Column | None:
    """Rows inserted or updated after ``lower`` and not after ``upper``; None without audit columns."""
    low = time_literal(lower)
    high = None if upper is None else time_literal(upper)
    test: Column | None = None
    for name in (inserted, updated):
        if not _has(df, name):
            continue
        inside = F.col(name) > low
        if high is not None:
            inside = inside & (F.col(name) <= high)
        test = inside if test is None else test | inside
    return test


def change_data(
    df: DataFrame, lower: str, upper: str | None = None, inserted: str = INSERTED, updated: str = UPDATED
) -> DataFrame:
    """The change increment of a table; the whole table when it has no audit columns."""
    test = change_filter(df, lower, upper, inserted, updated)
    return df if test is None else df.filter(test)


def filter_text(df: DataFrame, predicate: str | None) -> DataFrame:
    """Filter by SQL text, or not at all when it is blank."""
    return df.filter(predicate) if predicate and predicate.strip() else df


def filter_hwm(df: DataFrame, policy: HwmPolicy, mark: str) -> DataFrame:
    """Rows past the mark; all rows when the compared column is absent."""
    if policy.kind == "audit":
        return change_data(df, mark)
    if policy.kind == "file_mtime":
        column = "file_modification_time"
        bound = time_literal(mark)
    else:
        column = policy.column
        bound = _day(mark) if policy.kind == "date" else time_literal(mark)
    if not _has(df, column):
        return df
    value = F.col(column).cast("date") if policy.kind == "date" else F.col(column)
    return df.filter(value >= bound if policy.inclusive else value > bound)


def next_mark_column(df: DataFrame, policy: HwmPolicy) -> Column:
    """The aggregate that gives a load's next mark as text; NULL for no rows."""
    if policy.kind == "audit":
        tops = [F.max(F.col(c)) for c in (INSERTED, UPDATED) if _has(df, c)]
        if not tops:
            return F.lit(None).cast("string")
        return (F.greatest(*tops) if len(tops) > 1 else tops[0]).cast("string")
    column = "file_modification_time" if policy.kind == "file_mtime" else policy.column
    if not _has(df, column):
        return F.lit(None).cast("string")
    value = F.col(column).cast("date") if policy.kind == "date" else F.col(column)
    return F.max(value).cast("string")


def next_hwm(df: DataFrame, policy: HwmPolicy, current: str, run_ts=None) -> DataFrame:
    """One row with the mark to store: ``current`` stays when there was nothing new."""
    if policy.next == "run_ts":
        mark = F.when(F.count(F.lit(1)) > 0, time_literal(run_ts).cast("string"))
    else:
        mark = next_mark_column(df, policy)
    return df.agg(F.coalesce(mark, F.lit(current)).alias("next_hwm"))


def max_modified(df: DataFrame, inserted: str = INSERTED, updated: str = UPDATED) -> DataFrame:
    """One row: the latest insert or update time of a table."""
    return df.agg(F.greatest(F.max(inserted), F.max(updated)).alias("max_modified"))


def latest_marks(state: DataFrame) -> DataFrame:
    """The latest stored mark per entity and source from the state table.

    ``max_by`` aggregates partially, so a busy entity does not gather in one task.
    """
    return state.groupBy("entity", "source").agg(
        F.max_by("hwm", F.struct("written_at", "hwm")).alias("hwm"), F.max("written_at").alias("written_at")
    )
