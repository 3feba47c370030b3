"""Predicates over history tables."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, functions as F

from millrace.functions.columns import time_literal

# Columns that change on every load and never mean a new version
# (compared in lower case).
DEFAULT_EXCLUDE = (
    "effectivestartdate",
    "effectiveenddate",
    "isactive",
    "inserteddatetime",
    "updateddatetime",
    "filepath",
    "filename",
    "filedate",
    "businessyear",
    "hashedkey",
)


def change_columns(columns: Iterable[str], keys: Sequence[str] = (), exclude: Iterable[str] = DEFAULT_EXCLUDE) -> list[str]:
    """The columns whose change makes a new version.

    Keys are equal on matched rows, so comparing them is left out. Raises when
    nothing is left, because then no change would ever be seen.
    """
    skipped = {c.lower() for c in exclude} | {k.lower() for k in keys}
    kept = [c for c in columns if c.lower() not in skipped]
    if not kept:
        raise ValueError("no columns left for change detection: too many are excluded")
    return kept


def _any_of(terms: list[Column]) -> Column:
    # A balanced tree keeps the expression shallow for tables of hundreds of columns.
    while len(terms) > 1:
        paired = [a | b for a, b in zip(terms[::2], terms[1::2])]
        if len(terms) % 2:
            paired.append(terms[-1])
        terms = paired
    return terms[0]


def changed(pairs: Iterable[tuple[Column, Column]]) -> Column:
    """NULL-safe: true when any pair differs, NULL against a value included."""
    terms = [~sink.eqNullSafe(source) for sink, source in pairs]
    if not terms:
        raise ValueError("change detection needs at least one column")
    return _any_of(terms)


def changed_plain(pairs: Iterable[tuple[Column, Column]]) -> Column:
    """The ``<>`` form: misses every change from or to NULL. For comparison only."""
    terms = [sink != source for sink, source in pairs]
    if not terms:
        raise ValueError("change detection needs at least one column")
    return _any_of(terms)


def is_active(column: str = "IsActive") -> Column:
    """Filter for current versions; a NULL flag counts as not active. Reaches the scan."""
    return F.col(column) == F.lit(True)


def is_closed(column: str = "IsActive") -> Column:
    """Filter for all other versions. Reaches the scan."""
    return (F.col(column) == F.lit(False)) | F.col(column).isNull()


def expired_before(days: int, run_ts=None, active: str = "IsActive", end: str = "EffectiveEndDate") -> Column:
    """Inactive versions that ended more than ``days`` days before the run's date."""
    cutoff = F.date_sub(time_literal(run_ts).cast("date"), int(days))
    return ~F.coalesce(F.col(active), F.lit(True)) & (F.col(end) < cutoff)
