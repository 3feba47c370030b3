"""Column order, audit columns and history columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from millrace.catalogue import Catalogue
from millrace.functions.columns import time_literal

START, END, ACTIVE = "EffectiveStartDate", "EffectiveEndDate", "IsActive"
INSERTED, UPDATED = "InsertedDateTime", "UpdatedDateTime"
HISTORY_COLUMNS = (START, END, ACTIVE)


def _names(df: DataFrame) -> dict[str, str]:
    return {c.lower(): c for c in df.columns}


def order_columns(df: DataFrame, catalogue: Catalogue | Sequence[str]) -> DataFrame:
    """Catalogue columns the frame has, in catalogue order and catalogue case.

    Frame columns outside the catalogue are dropped, catalogue columns the
    frame lacks are skipped.
    """
    wanted = catalogue.column_names if isinstance(catalogue, Catalogue) else catalogue
    present = _names(df)
    return df.select(*[
        F.col(f"`{present[name.lower()]}`").alias(name) for name in wanted if name.lower() in present
    ])


def add_audit_columns(df: DataFrame, run_ts=None) -> DataFrame:
    """InsertedDateTime and UpdatedDateTime, where the frame lacks them."""
    present = _names(df)
    stamp = time_literal(run_ts)
    return df.withColumns({name: stamp for name in (INSERTED, UPDATED) if name.lower() not in present})


def add_history_columns(df: DataFrame, run_ts=None) -> DataFrame:
    """Start, end and active flag of a new version, where the frame lacks them.

    The start is InsertedDateTime when the row has one, else the run's time.
    """
    present = _names(df)
    stamp = time_literal(run_ts)
    if INSERTED.lower() in present:
        stamp = F.coalesce(F.col(f"`{present[INSERTED.lower()]}`").cast("timestamp"), stamp)
    columns = {START: stamp, END: F.lit(None).cast("timestamp"), ACTIVE: F.lit(True)}
    return df.withColumns({name: c for name, c in columns.items() if name.lower() not in present})


def add_extra_columns(df: DataFrame, extra: Sequence[str], run_ts=None) -> DataFrame:
    """The optional read-time columns that ``extra`` names."""
    stamp = time_literal(run_ts)
    known = {"MemberType": F.lit("Standard"), INSERTED: stamp, UPDATED: stamp}
    unknown = [name for name in extra if name not in known]
    if unknown:
        raise ValueError(f"unknown extra columns {unknown}: choose from {sorted(known)}")
    return df.withColumns({name: known[name] for name in extra})
