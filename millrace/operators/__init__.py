"""Operators: every one takes DataFrames and returns a DataFrame."""

from millrace.operators.casting import CastOutcome, cast_attributes, cast_outcome, cast_report
from millrace.operators.cleansing import TRANSFORMATIONS, CleansingContext, dedupe_by_key
from millrace.operators.merge import (
    append_all,
    current_versions,
    find_changes,
    merge_active,
    merge_into,
    outcome_counts,
    quarantined,
    retention_purge,
    scd1_upsert,
    scd2_expire,
    scd2_insert,
    scd2_merge,
    scd2_metrics,
)
from millrace.operators.pipeline import apply_pipeline, register_action, register_transformation
from millrace.operators.projection import (
    add_audit_columns,
    add_extra_columns,
    add_history_columns,
    order_columns,
)
from millrace.operators.watermark import (
    HwmPolicy,
    change_data,
    filter_hwm,
    filter_text,
    latest_marks,
    max_modified,
    next_hwm,
)

__all__ = [
    "CastOutcome", "CleansingContext", "HwmPolicy", "TRANSFORMATIONS", "add_audit_columns",
    "add_extra_columns", "add_history_columns", "append_all", "apply_pipeline", "cast_attributes",
    "cast_outcome", "cast_report", "change_data", "current_versions", "dedupe_by_key", "filter_hwm",
    "filter_text", "find_changes", "latest_marks", "max_modified", "merge_active", "merge_into",
    "next_hwm", "order_columns", "outcome_counts", "quarantined", "register_action",
    "register_transformation", "retention_purge", "scd1_upsert", "scd2_expire", "scd2_insert",
    "scd2_merge", "scd2_metrics",
]
