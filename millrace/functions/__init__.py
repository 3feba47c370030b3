"""Column-level building blocks."""

from millrace.functions.columns import (
    business_year,
    file_columns,
    hash_key,
    join_path,
    mask_column,
    time_literal,
)
from millrace.functions.predicates import (
    DEFAULT_EXCLUDE,
    changed,
    changed_plain,
    change_columns,
    expired_before,
    is_active,
    is_closed,
)
from millrace.functions.types import resolve_type, same_type

__all__ = [
    "DEFAULT_EXCLUDE", "business_year", "change_columns", "changed", "changed_plain",
    "expired_before", "file_columns", "hash_key", "is_active", "is_closed", "join_path", "mask_column",
    "resolve_type", "same_type", "time_literal",
]
