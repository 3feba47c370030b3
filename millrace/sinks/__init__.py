"""Sinks: history tables, delimited targets, catalog tables and stored marks."""

from millrace.sinks.history_table import HistoryTable, MergeCounts, history_schema
from millrace.sinks.state import HwmState
from millrace.sinks.targets import (
    append_to_table,
    create_table,
    output_path,
    schema_ddl,
    write_delimited_target,
    write_target,
)

__all__ = [
    "HistoryTable", "HwmState", "MergeCounts", "append_to_table", "create_table", "history_schema",
    "output_path", "schema_ddl", "write_delimited_target", "write_target",
]
