"""Writing a change frame to its target, and table creation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from millrace.catalogue import Catalogue, FileFormat
from millrace.operators.merge import INSERTED, KEPT, OUTCOME, UPDATED_ROW, align, count_outcome, scd1_upsert
from millrace.operators.projection import add_history_columns
from millrace.sinks.history_table import HistoryTable, MergeCounts
from millrace.sources.delimited import write_delimited

# Target process names, compared in lower case.
OVERWRITE_NAMES = ("overwrite", "truncatereload")
APPEND_NAMES = ("append", "insert")
UPSERT_NAMES = ("merge", "upsert")
HISTORY_NAMES = ("scd2",)


def _observed(df: DataFrame) -> tuple[DataFrame, Observation]:
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def output_path(folder: str, entity: str, extension: str) -> str:
    """``{folder}/{entity}.{extension}``; a dot in the extension is not doubled."""
    return f"{folder.rstrip('/')}/{entity}.{extension.lstrip('.')}"


def write_delimited_target(
    df: DataFrame | None, path: str, process: str, fmt: FileFormat | None = None
) -> int:
    """Write to a delimited folder and return the rows written.

    Delimited targets can only be overwritten. ``None`` or an empty frame
    leaves the target alone and counts zero rows.
    """
    if df is None or df.isEmpty():
        return 0
    if process.strip().lower() not in OVERWRITE_NAMES:
        raise ValueError(f"process {process!r} is not supported on a delimited target")
    counted, seen = _observed(df)
    write_delimited(counted, path, fmt)
    return seen.get["rows"]


def write_target(
    df: DataFrame | None,
    table: HistoryTable,
    process: str,
    keys: Sequence[str] = (),
    run_ts=None,
    known_rows: int | None = None,
    progress: dict | None = None,
    **options,
) -> MergeCounts:
    """Apply a change frame to a history table by process name.

    overwrite, append (every row a new version), upsert (update in place) or
    scd2 (new versions for changes). An empty frame leaves the table alone;
    give ``known_rows`` where it is known, to save looking.
    """
    if df is None or known_rows == 0 or (known_rows is None and df.isEmpty()):
        return MergeCounts()
    name = process.strip().lower()
    if name in HISTORY_NAMES:
        return table.merge(df, keys, run_ts, progress=progress, **options)
    staged = align(add_history_columns(df, run_ts), table.schema)
    if name in OVERWRITE_NAMES:
        counted, seen = _observed(staged)
        table.replace(counted, progress)
        return MergeCounts(inserted=seen.get["rows"])
    if name in APPEND_NAMES:
        counted, seen = _observed(staged)
        table.append(counted, progress)
        return MergeCounts(inserted=seen.get["rows"])
    if name in UPSERT_NAMES:
        touched, kept = table.touched(df, keys)
        merged = scd1_upsert(touched, add_history_columns(df, run_ts), keys, with_outcome=True, **options)
        seen = Observation()
        merged = merged.observe(seen, *[count_outcome(name) for name in (UPDATED_ROW, INSERTED, KEPT)])
        table.replace_active(merged.drop(OUTCOME), progress, kept)
        return MergeCounts(inserted=seen.get[INSERTED], unchanged=seen.get[KEPT], updated=seen.get[UPDATED_ROW])
    raise ValueError(f"unknown target process {process!r}")


def append_to_table(df: DataFrame, table: str) -> int:
    """Append rows to a catalog table by column name."""
    spark = df.sparkSession
    counted, seen = _observed(align(df, spark.table(table).schema))
    counted.write.mode("append").insertInto(table)
    return seen.get["rows"]


def column_list(names: str | Sequence[str] | None) -> tuple[str, ...]:
    """Column names from a comma list or a list; blank ones are left out."""
    parts = names.split(",") if isinstance(names, str) else list(names or [])
    return tuple(p.strip() for p in parts if p.strip())


def schema_ddl(schema: T.StructType) -> str:
    """Column list for CREATE TABLE."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def create_table(
    spark: SparkSession,
    name: str,
    catalogue: Catalogue | T.StructType,
    location: str | None = None,
    partition_by: str | Sequence[str] | None = None,
    table_format: str = "parquet",
) -> None:
    """Create the schema (database) and the table, unless they exist.

    ``location`` makes the table external; ``partition_by`` is a column, a
    comma list, or a list.
    """
    schema = catalogue.schema if isinstance(catalogue, Catalogue) else catalogue
    parts = column_list(partition_by)
    known = {n.lower(): n for n in schema.names}
    absent = [p for p in parts if p.lower() not in known]
    if absent:
        raise ValueError(f"partition columns {absent} are not in the catalogue")
    if "." in name:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name.rsplit('.', 1)[0]}")
    statement = f"CREATE TABLE IF NOT EXISTS {name} ({schema_ddl(schema)}) USING {table_format}"
    if parts:
        statement += f" PARTITIONED BY ({', '.join(f'`{known[p.lower()]}`' for p in parts)})"
    if location:
        statement += f" LOCATION '{location}'"
    spark.sql(statement)
