"""Incremental reads: new files only, by modification time or by processing log."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.catalogue import FileFormat
from millrace.functions.columns import time_literal
from millrace.operators.projection import add_extra_columns
from millrace.operators.watermark import OLDEST_FILE_MARK
from millrace.sinks import folders
from millrace.sources.delimited import check_headers, read_many
from millrace.sources.files import read_files
from millrace.sources.multiline import read_multiline, splits
from millrace.sources.processing_log import file_list, files_to_process, log_path, read_log
from millrace.sources.repair import read_repaired

_DELIMITED = ("csv", "txt", "dat", "tsv")


@dataclass(frozen=True)
class RawEntity:
    """Where an entity's raw files are and how they are written."""

    path: str
    name: str = ""
    fmt: FileFormat = field(default_factory=FileFormat)
    log: str | None = None

    @property
    def log_folder(self) -> str:
        return self.log or log_path(self.path, self.name)


def newer_than(df: DataFrame, mark: str | None) -> DataFrame:
    """Rows of files modified after the mark. Spark skips older files before opening them."""
    return df.filter(F.col("file_modification_time") > time_literal(mark or OLDEST_FILE_MARK))


def entity_paths(spark: SparkSession, entity: RawEntity, path_filter: str | None = None) -> str | list[str]:
    """What to read of an entity: its folder or a glob below it, without a processing log that lies beside the files."""
    if path_filter:
        return f"{entity.path}{path_filter}"
    names = folders.children(spark, entity.path)
    if not any(name.endswith(".meta") for name in names):
        return entity.path
    return [f"{entity.path}/{name}" for name in names if not name.endswith(".meta") and name[0] not in "._"]


def read_entity_files(
    spark: SparkSession, entity: RawEntity, paths: str | Sequence[str], by_name: bool = False
) -> DataFrame:
    """Files of an entity by its format, repaired where the format says so, with lineage columns.

    Files of delimited text must agree on their columns and their order, else the
    read stops; with ``by_name`` listed files are united by column name.
    """
    # Files named one by one keep the partition columns of the entity's folders.
    options = {} if isinstance(paths, str) else {"basePath": entity.path}
    if entity.fmt.nul_interleaved:
        mode = "FAILFAST" if entity.fmt.fail_fast else "PERMISSIVE"
        return read_repaired(spark, paths, entity.fmt.delimiter, entity.fmt.encoding or "UTF-16LE", mode=mode)
    if entity.fmt.read_format in _DELIMITED:
        if splits(spark, paths, entity.fmt) and not (by_name and not isinstance(paths, str)):
            return read_multiline(spark, paths, entity.fmt)
        if by_name and not isinstance(paths, str):
            return read_many(spark, paths, entity.fmt, by_name=True)
        return check_headers(spark, paths, entity.fmt, **options)
    return read_files(spark, paths, entity.fmt, lineage=True, **options)


def incremental_read(
    spark: SparkSession,
    entity: RawEntity,
    hwm: str | None = None,
    path_filter: str | None = None,
    extra_columns: Sequence[str] = (),
    upper: str | None = None,
    run_ts=None,
    by_name: bool = False,
) -> DataFrame | None:
    """New data of an entity.

    With ``path_filter`` (a glob below the entity's folder): files modified
    after the mark. Without: files the processing log lists between the marks,
    ``None`` when there are none.
    """
    if path_filter and path_filter.strip():
        frame = newer_than(read_entity_files(spark, entity, f"{entity.path.rstrip('/')}{path_filter}"), hwm)
    else:
        files = file_list(files_to_process(read_log(spark, entity.log_folder), entity.path, hwm, upper))
        if not files:
            return None
        frame = read_entity_files(spark, entity, files, by_name)
    return add_extra_columns(frame, extra_columns, run_ts)
