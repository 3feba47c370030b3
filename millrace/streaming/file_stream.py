"""The same load as a file stream.

The stream's checkpoint remembers which files were processed, in place of a
modification-time mark: each file is taken once, late files included.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from millrace.plans.job import JobConfig, JobResult, apply_batch, current_mark, progress_key, purge, run_actions, stage, target_table
from millrace.sinks.state import HwmState
from millrace.sources.delimited import csv_options
from millrace.sources.incremental import read_entity_files


def open_stream(spark: SparkSession, config: JobConfig, max_files: int | None = None) -> DataFrame:
    """New files of the source as a stream in the source's format, with lineage columns.

    Repaired and split files are put together from blocks of several tasks, which a stream cannot do.
    """
    fmt, path = config.source.fmt, f"{config.source.path}{config.path_filter or ''}"
    if fmt.nul_interleaved or (fmt.multiline and fmt.split_multiline):
        raise ValueError("files to be repaired or split cannot be read as a stream; use run_job")
    known = read_entity_files(spark, config.source, path)
    schema = known.drop("file_name", "file_modification_time").schema
    reader = spark.readStream.format(fmt.read_format).schema(schema)
    if fmt.read_format in ("csv", "txt", "dat", "tsv"):
        reader = reader.format("csv").options(**csv_options(fmt)).option("enforceSchema", "false")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path).select("*", "_metadata.file_name", "_metadata.file_modification_time")


def run_stream(
    spark: SparkSession,
    config: JobConfig,
    checkpoint: str,
    run_ts: str | None = None,
    max_files: int | None = None,
    continuous: str | None = None,
) -> StreamingQuery:
    """Merge new files into the target, then stop (or keep polling every ``continuous``).

    A batch's number and its mark are published with its rows, in one step: a batch that is replayed after a
    failure is passed over, and the mark it could not store is stored then. Each batch stores a mark (the run's time)
    and its rows, and retention runs after it, as in :func:`run_job`. Which files are new is the checkpoint's to say: date marks apply to
    the rows of each batch.
    """
    if config.more_sources:
        raise ValueError("a stream reads one source; start one for each")
    table = target_table(spark, config)
    names = table.schema.names
    key = f"stream|{config.entity}|{config.source_name or ''}|{checkpoint}"

    def merge_batch(raw: DataFrame, batch_id: int) -> None:
        done = table.published(key)
        mark = current_mark(raw.sparkSession, config, table)
        if done and done["batch"] >= batch_id:
            return
        stamp = run_ts or datetime.now(timezone.utc).isoformat()
        staged = stage(raw, config, mark, stamp, names)
        try:
            if staged.rows:
                next_mark = stamp if config.policy.next == "run_ts" else staged.next_mark or mark
                note = {"hwm": next_mark, "rows": staged.rows, "written_at": stamp}
                counts = apply_batch(
                    run_actions(staged.frame, config), table, config, stamp, None if config.actions else staged.rows,
                    progress={key: {"batch": batch_id}, progress_key(config): note},
                )
                HwmState(raw.sparkSession, config.state_path).write(
                    config.entity, next_mark, counts.affected, config.source_name, stamp
                )
        finally:
            staged.discard()
        purge(table, config, stamp, JobResult(config.entity))

    writer = open_stream(spark, config, max_files).writeStream.foreachBatch(merge_batch)
    writer = writer.option("checkpointLocation", checkpoint)
    trigger = {"processingTime": continuous} if continuous else {"availableNow": True}
    return writer.trigger(**trigger).start()
