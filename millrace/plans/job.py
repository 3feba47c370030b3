"""A configured load: read new data, cleanse it, merge it, store the mark."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from millrace.catalogue import Catalogue, FileFormat, as_flag, catalogue_from, load_properties, lookup
from millrace.operators.cleansing import CleansingContext
from millrace.operators.pipeline import apply_pipeline, find_actions
from millrace.operators.projection import add_audit_columns, add_history_columns, order_columns
from millrace.operators.pushdown import past_mark
from millrace.operators.watermark import HwmPolicy, filter_hwm, next_mark_column
from millrace.session import work_path
from millrace.sinks import folders
from millrace.sinks.history_table import HistoryTable, MergeCounts, history_schema
from millrace.sinks.state import HwmState
from millrace.sinks.targets import column_list, write_target
from millrace.sources.files import empty_like, read_files
from millrace.sources.incremental import RawEntity, entity_paths, incremental_read, read_entity_files

logger = logging.getLogger(__name__)


@dataclass(frozen=True)
class JobConfig:
    """Everything a load needs."""

    entity: str
    catalogue: Catalogue
    source: RawEntity
    target_path: str
    state_path: str
    policy: HwmPolicy = field(default_factory=lambda: HwmPolicy("file_mtime", next="run_ts"))
    source_name: str | None = None
    path_filter: str | None = None
    process: str = "scd2"
    actions: tuple[str, ...] = ()
    default_tz: str | None = None
    on_error: str = "null"
    duplicates: str | tuple[str, ...] = "fail"
    null_keys: str = "insert"
    retention_days: int | None = None
    #: Layout of a target that is created: columns it is partitioned by, or buckets of its natural key.
    partition_by: tuple[str, ...] = ()
    buckets: int = 0
    properties_root: str | None = None
    #: Lets a date or timestamp mark reach the scan through the declared steps. Rows and files behind it are then not read, so
    #: they count neither as read nor among failed casts.
    push_mark: bool = False
    #: Further sources of the same target, each with the name its mark is kept under.
    more_sources: tuple[tuple[RawEntity, str | None], ...] = ()
    #: Reads sources that are not files, e.g. ``lambda spark, mark: read_jdbc(…)``.
    reader: Callable[[SparkSession, str], DataFrame | None] | None = None

    def __post_init__(self) -> None:
        if not self.entity:
            raise ValueError("a job needs an entity name")
        if not self.catalogue.natural_key:
            raise ValueError(f"entity {self.entity}: Catalogue.Schema.NaturalKey is missing")

    @staticmethod
    def from_documents(
        entity: str,
        sink: Mapping | str,
        source: Mapping | str | Sequence[Mapping | str],
        raw_root: str,
        target_root: str,
        state_path: str,
        spark: SparkSession | None = None,
        **overrides,
    ) -> "JobConfig":
        """From the sink's and the source's properties documents.

        A target with several source entities takes their documents in the same
        order; each source keeps a mark of its own. Retention is read from the first source
        document; override it with ``retention_days``.
        """
        sink_doc = load_properties(sink, spark)
        many = [source] if isinstance(source, (str, Mapping)) else list(source)
        source_docs = [load_properties(s, spark) for s in many]
        source_doc = source_docs[0]
        cleanse = lookup(sink_doc, "Extended.Cleanse", {})
        days = lookup(source_doc, "System.AllowedRetention")
        keep = days if as_flag(lookup(source_doc, "System.IsHousekeepingEnabled")) else None
        sources = lookup(cleanse, "SourceEntities", ())
        if len(source_docs) > 1 and len(sources) != len(source_docs):
            raise ValueError(f"{len(source_docs)} source documents for {len(sources)} source entities")
        raw = [
            RawEntity(
                path=f"{raw_root.rstrip('/')}/{lookup(doc, 'System.EntityPath', '')}".rstrip("/"),
                name=lookup(doc, "System.EntityName", ""),
                fmt=FileFormat.from_document(doc),
            )
            for doc in source_docs
        ]
        values = dict(
            entity=entity,
            catalogue=catalogue_from(sink_doc, entity),
            source=raw[0],
            more_sources=tuple((r, lookup(s, "EFQN")) for r, s in zip(raw[1:], sources[1:])),
            process=lookup(cleanse, "TargetProcess") or "scd2",
            target_path=f"{target_root.rstrip('/')}/{lookup(sink_doc, 'System.EntityPath', entity)}",
            state_path=state_path,
            source_name=lookup(sources[0], "EFQN") if sources else lookup(cleanse, "SourceEntityName"),
            path_filter=lookup(cleanse, "SourceFilePathFilter"),
            actions=tuple(lookup(cleanse, "ActionFunctions", ())),
            retention_days=int(keep) if keep else None,
            partition_by=column_list(lookup(sink_doc, "System.PartitionKey")),
            push_mark=as_flag(lookup(cleanse, "PushHighWaterMark"), False),
        )
        return JobConfig(**{**values, **overrides})


@dataclass
class JobResult:
    """What a load did."""

    entity: str
    rows_read: int = 0
    rows_staged: int = 0
    counts: MergeCounts = field(default_factory=MergeCounts)
    hwm: str | None = None
    purged: list[str] = field(default_factory=list)
    purge_error: str | None = None
    #: Values that a cast could not read and made NULL, by column; columns without any are left out.
    cast_failures: dict[str, int] = field(default_factory=dict)


def read_source(spark: SparkSession, config: JobConfig, mark: str, run_ts: str) -> DataFrame | None:
    """New raw data. The file-time policy skips files here; a date mark is carried to the scan when the batch is staged."""
    if config.reader is not None:
        raw = config.reader(spark, mark)
        return filter_hwm(raw, config.policy, mark) if config.policy.kind == "audit" else raw
    if config.policy.kind == "file_mtime":
        return incremental_read(spark, config.source, mark, config.path_filter, run_ts=run_ts)
    if config.policy.kind == "audit":
        # The source table's own audit columns decide, so filter at the scan.
        return filter_hwm(read_files(spark, config.source.path, config.source.fmt), config.policy, mark)
    return read_entity_files(spark, config.source, entity_paths(spark, config.source, config.path_filter))


def cleanse(df: DataFrame, config: JobConfig, run_ts: str, cast_failures: list[Observation] | None = None) -> DataFrame:
    """Declared transformations, then audit columns where they are not defined."""
    context = cleansing_context(config, cast_failures)
    return add_audit_columns(apply_pipeline(df, config.catalogue.transformations, context=context), run_ts)


def cleansing_context(config: JobConfig, cast_failures: list[Observation] | None = None) -> CleansingContext:
    return CleansingContext(
        catalogue=config.catalogue, default_tz=config.default_tz, on_error=config.on_error,
        properties_root=config.properties_root, cast_failures=cast_failures,
    )


def target_table(spark: SparkSession, config: JobConfig) -> HistoryTable:
    """The target, created when absent; raises when it lacks catalogue columns, which would be lost.

    A table that exists keeps the layout it was created with.
    """
    wanted = history_schema(config.catalogue.schema)
    keys = config.catalogue.natural_key
    table = HistoryTable(spark, config.target_path, wanted, config.buckets, keys, config.partition_by).create()
    stored = {name.lower() for name in table.schema.names}
    absent = [name for name in wanted.names if name.lower() not in stored]
    if absent:
        raise ValueError(f"the table at {config.target_path} lacks the catalogue columns {absent}")
    return table


@dataclass
class Staged:
    """A batch written to the shared folder, with what was counted on the way."""

    frame: DataFrame
    path: str
    rows_read: int
    rows: int
    next_mark: str | None
    cast_failures: dict[str, int] = field(default_factory=dict)

    def discard(self) -> None:
        folders.remove(self.frame.sparkSession, self.path)


def stage(raw: DataFrame, config: JobConfig, mark: str, run_ts: str, target_columns: Sequence[str]) -> Staged:
    """Cleanse, filter by the mark, order columns, and write the batch once.

    Row counts, the next mark and the number of values that casts lost come from the same pass. The written batch
    gives the merge exact sizes and cuts the lineage, so a lost executor costs
    a re-read of the batch and not of the raw files.
    """
    spark = raw.sparkSession
    if config.push_mark and config.policy.kind in ("date", "timestamp"):
        # Ahead of the counts, which filters don't pass.
        raw = past_mark(raw, config.catalogue.transformations, config.policy, mark, cleansing_context(config))
    read_seen, staged_seen = Observation("read"), Observation("staged")
    casts_seen: list[Observation] = []
    frame = cleanse(raw.observe(read_seen, F.count(F.lit(1)).alias("rows")), config, run_ts, casts_seen)
    if config.policy.kind in ("date", "timestamp"):
        frame = filter_hwm(frame, config.policy, mark)
    metrics = [F.count(F.lit(1)).alias("rows")]
    if config.policy.next == "max":
        # Before the projection: the compared column may not be in the catalogue.
        metrics.append(next_mark_column(frame, config.policy).alias("mark"))
    frame = frame.observe(staged_seen, *metrics)
    frame = order_columns(add_history_columns(frame, run_ts), target_columns)
    path = work_path(spark, "staged")
    frame.write.parquet(path)
    counted = staged_seen.get
    return Staged(
        frame=spark.read.schema(frame.schema).parquet(path),
        path=path,
        rows_read=read_seen.get["rows"],
        rows=counted["rows"],
        next_mark=counted.get("mark"),
        cast_failures={n: v for seen in casts_seen for n, v in seen.get.items() if v and n != "_rows"},
    )


def run_job(spark: SparkSession, config: JobConfig, run_ts: str | datetime | None = None) -> JobResult:
    """One load from read to stored mark, of all sources one after the other.

    The next mark becomes visible together with the rows it stands for, and is stored for other
    readers afterwards: a load that is repeated after a crash between the two finds nothing left to do.
    ``run_ts`` is the one time used for audit, start and end times; it is taken before the read.
    """
    if run_ts is None:
        run_ts = datetime.now(timezone.utc)
    stamp = run_ts.isoformat() if isinstance(run_ts, datetime) else str(run_ts)
    table = target_table(spark, config)
    result = JobResult(config.entity)
    for source, name in ((config.source, config.source_name), *config.more_sources):
        _load_source(spark, replace(config, source=source, source_name=name, more_sources=()), table, stamp, result)
    purge(table, config, stamp, result)
    if result.cast_failures:
        logger.warning("load of %s: unreadable values became NULL: %s", config.entity, result.cast_failures)
    logger.info("load of %s: %s", config.entity, result)
    return result


def progress_key(config: JobConfig) -> str:
    """Where a target keeps the note of how far a source has been loaded."""
    return f"{config.entity}|{config.source_name or ''}"


def current_mark(spark: SparkSession, config: JobConfig, table: HistoryTable) -> str:
    """The stored mark, or the one published with the table's rows where the load that did so could not store it."""
    state = HwmState(spark, config.state_path)
    note = table.published(progress_key(config))
    if note and not state.has(config.entity, config.source_name, note["written_at"]):
        return state.write(config.entity, note["hwm"], note["rows"], config.source_name, note["written_at"])
    return state.read(config.entity, config.source_name)


def _load_source(spark: SparkSession, config: JobConfig, table: HistoryTable, stamp: str, result: JobResult) -> None:
    mark = current_mark(spark, config, table)
    result.hwm = mark
    raw = read_source(spark, config, mark, stamp)
    if raw is None:
        return
    staged = stage(raw, config, mark, stamp, table.schema.names)
    try:
        result.rows_read += staged.rows_read
        result.rows_staged += staged.rows
        for name, lost in staged.cast_failures.items():
            result.cast_failures[name] = result.cast_failures.get(name, 0) + lost
        if staged.rows:
            batch = run_actions(staged.frame, config)
            known = None if config.actions else staged.rows
            next_mark = stamp if config.policy.next == "run_ts" else staged.next_mark or mark
            note = {"hwm": next_mark, "rows": staged.rows, "written_at": stamp}
            counts = apply_batch(batch, table, config, stamp, known, {progress_key(config): note})
            result.counts = result.counts + counts
            state = HwmState(spark, config.state_path)
            result.hwm = state.write(config.entity, next_mark, counts.affected, config.source_name, stamp)
    finally:
        staged.discard()


def purge(table: HistoryTable, config: JobConfig, stamp: str, result: JobResult) -> None:
    """Retention, where the job asks for it."""
    if config.retention_days:
        try:
            result.purged = table.purge(config.retention_days, stamp)
        except Exception as error:  # retention must not fail a finished load
            logger.warning("retention skipped for %s: %s", config.entity, error)
            result.purge_error = str(error)


def run_actions(df: DataFrame, config: JobConfig) -> DataFrame:
    """Named actions of the properties document, in order."""
    for action in find_actions(config.actions) if config.actions else []:
        df = action(df, config)
    return df


def apply_batch(
    batch: DataFrame, table: HistoryTable, config: JobConfig, run_ts: str, known_rows: int | None = None,
    progress: dict | None = None,
) -> MergeCounts:
    """Write a cleansed batch to the target by the job's process."""
    options = {}
    if config.process.lower() in ("scd2", "merge", "upsert"):
        options = {"duplicates": config.duplicates, "null_keys": config.null_keys}
    keys = config.catalogue.natural_key
    return write_target(batch, table, config.process, keys, run_ts, known_rows, progress, **options)


def empty_batch(spark: SparkSession, config: JobConfig) -> DataFrame:
    """No rows in the target's schema."""
    return empty_like(spark, history_schema(config.catalogue.schema))
