"""High-water marks, the processing log, and whole loads."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.catalogue import FileFormat, catalogue_from
from millrace.operators.watermark import (
    HwmPolicy,
    change_data,
    filter_hwm,
    filter_text,
    latest_marks,
    max_modified,
    next_hwm,
)
from millrace.operators.pipeline import register_action
from millrace.plans.job import JobConfig, JobResult, empty_batch, run_job
from millrace.session import work_path
from millrace.sinks import folders
from millrace.sinks.history_table import HistoryTable
from millrace.sinks.state import HwmState
from millrace.sinks.targets import write_target
from millrace.sources import RawEntity, append_log, files_to_process, read_log, write_delimited
from millrace.sources.incremental import read_entity_files
from millrace.streaming import run_stream
from showcase.fixtures import CUT, NTZ, raw_orders
from showcase.registry import query, table

_MARK = "2024-01-15T00:00:00.000+0000"


def _dated_events(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").withColumn("fileDate", F.col("ts").cast("date"))


@query("hwm_date_filter", """
SELECT *, CAST(ts AS DATE) AS "fileDate" FROM events WHERE CAST(ts AS DATE) > DATE '2024-01-15'""")
def hwm_date_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Strictly after the mark's day: rows of that day are not seen again."""
    return filter_hwm(_dated_events(spark, folder), HwmPolicy("date"), _MARK)


@query("hwm_timestamp_filter", """
SELECT *, CAST(ts AS DATE) AS "fileDate" FROM events WHERE ts >= TIMESTAMP '2024-01-15 00:00:00'""")
def hwm_timestamp_filter(spark: SparkSession, folder: str) -> DataFrame:
    return filter_hwm(_dated_events(spark, folder), HwmPolicy("timestamp", "ts", inclusive=True), _MARK)


@query("next_hwm", """
SELECT coalesce(CAST(max(CAST(ts AS DATE)) AS VARCHAR), '2024-01-15T00:00:00.000+0000') AS next_hwm
FROM events WHERE CAST(ts AS DATE) > DATE '2024-01-15'""")
def next_hwm_(spark: SparkSession, folder: str) -> DataFrame:
    policy = HwmPolicy("date", next="max")
    return next_hwm(filter_hwm(_dated_events(spark, folder), policy, _MARK), policy, _MARK)


def _audited_orders(spark: SparkSession, folder: str) -> DataFrame:
    updated = F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate") + F.expr("interval 30 days"))
    return table(spark, folder, "orders").select(
        "o_orderkey", F.col("o_orderdate").alias("InsertedDateTime"), updated.alias("UpdatedDateTime"))


_AUDITED_SQL = """audited AS (SELECT o_orderkey, o_orderdate AS "InsertedDateTime",
  CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 30 DAY END AS "UpdatedDateTime" FROM orders)"""


@query("change_data_filter", f"""WITH {_AUDITED_SQL}
SELECT * FROM audited WHERE ("InsertedDateTime" > TIMESTAMP '{CUT}' AND "InsertedDateTime" <= TIMESTAMP '2000-06-01'
   OR "UpdatedDateTime" > TIMESTAMP '{CUT}' AND "UpdatedDateTime" <= TIMESTAMP '2000-06-01') AND o_orderkey IS NOT NULL""")
def change_data_filter(spark: SparkSession, folder: str) -> DataFrame:
    changes = change_data(_audited_orders(spark, folder), f"{CUT} 00:00:00", "2000-06-01 00:00:00")
    return filter_text(filter_text(changes, "o_orderkey IS NOT NULL"), "  ")


@query("max_modified", f"""WITH {_AUDITED_SQL}
SELECT greatest(max("InsertedDateTime"), max("UpdatedDateTime")) AS max_modified FROM audited""")
def max_modified_(spark: SparkSession, folder: str) -> DataFrame:
    return max_modified(_audited_orders(spark, folder))


@query("hwm_state", """
SELECT event_type AS entity, CAST(user_id AS VARCHAR) AS source,
       CAST(max(CAST(ts AS DATE)) AS VARCHAR) AS hwm, max(ts) AS written_at
FROM events GROUP BY event_type, user_id""")
def hwm_state(spark: SparkSession, folder: str) -> DataFrame:
    state = table(spark, folder, "events").select(
        F.col("event_type").alias("entity"), F.col("user_id").cast("string").alias("source"),
        F.col("ts").cast("date").cast("string").alias("hwm"), F.col("ts").alias("written_at"),
    )
    return latest_marks(state)


def _event_log(spark: SparkSession, folder: str) -> DataFrame:
    """One log row per day of events and type; quiet groups count as empty files."""
    rows = table(spark, folder, "events").groupBy(F.col("ts").cast("date").alias("day"), "event_type").agg(
        F.count_if(F.col("value") > 0).cast("int").alias("NumberOfRows"),
        F.date_trunc("second", F.max("ts")).alias("ProcessedDateTime"),
    )
    return rows.select(
        F.date_format("day", "yyyy/MM/dd").alias("FilePath"), "NumberOfRows",
        F.concat("event_type", F.lit(".csv")).alias("FileName"), "ProcessedDateTime",
    )


@query("files_to_process", """
WITH log AS (
  SELECT strftime(CAST(ts AS DATE), '%Y/%m/%d') AS "FilePath", CAST(count(*) FILTER (value > 0) AS INTEGER) AS "NumberOfRows",
         event_type || '.csv' AS "FileName", date_trunc('second', max(ts))::TIMESTAMP AS "ProcessedDateTime"
  FROM events GROUP BY CAST(ts AS DATE), event_type)
SELECT *, 'raw/events/' || "FilePath" || '/' || "FileName" AS "FilePathName" FROM log
WHERE "NumberOfRows" > 0 AND "ProcessedDateTime" > TIMESTAMP '2024-01-10' AND "ProcessedDateTime" <= TIMESTAMP '2024-01-25'""")
def files_to_process_(spark: SparkSession, folder: str) -> DataFrame:
    path = work_path(spark, "events.meta")
    append_log(_event_log(spark, folder), path)
    found = files_to_process(read_log(spark, path), "raw/events", "2024-01-10 00:00:00", "2024-01-25 00:00:00")
    return found.withColumn("ProcessedDateTime", F.col("ProcessedDateTime").cast(NTZ))


_FORMAT = FileFormat(delimiter="|", multiline=False)

_JOB_DOCUMENT = {
    "Extended": {"Cleanse": {"CleansingTransformations": [
        {"RenameAttributes": "ORD_REF:OrderReference, CUST_REF:CustomerReference, STATUS_CD:Status, PRICE:Price, ORD_DT:OrderDate"},
        {"CastAttributes": "true"},
        {"CalculateAttribute": "hashedKey:sha2(concat_ws('||', OrderReference, CustomerReference), 256)"},
    ]}},
    "Catalogue": {"Schema": {"NaturalKey": ["OrderReference"], "Attributes": [
        {"Name": "OrderReference", "Type": "bigint"}, {"Name": "CustomerReference", "Type": "bigint"},
        {"Name": "OrderDate", "Type": "date", "Format": "dd/MM/yyyy"}, {"Name": "Status", "Type": "nvarchar"},
        {"Name": "Price", "Type": "decimal", "Precision": 12, "Scale": 2}, {"Name": "hashedKey", "Type": "string"},
    ]}},
}
_FIRST_TS, _SECOND_TS = "2024-01-01 06:00:00", "2024-02-01 06:00:00"


def _drops(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Two file drops: orders before the cut, then all of them with finished ones shipped."""
    raw = raw_orders(spark, folder).drop("ORD_TS")
    day = F.to_date("ORD_DT", "dd/MM/yyyy")
    first = raw.filter(day < F.lit(CUT).cast("date"))
    second = raw.withColumn("STATUS_CD", F.when(F.col("STATUS_CD") == "F", "S").otherwise(F.col("STATUS_CD")))
    return first, second


_LOADED_SQL = f"""WITH cleansed AS (
  SELECT o_orderkey AS "OrderReference", o_custkey AS "CustomerReference", CAST(o_orderdate AS DATE) AS "OrderDate",
         o_orderstatus AS status, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DECIMAL(12,2)) AS "Price",
         sha256(concat_ws('||', CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR))) AS "hashedKey",
         o_orderdate < TIMESTAMP '{CUT}' AS early
  FROM orders)
SELECT "OrderReference", "CustomerReference", "OrderDate", status AS "Status", "Price", "hashedKey",
       TIMESTAMP '{_FIRST_TS}' AS "InsertedDateTime",
       CASE WHEN status = 'F' THEN TIMESTAMP '{_SECOND_TS}' ELSE TIMESTAMP '{_FIRST_TS}' END AS "UpdatedDateTime",
       TIMESTAMP '{_FIRST_TS}' AS "EffectiveStartDate",
       CASE WHEN status = 'F' THEN TIMESTAMP '{_SECOND_TS}' END AS "EffectiveEndDate", status <> 'F' AS "IsActive"
FROM cleansed WHERE early
UNION ALL
SELECT "OrderReference", "CustomerReference", "OrderDate", CASE WHEN status = 'F' THEN 'S' ELSE status END, "Price", "hashedKey",
       TIMESTAMP '{_SECOND_TS}', TIMESTAMP '{_SECOND_TS}', TIMESTAMP '{_SECOND_TS}', CAST(NULL AS TIMESTAMP), TRUE
FROM cleansed WHERE NOT early OR status = 'F'"""


def _zoneless(df: DataFrame) -> DataFrame:
    return df.withColumns({n: F.col(n).cast(NTZ) for n, kind in df.dtypes if kind == "timestamp"})


def _config(spark: SparkSession, **overrides) -> JobConfig:
    root = work_path(spark, "load")
    config = JobConfig(
        entity="cleansed.sales.Orders", catalogue=catalogue_from(_JOB_DOCUMENT),
        source=RawEntity(f"{root}/raw/orders", "orders", _FORMAT), path_filter="/*",
        target_path=f"{root}/cleansed/orders", state_path=f"{root}/state",
    )
    return replace(config, **overrides)


_TIMES = (_FIRST_TS, _SECOND_TS, "2024-03-01 06:00:00")


def _three_loads(spark: SparkSession, folder: str, **overrides) -> tuple[JobConfig, list[JobResult]]:
    """Two drops and a load without a new file, with one state and one path filter."""
    config = _config(spark, **overrides)
    results = []
    for number, stamp in enumerate(_TIMES, start=1):
        if number <= 2:
            write_delimited(_drops(spark, folder)[number - 1], f"{config.source.path}/drop={number}", _FORMAT)
        results.append(run_job(spark, config, stamp))
        # File times are compared with the run's time, which these loads set by hand.
        _set_file_times(spark, config.source.path, stamp)
    return config, results


def _set_file_times(spark: SparkSession, path: str, stamp: str) -> None:
    """What has been loaded was modified before the load, what comes next after it."""
    moment = int(datetime.fromisoformat(f"{stamp}+00:00").timestamp() * 1000) - 1000
    for folder in folders.children(spark, path):
        for name in folders.children(spark, f"{path}/{folder}"):
            folders.set_time(spark, f"{path}/{folder}/{name}", moment)


@query("history_job", _LOADED_SQL)
def history_job(spark: SparkSession, folder: str) -> DataFrame:
    """Three configured loads by file time, from files to the stored history table; the third finds nothing new."""
    config, _ = _three_loads(spark, folder)
    return _zoneless(HistoryTable(spark, config.target_path).read())


@query("job_partitioned_target", _LOADED_SQL)
def job_partitioned_target(spark: SparkSession, folder: str) -> DataFrame:
    """The same loads into a target partitioned by a column whose value changes: touched partitions are replaced."""
    config, _ = _three_loads(spark, folder, partition_by=("Status",))
    return _zoneless(HistoryTable(spark, config.target_path).read())


_COUNTED_SQL = f"""WITH counted AS (
  SELECT count(*) AS n, count(*) FILTER (o_orderdate < TIMESTAMP '{CUT}') AS early,
         count(*) FILTER (o_orderdate < TIMESTAMP '{CUT}' AND o_orderstatus = 'F') AS again FROM orders)"""


@query("load_marks", f"""{_COUNTED_SQL}
SELECT 'cleansed.sales.Orders' AS entity, '{_FIRST_TS}' AS hwm, early AS rows_affected, TIMESTAMP '{_FIRST_TS}' AS written_at FROM counted
UNION ALL
SELECT 'cleansed.sales.Orders', '{_SECOND_TS}', n - early + 2 * again, TIMESTAMP '{_SECOND_TS}' FROM counted""")
def load_marks(spark: SparkSession, folder: str) -> DataFrame:
    """The marks and rows that three loads stored; a load without new rows stores none."""
    config, _ = _three_loads(spark, folder)
    return _zoneless(HwmState(spark, config.state_path).frame().drop("source"))


@query("load_counts", f"""{_COUNTED_SQL}
SELECT 1 AS load, early AS rows_read, early AS rows_staged, 0::BIGINT AS expired, early AS inserted, 0::BIGINT AS unchanged FROM counted
UNION ALL SELECT 2, n, n, again, n - early + again, early - again FROM counted
UNION ALL SELECT 3, 0, 0, 0, 0, 0""")
def load_counts(spark: SparkSession, folder: str) -> DataFrame:
    """What each of three loads counted while it wrote."""
    _, results = _three_loads(spark, folder)
    rows = [
        (n, r.rows_read, r.rows_staged, r.counts.expired, r.counts.inserted, r.counts.unchanged)
        for n, r in enumerate(results, start=1)
    ]
    kind = "load int, rows_read long, rows_staged long, expired long, inserted long, unchanged long"
    return spark.createDataFrame(rows, kind)


@query("append_repeated", f"""{_LOADED_SQL.split("SELECT \"OrderReference\"")[0]}
SELECT "OrderReference", "CustomerReference", "OrderDate", status AS "Status", "Price", "hashedKey",
       TIMESTAMP '{_FIRST_TS}' AS "InsertedDateTime", TIMESTAMP '{_FIRST_TS}' AS "UpdatedDateTime",
       TIMESTAMP '{_FIRST_TS}' AS "EffectiveStartDate", CAST(NULL AS TIMESTAMP) AS "EffectiveEndDate", TRUE AS "IsActive"
FROM cleansed WHERE early""")
def append_repeated(spark: SparkSession, folder: str) -> DataFrame:
    """An append is loaded, its stored mark is lost, and the load is repeated: no row comes twice."""
    config = _config(spark, process="append")
    write_delimited(_drops(spark, folder)[0], f"{config.source.path}/drop=1", _FORMAT)
    _set_file_times(spark, config.source.path, "2023-12-31 00:00:00")
    run_job(spark, config, _FIRST_TS)
    run_job(spark, replace(config, state_path=f"{config.state_path}-lost"), _SECOND_TS)
    return _zoneless(HistoryTable(spark, config.target_path).read())


@query("load_cast_failures", f"""
SELECT 'Price' AS column_name, count(*) FILTER (o_orderkey % 7 = 0) AS lost FROM orders WHERE o_orderdate < TIMESTAMP '{CUT}'
UNION ALL SELECT 'OrderDate', count(*) FILTER (o_orderstatus = 'P') FROM orders WHERE o_orderdate < TIMESTAMP '{CUT}'""")
def load_cast_failures(spark: SparkSession, folder: str) -> DataFrame:
    """A load tells how many values its casts could not read."""
    config = _config(spark)
    first, _ = _drops(spark, folder)
    spoilt = first.withColumn("PRICE", F.when(F.col("ORD_REF").cast("long") % 7 == 0, "n/a").otherwise(F.col("PRICE")))
    spoilt = spoilt.withColumn("ORD_DT", F.when(F.col("STATUS_CD") == "P", "soon").otherwise(F.col("ORD_DT")))
    write_delimited(spoilt, f"{config.source.path}/drop=1", _FORMAT)
    lost = run_job(spark, config, _FIRST_TS).cast_failures
    return spark.createDataFrame(sorted(lost.items()), "column_name string, lost long")


@query("empty_batch", f"{_LOADED_SQL.split('UNION ALL')[0]}".replace("CASE WHEN status = 'F' THEN TIMESTAMP '" + _SECOND_TS + "' ELSE TIMESTAMP '" + _FIRST_TS + "' END", f"TIMESTAMP '{_FIRST_TS}'")
       .replace("CASE WHEN status = 'F' THEN TIMESTAMP '" + _SECOND_TS + "' END", "CAST(NULL AS TIMESTAMP)").replace("status <> 'F'", "TRUE"))
def empty_batch_(spark: SparkSession, folder: str) -> DataFrame:
    """A load, then a batch without rows in the target's schema: the table stays as it is."""
    config = _config(spark)
    write_delimited(_drops(spark, folder)[0], f"{config.source.path}/drop=1", _FORMAT)
    run_job(spark, config, _FIRST_TS)
    table_ = HistoryTable(spark, config.target_path)
    before = table_.version
    write_target(empty_batch(spark, config), table_, "scd2", config.catalogue.natural_key, _SECOND_TS)
    write_target(None, table_, "append")
    if table_.version != before:
        raise AssertionError("an empty batch was published")
    return _zoneless(table_.read())


@query("action_by_name", f"""
SELECT o_orderkey AS "OrderReference", o_orderstatus AS "Status" FROM orders
WHERE o_orderdate < TIMESTAMP '{CUT}' AND o_orderstatus <> 'P'""")
def action_by_name(spark: SparkSession, folder: str) -> DataFrame:
    """A load whose document names an action; it leaves out rows that are pending."""
    register_action("withoutPending", lambda df, job: df.filter("Status <> 'P'"))
    config = _config(spark, actions=("withoutPending",))
    write_delimited(_drops(spark, folder)[0], f"{config.source.path}/drop=1", _FORMAT)
    run_job(spark, config, _FIRST_TS)
    return HistoryTable(spark, config.target_path).read().select("OrderReference", "Status")


@query("mark_by_role", """
SELECT event_type AS entity, role,
       CASE role WHEN 'source' THEN '2024-02-01 06:00:00' WHEN 'sink' THEN CAST(max(CAST(ts AS DATE)) AS VARCHAR)
                 ELSE '1970-01-01T00:00:00.000+0000' END AS hwm
FROM events, (VALUES ('source'), ('sink'), ('other')) AS roles(role) GROUP BY event_type, role""")
def mark_by_role(spark: SparkSession, folder: str) -> DataFrame:
    """A source's mark is the run's time, a sink's the stored one, any other's the first; stored for each type of event."""
    days = table(spark, folder, "events").groupBy("event_type").agg(F.max(F.col("ts").cast("date")).cast("string").alias("day"))
    state = HwmState(spark, work_path(spark, "state"))
    rows = []
    for kind, day in sorted(map(tuple, days.collect())):  # one row for each type of event
        state.write(kind, day, 1, run_ts=_FIRST_TS)
        rows += [(kind, role, state.for_role(role, kind, run_ts=_SECOND_TS)) for role in ("source", "sink", "other")]
    return spark.createDataFrame(rows, "entity string, role string, hwm string")


def _documents(process: str | None, *names: str) -> tuple[dict, list[dict]]:
    cleanse = dict(_JOB_DOCUMENT["Extended"]["Cleanse"], SourceEntities=[{"EFQN": n} for n in names], SourceFilePathFilter="/*")
    if process:
        cleanse["TargetProcess"] = process
    sink = dict(_JOB_DOCUMENT, Extended={"Cleanse": cleanse}, System={"EntityPath": "cleansed/orders"})
    layout = {"Extension": ".csv", "ColumnDelimiter": "|", "Header": "true", "MultiLine": "false"}
    return sink, [{"System": {"EntityPath": n, "EntityName": n, "FileFormat": layout}} for n in names]


def _from_documents(spark: SparkSession, process: str | None, *names: str) -> JobConfig:
    root = work_path(spark, "load")
    sink, sources = _documents(process, *names)
    return JobConfig.from_documents(
        "cleansed.sales.Orders", sink, sources, raw_root=f"{root}/raw", target_root=f"{root}/lake", state_path=f"{root}/state"
    )


@query("job_upsert_from_document", f"""{_LOADED_SQL.split("SELECT \"OrderReference\"")[0]}
SELECT "OrderReference", CASE WHEN status = 'F' THEN 'S' ELSE status END AS "Status",
       CASE WHEN early THEN TIMESTAMP '{_FIRST_TS}' ELSE TIMESTAMP '{_SECOND_TS}' END AS "InsertedDateTime",
       TIMESTAMP '{_SECOND_TS}' AS "UpdatedDateTime", TRUE AS "IsActive" FROM cleansed""")
def job_upsert_from_document(spark: SparkSession, folder: str) -> DataFrame:
    """The document's target process decides: rows are updated in place."""
    config = _from_documents(spark, "Merge", "orders")
    for number, (drop, stamp) in enumerate(zip(_drops(spark, folder), _TIMES), start=1):
        write_delimited(drop, f"{config.source.path}/drop={number}", _FORMAT)
        run_job(spark, config, stamp)
        _set_file_times(spark, config.source.path, stamp)
    table_ = HistoryTable(spark, config.target_path).read()
    return _zoneless(table_.select("OrderReference", "Status", "InsertedDateTime", "UpdatedDateTime", "IsActive"))


@query("job_two_sources", f"""{_COUNTED_SQL}
SELECT 'north' AS source, '{_FIRST_TS}' AS hwm, early AS rows_affected, n AS stored FROM counted
UNION ALL SELECT 'south', '{_FIRST_TS}', n - early, n FROM counted""")
def job_two_sources(spark: SparkSession, folder: str) -> DataFrame:
    """Two source entities of one target, each with a mark of its own."""
    config = _from_documents(spark, None, "north", "south")
    first, _ = _drops(spark, folder)
    raw = raw_orders(spark, folder).drop("ORD_TS")
    late = raw.filter(F.to_date("ORD_DT", "dd/MM/yyyy") >= F.lit(CUT).cast("date"))
    for source, drop in zip((config.source, config.more_sources[0][0]), (first, late)):
        write_delimited(drop, f"{source.path}/drop=1", _FORMAT)
    run_job(spark, config, _FIRST_TS)
    stored = HistoryTable(spark, config.target_path).active().agg(F.count("*").alias("stored"))
    return HwmState(spark, config.state_path).frame().select("source", "hwm", "rows_affected").crossJoin(stored)


@query("hwm_pushed_through", """
SELECT o_orderkey AS "OrderReference", o_orderstatus AS "Status", make_date(CAST(year(o_orderdate) AS INTEGER), 12, 31) AS "fileDate"
FROM orders WHERE year(o_orderdate) > 1996""")
def hwm_pushed_through(spark: SparkSession, folder: str) -> DataFrame:
    """A date mark passes renaming, casts, a calculation and a de-duplication, and chooses folders: a broken old file is never opened."""
    root = f"{work_path(spark, 'years')}/orders"
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("ORD_REF"), F.col("o_orderstatus").alias("STATUS_CD"), F.year("o_orderdate").alias("year")
    )
    orders.union(orders).write.partitionBy("year").option("header", True).csv(root)
    broken = spark.createDataFrame([("ORD_REF,STATUS_CD",), ("1,O,too,many,fields",)], "value string").coalesce(1)
    broken.write.text(f"{root}/year=1980")
    catalogue = catalogue_from({
        "Catalogue": {"Schema": {"NaturalKey": ["OrderReference"], "Attributes": [
            {"Name": "OrderReference", "Type": "bigint", "OrdinalPosition": 1}, {"Name": "Status", "Type": "string", "OrdinalPosition": 2},
            {"Name": "fileDate", "Type": "date", "OrdinalPosition": 3}]}},
        "Extended": {"Cleanse": {"CleansingTransformations": [
            {"RenameAttributes": "ORD_REF:OrderReference, STATUS_CD:Status"}, {"CastAttributes": "true"},
            {"CalculateAttribute": "landed:make_date(year, 12, 31)"}, {"DropDuplicatesByKey": "OrderReference: landed"},
            {"RenameAttributes": "landed:fileDate"}]}},
    }, "orders")
    config = JobConfig(
        "orders", catalogue, RawEntity(root, "orders", FileFormat(multiline=False)), work_path(spark, "pushed"), work_path(spark, "pushed-state"),
        policy=HwmPolicy("date", "fileDate"), push_mark=True,
    )
    HwmState(spark, config.state_path).write("orders", "1996-12-31", 0, None, "1999-01-01 00:00:00")
    run_job(spark, config, "2020-01-01 00:00:00")
    return HistoryTable(spark, config.target_path).read().select("OrderReference", "Status", "fileDate")


@query("stream_by_format", f"""{_LOADED_SQL.split("SELECT \"OrderReference\"")[0]}
SELECT "OrderReference", "CustomerReference", "OrderDate", status AS "Status", "Price" FROM cleansed WHERE early""")
def stream_by_format(spark: SparkSession, folder: str) -> DataFrame:
    """Files of JSON records as a stream: the same rows as from delimited text."""
    config = _config(spark, source=RawEntity(f"{work_path(spark, 'json')}/orders", "orders", FileFormat(extension=".json")))
    _drops(spark, folder)[0].write.json(f"{config.source.path}/drop=1")
    run_stream(spark, config, work_path(spark, "stream-checkpoint"), run_ts=_FIRST_TS).awaitTermination()
    return HistoryTable(spark, config.target_path).read().select(
        "OrderReference", "CustomerReference", "OrderDate", "Status", "Price"
    )


@query("load_reordered_headers", """
SELECT CAST(o_orderkey AS VARCHAR) AS "ORD_REF", CAST(o_custkey AS VARCHAR) AS "CUST_REF", o_orderstatus AS "STATUS_CD" FROM orders""")
def load_reordered_headers(spark: SparkSession, folder: str) -> DataFrame:
    """Listed files whose columns stand in different orders, united by name."""
    path, raw = work_path(spark, "reordered"), raw_orders(spark, folder).select("ORD_REF", "CUST_REF", "STATUS_CD")
    late = F.col("STATUS_CD") == "O"
    write_delimited(raw.filter(~late), f"{path}/one", _FORMAT)
    write_delimited(raw.filter(late).select("STATUS_CD", "ORD_REF", "CUST_REF"), f"{path}/two", _FORMAT)
    entity = RawEntity(path, "orders", _FORMAT)
    return read_entity_files(spark, entity, [f"{path}/one", f"{path}/two"], by_name=True).select("ORD_REF", "CUST_REF", "STATUS_CD")


@query("history_stream", _LOADED_SQL)
def history_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The same loads as a file stream that stops when it has caught up."""
    config = _config(spark)
    checkpoint = work_path(spark, "stream-checkpoint")
    for number, (drop, stamp) in enumerate(zip(_drops(spark, folder), (_FIRST_TS, _SECOND_TS)), start=1):
        write_delimited(drop, f"{config.source.path}/drop={number}", _FORMAT)
        run_stream(spark, config, checkpoint, run_ts=stamp).awaitTermination()
    return _zoneless(HistoryTable(spark, config.target_path).read())


@query("stream_marks_after_crash", f"""{_COUNTED_SQL}
SELECT 'cleansed.sales.Orders' AS entity, '{_FIRST_TS}' AS hwm, early AS rows_affected, TIMESTAMP '{_FIRST_TS}' AS written_at, early AS stored
FROM counted
UNION ALL
SELECT 'cleansed.sales.Orders', '{_SECOND_TS}', n - early + 2 * again, TIMESTAMP '{_SECOND_TS}', n + again FROM counted""")
def stream_marks_after_crash(spark: SparkSession, folder: str) -> DataFrame:
    """A stream stops after its rows are published, before mark and commit are stored: the replay stores the mark, no row comes twice."""
    config = _config(spark)
    checkpoint = work_path(spark, "stream-checkpoint")
    stored = []
    for number, (drop, stamp) in enumerate(zip(_drops(spark, folder), (_FIRST_TS, _SECOND_TS))):
        write_delimited(drop, f"{config.source.path}/drop={number}", _FORMAT)
        run_stream(spark, config, checkpoint, run_ts=stamp).awaitTermination()
        if number == 0:
            folders.remove(spark, config.state_path)
            folders.remove(spark, f"{checkpoint}/commits/{number}")
            run_stream(spark, config, checkpoint, run_ts=_TIMES[2]).awaitTermination()
        stored.append((stamp, HistoryTable(spark, config.target_path).read().count()))
    marks = _zoneless(HwmState(spark, config.state_path).frame().drop("source"))
    return marks.join(spark.createDataFrame(stored, "hwm string, stored long"), "hwm")
