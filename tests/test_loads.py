"""Whole loads: configured jobs and the file stream."""

from __future__ import annotations

import time
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from millrace.catalogue import FileFormat, catalogue_from
from millrace.operators.pipeline import register_action
from millrace.operators.watermark import FIRST_MARK, HwmPolicy
from millrace.plans.job import JobConfig, empty_batch, run_job
from millrace.sinks import HistoryTable, HwmState
from millrace.sources import RawEntity, append_log
from millrace.streaming import run_stream
from tests.conftest import rows

SINK = {
    "Extended": {"Cleanse": {
        "CleansingTransformations": [
            {"RenameAttributes": "CUST_REF:CustomerReference, STATUS_CD:Status"},
            {"CastAttributes": "true"},
            {"CalculateAttribute": ["hashedKey:sha2(concat_ws('||', CustomerReference), 256)", "fileName:file_name"]},
        ],
        "SourceEntities": [{"EFQN": "raw.sales.Customer"}],
        "SourceFilePathFilter": "/*.csv",
    }},
    "System": {"EntityPath": "cleansed/customer"},
    "Catalogue": {"Schema": {"NaturalKey": ["CustomerReference"], "Attributes": [
        {"Name": "CustomerReference", "Type": "int", "OrdinalPosition": 1},
        {"Name": "Status", "Type": "nvarchar", "OrdinalPosition": 2},
        {"Name": "fileDate", "Type": "date", "OrdinalPosition": 3},
        {"Name": "fileName", "Type": "string", "OrdinalPosition": 4},
        {"Name": "hashedKey", "Type": "string", "OrdinalPosition": 5},
    ]}},
}
SOURCE = {"System": {
    "EntityPath": "customer", "EntityName": "Customer", "AllowedRetention": "30", "IsHousekeepingEnabled": "true",
    "FileFormat": {"Extension": ".csv", "ColumnDelimiter": ",", "Header": "true"},
}}


def config(tmp_path, **changes):
    (tmp_path / "raw" / "customer").mkdir(parents=True, exist_ok=True)
    job = JobConfig.from_documents(
        "cleansed.sales.Customer", SINK, SOURCE, f"{tmp_path}/raw", f"{tmp_path}/lake", f"{tmp_path}/state")
    return replace(job, **changes)


def drop(tmp_path, name, *lines):
    time.sleep(0.05)
    (tmp_path / "raw" / "customer" / name).write_text("CUST_REF,STATUS_CD,fileDate\n" + "\n".join(lines) + "\n")


def stored(spark, job):
    table = HistoryTable(spark, job.target_path)
    return rows(table.read().select("CustomerReference", "Status", "IsActive", F.col("EffectiveEndDate").cast("string")))


def test_documents_make_a_config(tmp_path):
    job = config(tmp_path)
    assert job.source_name == "raw.sales.Customer" and job.path_filter == "/*.csv" and job.retention_days == 30
    assert job.source.path == f"{tmp_path}/raw/customer" and job.target_path == f"{tmp_path}/lake/cleansed/customer"
    with pytest.raises(ValueError, match="NaturalKey"):
        config(tmp_path, catalogue=catalogue_from({"Catalogue": {"Schema": {"Attributes": []}}}))
    with pytest.raises(ValueError, match="entity name"):
        config(tmp_path, entity="")


def test_loads_by_file_time(spark, tmp_path):
    job = config(tmp_path)
    drop(tmp_path, "one.csv", "1,A,2024-01-01", "2,B,2024-01-01", "3,,2024-01-01")
    first = run_job(spark, job)
    assert (first.rows_read, first.rows_staged, first.counts.inserted) == (3, 3, 3)
    again = run_job(spark, job)
    assert (again.rows_staged, again.counts.affected, again.hwm) == (0, 0, first.hwm)
    drop(tmp_path, "two.csv", "2,C,2024-01-02", "3,Z,2024-01-02", "4,D,2024-01-02", "1,A,2024-01-02")
    second = run_job(spark, job)
    assert (second.counts.expired, second.counts.inserted, second.counts.unchanged) == (2, 3, 1)
    assert [r[:3] for r in stored(spark, job)] == [
        (1, "A", True), (2, "B", False), (2, "C", True), (3, "Z", True), (3, None, False), (4, "D", True)]
    assert HwmState(spark, job.state_path).read(job.entity, job.source_name) == second.hwm > first.hwm


def test_loads_by_date_with_max_as_next_mark(spark, tmp_path):
    job = config(tmp_path, policy=HwmPolicy("date", "fileDate", next="max"))
    drop(tmp_path, "one.csv", "1,A,2024-01-01", "2,B,2024-01-03")
    first = run_job(spark, job, "2024-02-01 00:00:00")
    assert (first.rows_staged, first.hwm) == (2, "2024-01-03")
    drop(tmp_path, "two.csv", "1,Z,2024-01-03", "2,C,2024-01-04")
    second = run_job(spark, job, "2024-02-02 00:00:00")
    # Strictly after the mark's day: the late row of the 3rd is not seen.
    assert (second.rows_read, second.rows_staged, second.hwm) == (4, 1, "2024-01-04")
    assert stored(spark, job) == [(1, "A", True, None), (2, "B", False, "2024-02-02 00:00:00"), (2, "C", True, None)]
    third = run_job(spark, job, "2024-02-03 00:00:00")
    assert (third.rows_staged, third.hwm) == (0, "2024-01-04")


def test_mark_column_outside_the_catalogue(spark, tmp_path):
    attributes = [a for a in SINK["Catalogue"]["Schema"]["Attributes"] if a["Name"] != "fileDate"]
    document = {**SINK, "Catalogue": {"Schema": {"NaturalKey": ["CustomerReference"], "Attributes": attributes}}}
    job = config(tmp_path, policy=HwmPolicy("date", "fileDate", next="max"), catalogue=catalogue_from(document))
    drop(tmp_path, "one.csv", "1,A,2024-01-01")
    assert run_job(spark, job, "2024-02-01 00:00:00").hwm == "2024-01-01"


def test_retention_after_a_load(spark, tmp_path):
    job = config(tmp_path)
    drop(tmp_path, "one.csv", "1,A,2024-01-01")
    run_job(spark, job, "2024-01-01 00:00:00")
    (tmp_path / "raw" / "customer" / "one.csv").unlink()
    drop(tmp_path, "two.csv", "1,B,2024-01-02")
    result = run_job(spark, job, "2024-01-02 00:00:00")
    assert result.purged == [] and len(stored(spark, job)) == 2
    late = run_job(spark, job, "2999-01-01 00:00:00")
    assert len(late.purged) == 1 and [r[:3] for r in stored(spark, job)] == [(1, "B", True)]


def test_actions_run_between_staging_and_merge(spark, tmp_path):
    register_action("drop_a", lambda df, job: df.filter("Status <> 'A'"))
    job = config(tmp_path, actions=("drop_a",))
    drop(tmp_path, "one.csv", "1,A,2024-01-01", "2,B,2024-01-01")
    assert run_job(spark, job).counts.inserted == 1
    drop(tmp_path, "two.csv", "5,A,2024-01-01")
    with pytest.raises(ValueError, match="not registered"):
        run_job(spark, config(tmp_path, actions=("never_registered",)))


def test_a_failed_load_keeps_the_mark(spark, tmp_path):
    job = config(tmp_path)
    drop(tmp_path, "one.csv", "1,A,2024-01-01", "1,B,2024-01-01")
    with pytest.raises(Exception, match="duplicate key"):
        run_job(spark, job)
    assert HwmState(spark, job.state_path).read(job.entity, job.source_name) == FIRST_MARK
    ordered = config(tmp_path, duplicates="Status")
    assert run_job(spark, ordered).counts.inserted == 1
    assert stored(spark, job) == [(1, "B", True, None)]


def test_table_sources_by_audit_columns(spark, tmp_path):
    schema = "CUST_REF string, STATUS_CD string, fileDate string, InsertedDateTime timestamp, UpdatedDateTime timestamp, file_name string"
    path = f"{tmp_path}/raw/table"
    job = config(tmp_path, policy=HwmPolicy("audit", next="max"),
                 source=RawEntity(path, "table", FileFormat(extension=".parquet")))
    one = spark.sql("select '1', 'A', '2024-01-01', timestamp'2024-01-01 00:00:00', timestamp'2024-01-05 00:00:00', 'f'")
    one.toDF(*[c.split()[0] for c in schema.split(", ")]).write.parquet(path)
    assert run_job(spark, job).hwm == "2024-01-05 00:00:00"
    two = spark.sql("select '1', 'B', '2024-01-01', timestamp'2024-01-06 00:00:00', timestamp'2024-01-06 00:00:00', 'f'")
    two.toDF(*[c.split()[0] for c in schema.split(", ")]).write.mode("append").parquet(path)
    second = run_job(spark, job)
    assert (second.rows_staged, second.hwm, second.counts.expired) == (1, "2024-01-06 00:00:00", 1)


def test_a_target_without_a_catalogue_column_is_refused(spark, tmp_path):
    job = config(tmp_path)
    drop(tmp_path, "one.csv", "1,A,2024-01-01")
    run_job(spark, job)
    attributes = SINK["Catalogue"]["Schema"]["Attributes"] + [{"Name": "Later", "Type": "int"}]
    wider = {**SINK, "Catalogue": {"Schema": {"NaturalKey": ["CustomerReference"], "Attributes": attributes}}}
    with pytest.raises(ValueError, match="Later"):
        run_job(spark, config(tmp_path, catalogue=catalogue_from(wider)))


def test_own_reader(spark, tmp_path):
    data = spark.sql("select '1' CUST_REF, 'A' STATUS_CD, '2024-01-01' fileDate, 'f' file_name")
    job = config(tmp_path, reader=lambda session, mark: data if mark == FIRST_MARK else None)
    assert run_job(spark, job).counts.inserted == 1
    assert run_job(spark, job).rows_read == 0


def test_nothing_to_read(spark, tmp_path):
    job = config(tmp_path)
    assert empty_batch(spark, job).columns[-1] == "IsActive"
    drop(tmp_path, "one.csv")
    result = run_job(spark, job)
    assert (result.rows_staged, result.hwm) == (0, FIRST_MARK)


def test_stream_takes_each_file_once(spark, tmp_path):
    job = config(tmp_path)
    drop(tmp_path, "one.csv", "1,A,2024-01-01", "2,B,2024-01-01")
    checkpoint = f"{tmp_path}/checkpoint"
    run_stream(spark, job, checkpoint, run_ts="2024-01-01 00:00:00").awaitTermination()
    drop(tmp_path, "two.csv", "2,C,2024-01-02")
    query = run_stream(spark, job, checkpoint, run_ts="2024-01-02 00:00:00", max_files=1)
    query.awaitTermination()
    assert query.lastProgress["numInputRows"] == 1
    run_stream(spark, job, checkpoint, run_ts="2024-01-03 00:00:00").awaitTermination()
    assert stored(spark, job) == [(1, "A", True, None), (2, "B", False, "2024-01-02 00:00:00"), (2, "C", True, None)]


def test_differing_headers_stop_a_load(spark, tmp_path):
    job = config(tmp_path)
    drop(tmp_path, "one.csv", "1,A,2024-01-01")
    (tmp_path / "raw" / "customer" / "two.csv").write_text("STATUS_CD,CUST_REF,fileDate\nB,2,2024-01-01\n")
    with pytest.raises(Exception, match="(?i)header"):
        run_job(spark, job)
    assert stored(spark, job) == []
    split = replace(job, source=replace(job.source, fmt=replace(job.source.fmt, split_multiline=True)))
    with pytest.raises(Exception, match="header differs"):
        run_job(spark, split)
    work = tmp_path / "work"
    assert not work.exists() or not list(work.glob("staged-*"))


def test_log_beside_the_files(spark, tmp_path):
    job = config(tmp_path, policy=HwmPolicy("date", "fileDate", next="max"), path_filter=None)
    drop(tmp_path, "one.csv", "1,A,2024-01-01")
    log = spark.createDataFrame([("x", 1, "one.csv", "2024-01-01 00:00:00")], "FilePath string, NumberOfRows int, FileName string, ProcessedDateTime string")
    append_log(log, job.source.log_folder)
    assert run_job(spark, job, "2024-02-01 00:00:00").rows_staged == 1


@pytest.mark.parametrize("process", ["append", "scd2"])
def test_stop_between_publish_and_mark(spark, tmp_path, monkeypatch, process):
    job = config(tmp_path, process=process, null_keys="insert")
    drop(tmp_path, "one.csv", "1,A,2024-01-01", ",B,2024-01-01")
    with monkeypatch.context() as m:
        m.setattr(HwmState, "write", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            run_job(spark, job)
    first = stored(spark, job)
    assert len(first) == 2
    again = run_job(spark, job)
    assert again.rows_staged == 0 and stored(spark, job) == first
    assert HwmState(spark, job.state_path).read(job.entity, job.source_name) == again.hwm


def test_replayed_stream_batch_is_passed_over(spark, tmp_path):
    job = config(tmp_path, process="append")
    drop(tmp_path, "one.csv", "1,A,2024-01-01")
    run_stream(spark, job, f"{tmp_path}/checkpoint", run_ts="2024-02-01 00:00:00").awaitTermination()
    for commit in (tmp_path / "checkpoint" / "commits").glob("[0-9.]*"):
        commit.unlink()  # as if the stream had stopped after the publish
    run_stream(spark, job, f"{tmp_path}/checkpoint", run_ts="2024-02-02 00:00:00").awaitTermination()
    assert len(stored(spark, job)) == 1
    assert HwmState(spark, job.state_path).read(job.entity, job.source_name) == "2024-02-01 00:00:00"


def test_streams_refuse_what_they_cannot_read(spark, tmp_path):
    job = config(tmp_path)
    for fmt in (replace(job.source.fmt, nul_interleaved=True), replace(job.source.fmt, multiline=True, split_multiline=True)):
        with pytest.raises(ValueError, match="stream"):
            run_stream(spark, replace(job, source=replace(job.source, fmt=fmt)), f"{tmp_path}/checkpoint")


def test_documents_decide(tmp_path):
    sink = {**SINK, "Extended": {"Cleanse": {**SINK["Extended"]["Cleanse"], "TargetProcess": "Merge",
                                             "SourceEntities": [{"EFQN": "raw.a"}, {"EFQN": "raw.b"}]}}}
    other = {"System": {**SOURCE["System"], "EntityPath": "other"}}
    job = JobConfig.from_documents("cleansed.Customer", sink, [SOURCE, other], f"{tmp_path}/raw", f"{tmp_path}/lake", f"{tmp_path}/state")
    assert job.process == "Merge" and job.source_name == "raw.a"
    assert [(s.path, n) for s, n in job.more_sources] == [(f"{tmp_path}/raw/other", "raw.b")]
    with pytest.raises(ValueError, match="source documents"):
        JobConfig.from_documents("e", SINK, [SOURCE, other], "r", "t", "s")


def test_upsert_outcomes(spark, tmp_path):
    job = config(tmp_path, process="upsert")
    drop(tmp_path, "one.csv", "1,A,2024-01-01", "2,B,2024-01-01")
    run_job(spark, job)
    drop(tmp_path, "two.csv", "2,C,2024-01-02", "3,D,2024-01-02")
    counts = run_job(spark, job).counts
    assert (counts.updated, counts.inserted, counts.unchanged, counts.affected) == (1, 1, 1, 2)


def test_own_folder_without_a_setting(tmp_path):
    """A plain local session that names no checkpoint folder: one is made, once, and a load's intermediate data goes there."""
    import os
    import subprocess
    import sys

    script = (
        "from millrace.session import build_session, shared_folder, work_path\n"
        "spark = build_session('plain', 'local[1]')\n"
        "assert spark.conf.get('spark.checkpoint.dir', None) is None\n"
        "path = work_path(spark, 'x')\n"
        "spark.range(3).write.parquet(path)\n"
        "assert path.startswith(shared_folder(spark) + '/x-') and spark.read.parquet(path).count() == 3\n"
        "print('made', shared_folder(spark) == shared_folder(spark.newSession()))\n"
    )
    environment = {**os.environ, "SPARK_CONF_DIR": str(tmp_path), "TMPDIR": str(tmp_path)}
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", script], cwd=root, env=environment, capture_output=True, text=True, timeout=240)
    assert "made True" in done.stdout, done.stderr[-2000:]
