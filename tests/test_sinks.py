from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from millrace.catalogue import catalogue_from
from millrace.operators import merge
from millrace.operators.watermark import FIRST_MARK, HwmPolicy, change_data, filter_hwm, filter_text, next_hwm
from millrace.sinks import (
    HistoryTable,
    HwmState,
    MergeCounts,
    append_to_table,
    create_table,
    history_schema,
    output_path,
    schema_ddl,
    write_delimited_target,
    write_target,
)
from millrace.sources import read_delimited
from tests.conftest import rows
from tests.test_merge import BATCH, KEYS, NEW, SCHEMA, TS, as_text, frame, random_tables, two_passes


def table_at(spark, path, schema=SCHEMA):
    return HistoryTable(spark, str(path), spark.createDataFrame([], schema).schema).create()


def test_table_merges_like_the_plan(spark, tmp_path):
    sink, batch = random_tables(21)
    table = table_at(spark, tmp_path)
    table.replace(frame(spark, sink, SCHEMA))
    counts = table.merge(frame(spark, batch, BATCH), KEYS, TS)
    # A NULL flag is stored as false: the version is not active either way.
    want = [(*r[:8], bool(r[8])) for r in two_passes(sink, batch)]
    assert as_text(table.read()) == sorted(want, key=repr)
    assert counts.affected == counts.expired + counts.inserted > 0
    assert rows(table.active().select("IsActive").distinct()) == [(True,)]
    assert rows(table.closed().select("IsActive").distinct()) == [(False,)]


def test_empty_table_then_empty_batch(spark, tmp_path):
    table = table_at(spark, tmp_path)
    assert table.read().count() == 0 and table.create().version == 0
    assert table.merge(frame(spark, [], BATCH), KEYS, TS) == MergeCounts()
    counts = table.merge(frame(spark, [(1, "a", "p", "h", NEW, NEW)], BATCH), KEYS, TS)
    assert counts == MergeCounts(inserted=1)
    assert table.merge(frame(spark, [(1, "a", "p", "h", NEW, NEW)], BATCH), KEYS, TS) == MergeCounts(unchanged=1)


def load_values(spark, table, times):
    for value, ts in zip("pqrstu", times):
        table.merge(frame(spark, [(1, "a", value, "h", NEW, NEW)], BATCH), KEYS, ts)


def test_closed_folders_are_written_once(spark, tmp_path):
    table = table_at(spark, tmp_path)
    load_values(spark, table, ["2024-06-01 00:00:00", "2024-06-02 00:00:00", "2024-07-03 00:00:00"])
    folders = sorted(p.relative_to(tmp_path).parts for p in tmp_path.glob("load_id=*/IsActive=false/EndMonth=*"))
    assert [(f[0].split("-")[0], f[2]) for f in folders] == [
        ("load_id=2", "EndMonth=2024-06"), ("load_id=3", "EndMonth=2024-07")]
    ends = table.closed().selectExpr("v", "cast(EffectiveEndDate as string)")
    assert rows(ends) == [("p", "2024-06-02 00:00:00"), ("q", "2024-07-03 00:00:00")]


@pytest.mark.parametrize("run_ts", [
    "2024-06-02 00:00:00", "2024-06-04 00:00:00", "2024-07-01 00:00:00", "2024-07-02 00:00:00", "2024-07-05 00:00:00",
    "2024-08-01 00:00:00"])
def test_purge_equals_the_plan_and_vacuum_keeps_what_is_read(spark, tmp_path, run_ts):
    table = table_at(spark, tmp_path)
    load_values(spark, table, [
        "2024-06-01 12:00:00", "2024-06-02 00:00:00", "2024-06-03 12:00:00", "2024-07-01 00:00:00", "2024-07-04 01:00:00"])
    want = as_text(merge.retention_purge(table.read(), 1, run_ts))
    table.purge(1, run_ts)
    assert as_text(table.read()) == want
    assert table.purge(1, run_ts) == []
    # Versions added later are not cut by an earlier purge.
    old = frame(spark, [(9, "z", "p", "h", NEW, NEW, NEW, "2024-06-01 00:00:00", False)], SCHEMA)
    table.append(old)
    want = sorted([*want, *as_text(old)], key=repr)
    assert as_text(table.read()) == want
    assert any("IsActive=true" in path for path in table.vacuum())
    assert as_text(table.read()) == want and table.vacuum() == []


def test_failed_load_is_invisible_and_repeatable(spark, tmp_path):
    table = table_at(spark, tmp_path)
    table.merge(frame(spark, [(1, "a", "p", "h", NEW, NEW)], BATCH), KEYS, TS)
    before = as_text(table.read())
    duplicated = frame(spark, [(1, "a", "q", "h", NEW, NEW), (1, "a", "r", "h", NEW, NEW)], BATCH)
    with pytest.raises(Exception, match="duplicate key"):
        table.merge(duplicated, KEYS, TS)
    assert as_text(table.read()) == before
    table.merge(frame(spark, [(1, "a", "q", "h", NEW, NEW)], BATCH), KEYS, TS)
    assert table.active().first()["v"] == "q"


def test_two_writers_cannot_both_publish(spark, tmp_path):
    one, two = table_at(spark, tmp_path), table_at(spark, tmp_path)
    stale = two._require()
    one.merge(frame(spark, [(1, "a", "p", "h", NEW, NEW)], BATCH), KEYS, TS)
    two._require = lambda: stale
    with pytest.raises(Exception, match="(?i)exist"):
        two.merge(frame(spark, [(1, "a", "q", "h", NEW, NEW)], BATCH), KEYS, TS)
    assert one.read().first()["v"] == "p"


def test_an_unfinished_pointer_is_passed_over(spark, tmp_path):
    table = table_at(spark, tmp_path)
    table.merge(frame(spark, [(1, "a", "p", "h", NEW, NEW)], BATCH), KEYS, TS)
    (tmp_path / "_pointer" / "000000000002.json").write_text("")
    assert table.read().first()["v"] == "p"
    table.merge(frame(spark, [(1, "a", "q", "h", NEW, NEW)], BATCH), KEYS, TS)
    assert table.version == 3 and table.active().first()["v"] == "q"
    table.vacuum()
    assert table.read().count() == 2


def test_create_needs_history_columns(spark, tmp_path):
    with pytest.raises(ValueError, match="history columns"):
        table_at(spark, tmp_path, "k int")
    with pytest.raises(ValueError, match="no history table"):
        HistoryTable(spark, f"{tmp_path}/none").read()


def test_processes(spark, tmp_path):
    table = table_at(spark, tmp_path)
    first = frame(spark, [(1, "a", "p", "h", NEW, NEW), (2, "a", "p", "h", NEW, NEW)], BATCH)
    assert write_target(first, table, "Overwrite", KEYS, TS) == MergeCounts(inserted=2)
    second = frame(spark, [(2, "a", "q", "h", NEW, NEW), (3, "a", "q", "h", NEW, NEW)], BATCH)
    write_target(second, table, "scd2", KEYS, TS)
    assert table.read().count() == 4
    third = frame(spark, [(1, "a", "z", "h", NEW, NEW)], BATCH)
    write_target(third, table, "Merge", KEYS, TS)
    assert rows(table.active().select("k", "v")) == [(1, "z"), (2, "q"), (3, "q")]
    write_target(third, table, "append", KEYS, TS)
    assert table.active().count() == 4 and table.closed().count() == 1
    assert write_target(None, table, "scd2", KEYS) == MergeCounts()
    with pytest.raises(ValueError, match="unknown target process"):
        write_target(third, table, "sideways", KEYS)


def test_delimited_target(spark, tmp_path):
    path = output_path(str(tmp_path), "T", ".csv")
    assert path == f"{tmp_path}/T.csv"
    df = spark.range(3).selectExpr("cast(id as string) id")
    assert write_delimited_target(df, path, "TruncateReload") == 3
    assert write_delimited_target(df.limit(1), path, "overwrite") == 1
    assert read_delimited(spark, path).count() == 1
    assert write_delimited_target(df.limit(0), path, "overwrite") == 0 == write_delimited_target(None, path, "x")
    assert read_delimited(spark, path).count() == 1
    with pytest.raises(ValueError, match="not supported"):
        write_delimited_target(df, path, "merge")


def test_create_table_and_append(spark, tmp_path):
    catalogue = catalogue_from({"Catalogue": {"Schema": {"Attributes": [
        {"Name": "Id", "Type": "int"}, {"Name": "Price", "Type": "decimal", "Precision": 9, "Scale": 2},
        {"Name": "Region", "Type": "nvarchar"}]}}})
    try:
        for _ in range(2):
            create_table(spark, "made_db.made", catalogue, f"{tmp_path}/made", "region")
        assert schema_ddl(catalogue.schema) == "`Id` int, `Price` decimal(9,2), `Region` string"
        batch = spark.sql("select 'north' region, 1 id, 2.50 price")
        assert append_to_table(batch, "made_db.made") == 1
        assert append_to_table(batch, "made_db.made") == 2 - 1
        assert spark.table("made_db.made").count() == 2
        assert (tmp_path / "made" / "Region=north").exists()
        with pytest.raises(ValueError, match="partition columns"):
            create_table(spark, "made_db.other", catalogue, partition_by="nope")
        assert create_table(spark, "made_db.hist", history_schema(catalogue.schema)) is None
        assert spark.table("made_db.hist").columns[-1] == "IsActive"
    finally:
        spark.sql("drop database if exists made_db cascade")


# -- marks -----------------------------------------------------------------
def test_state_by_entity_source_and_role(spark, tmp_path):
    state = HwmState(spark, f"{tmp_path}/state")
    assert state.read("E") == FIRST_MARK
    state.write("E", "2024-01-01", 5, "s1", "2024-01-02 00:00:00")
    state.write("E", "2024-02-01", 5, "s1", "2024-02-02 00:00:00")
    state.write("E", "2024-01-15", 5, "s2", "2024-03-02 00:00:00")
    state.write("E", "2023-12-31", 0, None, "2024-03-02 00:00:00")
    assert [state.read("E", s) for s in ("s1", "s2", None, "s3")] == ["2024-02-01", "2024-01-15", "2023-12-31", FIRST_MARK]
    assert state.write("E", None, 0, "s1", "2024-04-01 00:00:00") == "2024-02-01"
    assert state.for_role("sink", "E", "s2") == "2024-01-15"
    assert state.for_role("Source", "E", run_ts=TS) == TS
    assert state.for_role("undefined", "E", "s2") == FIRST_MARK
    assert state.read("Other") == FIRST_MARK


def test_policies(spark):
    df = spark.sql("""
        select * from values (1, date'2024-01-14', timestamp'2024-01-14 10:00:00'), (2, date'2024-01-15', timestamp'2024-01-15 10:00:00'),
        (3, date'2024-01-16', timestamp'2024-01-16 10:00:00') as t(id, fileDate, InsertedDateTime)""")
    mark = "2024-01-15T09:00:00.000+0000"

    def ids(policy):
        return [r["id"] for r in filter_hwm(df, policy, mark).sort("id").collect()]

    assert ids(HwmPolicy("date")) == [3]
    assert ids(HwmPolicy("date", inclusive=True)) == [2, 3]
    assert ids(HwmPolicy("timestamp", "InsertedDateTime")) == [2, 3]
    assert ids(HwmPolicy("audit")) == [2, 3]
    assert ids(HwmPolicy("date", "absent")) == [1, 2, 3]
    assert next_hwm(df, HwmPolicy("date"), mark).first()[0] == "2024-01-16"
    assert next_hwm(df.limit(0), HwmPolicy("date"), mark).first()[0] == mark
    assert next_hwm(df, HwmPolicy("date", "absent"), mark).first()[0] == mark
    assert next_hwm(df, HwmPolicy("date", next="run_ts"), mark, TS).first()[0] == TS
    assert next_hwm(df, HwmPolicy("audit"), mark).first()[0] == "2024-01-16 10:00:00"
    assert change_data(df.select("id"), mark).count() == 3
    assert change_data(df, mark, "2024-01-15 23:00:00").count() == 1
    assert filter_text(df, " ").count() == 3 and filter_text(df, "id = 1").count() == 1
    for bad in ({"kind": "moon"}, {"next": "moon"}):
        with pytest.raises(ValueError):
            HwmPolicy(**bad)


def test_filters_reach_the_scan(spark, tmp_path):
    path = f"{tmp_path}/p"
    spark.range(10).select("id", F.lit("2024-01-01").cast("date").alias("fileDate")).write.parquet(path)
    plan = filter_hwm(spark.read.parquet(path), HwmPolicy("date"), FIRST_MARK)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(fileDate,1970-01-01)" in plan
