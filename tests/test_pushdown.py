"""Marks carried through declared steps to the raw rows."""

from __future__ import annotations

from dataclasses import replace

import pytest

from millrace.catalogue import catalogue_from
from millrace.operators.cleansing import CleansingContext
from millrace.operators.pipeline import apply_pipeline
from millrace.operators.pushdown import name_before, past_mark
from millrace.operators.watermark import HwmPolicy, filter_hwm
from millrace.plans.job import run_job
from tests.conftest import rows
from tests.test_loads import SINK, config, drop, stored

CATALOGUE = catalogue_from({"Catalogue": {"Schema": {"NaturalKey": ["k"], "Attributes": [
    {"Name": "k", "Type": "int", "OrdinalPosition": 1}, {"Name": "d", "Type": "date", "OrdinalPosition": 2},
    {"Name": "v", "Type": "string", "OrdinalPosition": 3}]}}})
CONTEXT, POLICY, MARK = CleansingContext(catalogue=CATALOGUE), HwmPolicy("date", "d"), "2024-01-02"
CAST, BY_MARK, BY_VALUE = {"CastAttributes": "true"}, {"DropDuplicatesByKey": "k: d"}, {"DropDuplicatesByKey": "k: v"}


@pytest.fixture(scope="module")
def raw(spark):
    data = [(k, f"2024-01-0{d}" if d else None, v) for k in "123" for d in range(5) for v in "xyx" if (int(k) + d) % 4]
    return spark.createDataFrame([*data, ("4", "bad", "z"), (None, "2024-01-04", None)], "k string, d string, v string")


def both(raw, steps, policy=POLICY):
    """Rows with and without the early choice, and how many raw rows it leaves."""
    early = past_mark(raw, steps, policy, MARK, CONTEXT)
    assert early.schema == raw.schema
    ways = [rows(filter_hwm(apply_pipeline(f, steps, context=CONTEXT), policy, MARK)) for f in (raw, early)]
    return ways, early.count()


@pytest.mark.parametrize("steps", [
    [CAST], [CAST, {"DropDuplicates": "true"}], [{"DropDuplicates": "true"}, CAST], [CAST, BY_MARK],
    [{"RenameAttributes": "d:day"}, {"CalculateAttribute": "d:try_to_date(day)"}, {"DropDuplicatesByKey": "k, d: v"}],
    [CAST, {"RenameAttributes": "d:e"}, {"DropDuplicatesByKey": "k: E desc, v asc"}, {"RenameAttributes": "e:d"}, {"MaskAttributes": "v"}],
    [CAST, {"DropDuplicatesByKey": "k, d: v"}, {"CalculateAttribute": "w:upper(v)"}, {"RemoveAttributes": "v"}],
])
def test_early_choice_gives_the_same_rows(raw, steps):
    (late, early), left = both(raw, steps)
    assert early == late and late
    assert left == raw.filter("try_to_date(d) > date'2024-01-02'").count() < raw.count()


@pytest.mark.parametrize("steps", [
    [CAST, BY_VALUE], [CAST, {"DropDuplicatesByKey": "k: d asc"}], [{"DropDuplicatesByKey": "k: d"}, CAST], [CAST, {"DropDuplicatesByKey": "k"}],
    [CAST, {"CalculateAttribute": "n:count(*) over (partition by k)"}], [CAST, BY_MARK, {"CalculateAttribute": "d:date_add(d, 1)"}],
    [CAST, {"FlattenAttribute": "v"}], [CAST, {"RenameAttributes": "d:gone"}], [CAST, {"RemoveAttributes": "d"}],
])
def test_no_early_choice_where_it_might_change_rows(raw, steps):
    (late, early), left = both(raw, steps)
    assert early == late and left == raw.count()


def test_timestamps_inclusive_and_empty(raw):
    policy = HwmPolicy("timestamp", "d", inclusive=True)
    (late, early), _ = both(raw, [{"CalculateAttribute": "d:try_to_timestamp(d)"}, BY_MARK], policy)
    assert early == late and len(late) == 4
    assert both(raw.limit(0), [CAST, BY_MARK])[0] == [[], []]


def test_names_are_followed_backwards():
    steps = [("RenameAttributes", "a:b"), ("MaskAttributes", "x:sha2"), ("RenameAttributes", {"b": "c"})]
    assert (name_before(steps, "C"), name_before(steps, "x"), name_before(steps, "a")) == ("a", None, None)
    assert name_before([("FlattenAttribute", "a")], "b") is None


def test_filter_reaches_the_scan(spark, raw, tmp_path):
    raw.write.parquet(str(tmp_path / "raw"))
    frame = past_mark(spark.read.parquet(str(tmp_path / "raw")), [{"RenameAttributes": "d:day"}], HwmPolicy("date", "day"), MARK)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and "struct(" not in plan and "DataFilters: [isnotnull(d" in plan


def test_broken_old_file_is_not_opened(spark, tmp_path):
    document = {**SINK, "Extended": {"Cleanse": {**SINK["Extended"]["Cleanse"], "PushHighWaterMark": "true", "CleansingTransformations": [
        {"RenameAttributes": "CUST_REF:CustomerReference, STATUS_CD:Status"},
        {"CalculateAttribute": ["landed:to_date(substr(file_name, 1, 10))", "hashedKey:CustomerReference", "fileName:file_name"]},
        {"CastAttributes": "true"}, {"RemoveAttributes": "fileDate"}, {"DropDuplicatesByKey": "CustomerReference: landed"}]}}}
    job = config(tmp_path, policy=HwmPolicy("date", "landed"), catalogue=catalogue_from(document), push_mark=True)
    drop(tmp_path, "2024-01-01.csv", "1,a,2024-01-01", "2,a,2024-01-01")
    assert run_job(spark, job, "2024-02-01 00:00:00").rows_read == 2
    drop(tmp_path, "2024-01-01.csv", "1,a,2024-01-01,too,many", "2")
    drop(tmp_path, "2024-01-05.csv", "1,b,2024-01-05", "1,b,2024-01-05")
    again = run_job(spark, job, "2024-02-02 00:00:00")
    assert (again.rows_read, again.rows_staged, again.hwm) == (2, 1, "2024-01-05")
    assert [r[:3] for r in stored(spark, job)] == [(1, "a", False), (1, "b", True), (2, "a", True)]
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST|column"):
        run_job(spark, replace(job, push_mark=False), "2024-02-03 00:00:00")
