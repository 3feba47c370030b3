"""History tables laid out in partitions: same rows as the plan, and only touched partitions rewritten."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import merge
from millrace.plans.job import JobConfig, target_table
from millrace.sinks import HistoryTable, MergeCounts, write_target
from tests.conftest import rows
from tests.test_merge import BATCH, KEYS, NEW, SCHEMA, TS, as_text, frame, random_tables, two_passes

LAYOUTS = {
    "buckets": {"buckets": 8, "keys": KEYS}, "by_key": {"partition_by": ["g"]}, "by_value": {"partition_by": ["V"]},
    "by_two": {"partition_by": ["g", "v"]},
}


def laid_out(spark, path, layout, schema=SCHEMA):
    return HistoryTable(spark, str(path), spark.createDataFrame([], schema).schema, **LAYOUTS[layout]).create()


def pointer(path):
    return json.loads(sorted(path.glob("_pointer/*.json"))[-1].read_text())


@pytest.mark.parametrize("layout", LAYOUTS)
@pytest.mark.parametrize("seed", [3, 21])
def test_laid_out_table_merges_like_the_plan(spark, tmp_path, layout, seed):
    sink, batch = random_tables(seed, duplicate_active=seed == 3)
    table = laid_out(spark, tmp_path, layout)
    table.replace(frame(spark, sink, SCHEMA))
    assert as_text(table.read()) == sorted([(*r[:8], bool(r[8])) for r in sink], key=repr)
    table.merge(frame(spark, batch, BATCH), KEYS, TS)
    want = [(*r[:8], bool(r[8])) for r in two_passes(sink, batch)]
    assert as_text(table.read()) == sorted(want, key=repr)
    again = table.merge(frame(spark, [b for b in batch if None not in b[:2]], BATCH), KEYS, TS)
    assert again.affected == 0
    table.vacuum()
    assert as_text(table.read()) == sorted(want, key=repr)


@pytest.mark.parametrize("layout", LAYOUTS)
def test_upsert_keeps_other_partitions(spark, tmp_path, layout):
    table = laid_out(spark, tmp_path, layout)
    old = [(k, "ab"[k % 2], "pqr"[k % 3], "h", NEW, NEW) for k in range(30)] + [(None, "a", "p", "h", NEW, NEW)]
    write_target(frame(spark, old, BATCH), table, "append", KEYS, TS)
    counts = write_target(frame(spark, [(4, "a", "z", "h", NEW, NEW), (99, "a", "p", "h", NEW, NEW)], BATCH), table, "merge", KEYS, TS)
    assert (counts.updated, counts.inserted) == (1, 1)
    got = rows(table.active().select("k", "g", "v"))
    assert got == sorted([r[:3] for r in old if r[0] != 4] + [(4, "a", "z"), (99, "a", "p")], key=repr)


def test_one_row_touches_one_bucket(spark, tmp_path):
    table = laid_out(spark, tmp_path, "buckets")
    data = [(k, "a", "p", "h", NEW, NEW) for k in range(400)]
    table.merge(frame(spark, data, BATCH), KEYS, TS)
    before = pointer(tmp_path)["active"]
    assert len(before) == 8
    counts = table.merge(frame(spark, [(5, "a", "q", "h", NEW, NEW)], BATCH), KEYS, "2024-06-02 00:00:00")
    after = pointer(tmp_path)["active"]
    assert len(set(before) & set(after)) == 7 and len(after) == 8
    (new,) = set(after) - set(before)
    (old,) = set(before) - set(after)
    assert new.split("/")[-1] == old.split("/")[-1] and new.startswith("load_id=2-")
    written = [p for p in tmp_path.glob("load_id=2-*/IsActive=true/**/*.parquet")]
    assert {str(p.parent.relative_to(tmp_path)) for p in written} == {new}
    in_bucket = spark.read.parquet(f"{tmp_path}/{old}").count()
    assert counts == MergeCounts(expired=1, inserted=1, unchanged=in_bucket - 1)
    assert table.active().count() == 400 and table.closed().count() == 1
    assert rows(table.active().filter("k = 5").select("v")) == [("q",)]


def test_keyless_rows_are_only_added(spark, tmp_path):
    table = laid_out(spark, tmp_path, "buckets")
    keyless = frame(spark, [(None, "a", "p", "h", NEW, NEW)], BATCH)
    for _ in range(3):
        table.merge(keyless, KEYS, TS)
    assert [f.split("/")[-1] for f in pointer(tmp_path)["active"]] == ["KeyHash=__HIVE_DEFAULT_PARTITION__"] * 3
    assert table.active().count() == 3


def test_touched_partitions_are_all_that_is_read(spark, tmp_path):
    table = laid_out(spark, tmp_path, "by_key")
    data = [(k, "abcdef"[k % 6], "p", "h", NEW, NEW) for k in range(60)]
    table.merge(frame(spark, data, BATCH), KEYS, TS)
    active, kept = table.touched(frame(spark, [(1, "b", "q", "h", NEW, NEW), (9, "x", "q", "h", NEW, NEW)], BATCH), KEYS)
    assert len(kept) == 5 and rows(active.select("g").distinct()) == [("b",)]
    # A reader's filter on the column prunes folders too.
    plan = table.active().filter("g = 'c'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "g#" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]


def test_key_that_moves_to_another_partition(spark, tmp_path):
    table = laid_out(spark, tmp_path, "by_value")
    table.merge(frame(spark, [(k, "a", "p", "h", NEW, NEW) for k in range(5)], BATCH), KEYS, TS)
    counts = table.merge(frame(spark, [(3, "a", "q", "h", NEW, NEW)], BATCH), KEYS, "2024-06-02 00:00:00")
    assert counts == MergeCounts(expired=1, inserted=1, unchanged=4)
    assert rows(table.active().groupBy("v").count()) == [("p", 4), ("q", 1)]


@pytest.mark.parametrize("value", ["", None, "a/b=c %20", "007", "é'`"])
def test_odd_partition_values(spark, tmp_path, value):
    """Whatever a partition is called, the same batch changes nothing the second time; an empty string is stored as NULL."""
    table = laid_out(spark, tmp_path, "by_value")
    batch = frame(spark, [(1, "a", value, "h", NEW, NEW)], BATCH)
    assert table.merge(batch, KEYS, TS).inserted == 1
    assert table.merge(batch, KEYS, TS) == MergeCounts(unchanged=1)
    assert rows(table.active().select("v")) == [(value or None,)]


def test_hash_of_keys_follows_equality(spark, tmp_path):
    schema = SCHEMA.replace("k int", "k double")
    table = HistoryTable(spark, str(tmp_path), spark.createDataFrame([], schema).schema, buckets=64, keys=["k"]).create()
    for zero in ("0.0", "-0.0"):
        batch = frame(spark, [("a", "p", "h", NEW, NEW)], BATCH.replace("k int, ", "")).withColumn("k", F.lit(zero).cast("double"))
        counts = table.merge(batch, ["k"], TS)
    assert counts == MergeCounts(unchanged=1)


def test_many_loads_equal_one_after_another(spark, tmp_path):
    rng = random.Random(8)
    plain = HistoryTable(spark, str(tmp_path / "plain"), spark.createDataFrame([], SCHEMA).schema).create()
    parted = laid_out(spark, tmp_path / "parted", "buckets")
    for day in range(1, 5):
        data = [(k, rng.choice("ab"), rng.choice("pq"), "h", NEW, NEW) for k in rng.sample(range(60), 6)]
        for table in (plain, parted):
            table.merge(frame(spark, data, BATCH), KEYS, f"2024-06-0{day} 00:00:00")
    assert as_text(parted.read()) == as_text(plain.read())
    plain.purge(1, "2024-07-01 00:00:00")
    parted.purge(1, "2024-07-01 00:00:00")
    assert as_text(parted.read()) == as_text(plain.read())
    assert as_text(merge.current_versions(parted.read())) == as_text(parted.active())


@pytest.mark.parametrize("wrong", [
    {"buckets": 4}, {"buckets": 4, "keys": ["nope"]}, {"buckets": 4, "keys": ["k"], "partition_by": ["g"]},
    {"partition_by": ["IsActive"]}, {"partition_by": ["InsertedDateTime"]}])
def test_layouts_that_cannot_be(spark, tmp_path, wrong):
    with pytest.raises(ValueError):
        HistoryTable(spark, str(tmp_path), spark.createDataFrame([], SCHEMA).schema, **wrong).create()


def test_buckets_of_other_keys(spark, tmp_path):
    table = laid_out(spark, tmp_path, "buckets")
    table.merge(frame(spark, [(1, "a", "p", "h", NEW, NEW)], BATCH), KEYS, TS)
    with pytest.raises(ValueError, match="buckets are of the keys"):
        table.merge(frame(spark, [(1, "a", "p", "h", NEW, NEW)], BATCH), ["k"], TS)


def test_partition_key_of_the_document(spark, tmp_path):
    sink = {
        "System": {"EntityPath": "t", "PartitionKey": "Region, "},
        "Catalogue": {"Schema": {"NaturalKey": ["Id"], "Attributes": [
            {"Name": "Id", "Type": "int"}, {"Name": "Region", "Type": "string"}]}},
    }
    source = {"System": {"EntityPath": "s", "EntityName": "s", "FileFormat": {"Extension": ".csv"}}}
    config = JobConfig.from_documents("t", sink, source, str(tmp_path), str(tmp_path), str(tmp_path / "state"))
    assert config.partition_by == ("Region",)
    assert target_table(spark, config).layout.partition_by == ("Region",)
