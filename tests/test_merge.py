"""Merges against a row-by-row restatement of the two passes, and their properties."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import merge
from millrace.operators.merge import OUTCOME
from tests.conftest import rows

SCHEMA = (
    "k int, g string, v string, hashedKey string, InsertedDateTime timestamp, UpdatedDateTime timestamp, "
    "EffectiveStartDate timestamp, EffectiveEndDate timestamp, IsActive boolean"
)
BATCH = "k int, g string, v string, hashedKey string, InsertedDateTime timestamp, UpdatedDateTime timestamp"
KEYS = ["k", "g"]
TS = "2024-06-01 00:00:00"
OLD, NEW = "2020-01-01 00:00:00", "2024-05-31 00:00:00"


def frame(spark, data, schema):
    times = [f for f in schema.split(", ") if f.endswith("timestamp")]
    text = schema.replace(" timestamp", " string")
    df = spark.createDataFrame(data, text)
    return df.withColumns({t.split()[0]: F.col(t.split()[0]).cast("timestamp") for t in times})


def as_text(df):
    return rows(df.select(*[F.col(n).cast("string").alias(n) if k == "timestamp" else F.col(n) for n, k in df.dtypes]))


def two_passes(sink, batch, ts=TS):
    """Close active versions that differ, then insert keys left without an active version."""
    table = [list(r) for r in sink]
    for row in table:
        if row[8] is not True or None in row[:2]:
            continue
        match = [b for b in batch if b[:2] == tuple(row[:2])]
        if match and row[2] != match[0][2]:
            row[5], row[7], row[8] = ts, ts, False
    active = {tuple(r[:2]) for r in table if r[8] is True and None not in r[:2]}
    for b in batch:
        if b[:2] not in active:
            table.append([*b, b[4] or ts, None, True])
    return sorted(map(tuple, table), key=repr)


def random_tables(seed, duplicate_active=False):
    rng = random.Random(seed)
    keys = [(i, rng.choice("ab")) for i in range(40)] + [(None, "a"), (7, None)]
    values = [None, "p", "q"]
    sink, batch = [], []
    for key in keys:
        if rng.random() < 0.7:
            for _ in range(rng.randint(1, 3) if duplicate_active else 1):
                sink.append((*key, rng.choice(values), "h", OLD, OLD, OLD, None, True))
        if rng.random() < 0.4:
            sink.append((*key, rng.choice(values), "h", OLD, OLD, OLD, "2021-01-01 00:00:00", False))
        if rng.random() < 0.1:
            sink.append((*key, "p", "h", OLD, OLD, OLD, None, None))
        if rng.random() < 0.6:
            batch.append((*key, rng.choice(values), "other", rng.choice([NEW, None]), NEW))
    return sink, batch


@pytest.mark.parametrize("strategy", ["outer", "lookup", "auto"])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_two_passes(spark, strategy, seed):
    sink, batch = random_tables(seed)
    got = merge.scd2_merge(frame(spark, sink, SCHEMA), frame(spark, batch, BATCH), KEYS, TS, strategy=strategy)
    assert as_text(got) == two_passes(sink, batch)


@pytest.mark.parametrize("threshold", ["1b", "1g"])
@pytest.mark.parametrize("strategy", ["outer", "lookup", "auto"])
def test_several_active_versions_at_every_size(spark, strategy, threshold):
    sink, batch = random_tables(5, duplicate_active=True)
    s, b = frame(spark, sink, SCHEMA), frame(spark, batch, BATCH)
    setting = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(setting)
    spark.conf.set(setting, threshold)
    try:
        assert as_text(merge.scd2_merge(s, b, KEYS, TS, strategy=strategy)) == two_passes(sink, batch)
    finally:
        spark.conf.set(setting, before)


@pytest.mark.parametrize("strategy", ["outer", "lookup"])
def test_repeating_a_batch_changes_nothing(spark, strategy):
    sink, batch = random_tables(9)
    keyed = [b for b in batch if None not in b[:2]]
    s, b = frame(spark, sink, SCHEMA), frame(spark, keyed, BATCH)
    once = merge.scd2_merge(s, b, KEYS, TS, strategy=strategy)
    twice = merge.scd2_merge(once, b, KEYS, "2025-01-01 00:00:00", strategy=strategy)
    assert as_text(twice) == as_text(once)
    active = once.filter("IsActive and k is not null and g is not null")
    assert active.count() == active.select(*KEYS).distinct().count()
    assert once.count() >= s.count()


@pytest.mark.parametrize("strategy", ["outer", "lookup"])
def test_null_changes_make_versions(spark, strategy):
    sink = [(i, "a", "p" if i % 2 else None, "h", OLD, OLD, OLD, None, True) for i in range(20)]
    batch = [(i, "a", None if i % 2 else "p", "h", NEW, NEW) for i in range(20)]
    s, b = frame(spark, sink, SCHEMA), frame(spark, batch, BATCH)
    assert merge.scd2_metrics(s, b, KEYS, TS, strategy=strategy).first() == (20, 20, 0)
    assert merge.find_changes(s, b, KEYS).count() == 20
    assert merge.find_changes(s, b, KEYS, null_safe=False).count() == 0


def test_excluded_columns_never_make_versions(spark):
    sink = [(1, "a", "p", "h", OLD, OLD, OLD, None, True)]
    batch = [(1, "a", "p", "changed", NEW, NEW)]
    s, b = frame(spark, sink, SCHEMA), frame(spark, batch, BATCH)
    assert merge.find_changes(s, b, KEYS).count() == 0
    assert merge.find_changes(s, b, KEYS, exclude=["v"]).count() == 1
    with pytest.raises(ValueError, match="no columns left"):
        merge.find_changes(s, b, KEYS, exclude=[*merge.DEFAULT_EXCLUDE, "v"])


@pytest.mark.parametrize("strategy", ["outer", "lookup"])
def test_duplicate_batch_keys_fail_or_are_ordered(spark, strategy):
    sink = [(1, "a", "p", "h", OLD, OLD, OLD, None, True)]
    batch = [(1, "a", "q", "h", OLD, NEW), (1, "a", "r", "h", NEW, NEW)]
    s, b = frame(spark, sink, SCHEMA), frame(spark, batch, BATCH)
    with pytest.raises(Exception, match="duplicate key in the batch: 1, a"):
        merge.scd2_merge(s, b, KEYS, TS, strategy=strategy).collect()
    latest = merge.scd2_merge(s, b, KEYS, TS, strategy=strategy, duplicates="InsertedDateTime")
    assert [r["v"] for r in latest.filter("IsActive").collect()] == ["r"]


def test_null_keys_are_inserted_quarantined_or_refused(spark):
    sink = [(1, "a", "p", "h", OLD, OLD, OLD, None, True)]
    batch = [(None, "a", "q", "h", NEW, NEW), (2, "a", "q", "h", NEW, NEW)]
    s, b = frame(spark, sink, SCHEMA), frame(spark, batch, BATCH)
    assert merge.scd2_merge(s, b, KEYS, TS).count() == 3
    assert merge.scd2_merge(s, b, KEYS, TS, null_keys="quarantine").count() == 2
    assert merge.quarantined(b, KEYS).count() == 1
    with pytest.raises(Exception, match="NULL in key columns"):
        merge.scd2_merge(s, b, KEYS, TS, null_keys="fail").collect()


def test_keys_absent_from_the_batch_stay(spark):
    sink = [(1, "a", "p", "h", OLD, OLD, OLD, None, True)]
    s, b = frame(spark, sink, SCHEMA), frame(spark, [], BATCH)
    for strategy in ("outer", "lookup"):
        assert as_text(merge.scd2_merge(s, b, KEYS, TS, strategy=strategy)) == as_text(s)


def test_passes_alone(spark):
    sink, batch = random_tables(11)
    s, b = frame(spark, sink, SCHEMA), frame(spark, batch, BATCH)
    expired = merge.scd2_expire(s, b, KEYS, TS)
    assert expired.count() == s.count()
    inserted = merge.scd2_insert(expired, b, KEYS, TS)
    assert as_text(expired.unionByName(inserted)) == two_passes(sink, batch)


def test_outcomes_cover_every_row(spark):
    sink, batch = random_tables(12)
    s, b = frame(spark, sink, SCHEMA), frame(spark, batch, BATCH)
    counts = {r[OUTCOME]: r["count"] for r in merge.scd2_merge(
        s, b, KEYS, TS, with_outcome=True).groupBy(OUTCOME).count().collect()}
    metrics = merge.scd2_metrics(s, b, KEYS, TS).first().asDict()
    assert {k: counts.get(k, 0) for k in metrics} == metrics
    assert counts["history"] == sum(1 for r in sink if r[8] is not True)


def test_unknown_batch_columns_and_keys_are_refused(spark):
    s = frame(spark, [(1, "a", "p", "h", OLD, OLD, OLD, None, True)], SCHEMA)
    b = frame(spark, [(1, "a", "p", "h", NEW, NEW)], BATCH)
    with pytest.raises(ValueError, match="extra"):
        merge.scd2_merge(s, b.withColumn("extra", F.lit(1)), KEYS, TS)
    with pytest.raises(ValueError, match="nokey"):
        merge.scd2_merge(s, b, ["nokey"], TS)
    with pytest.raises(ValueError, match="at least one key"):
        merge.scd2_merge(s, b, [], TS)


def test_append_all_keeps_both_versions(spark):
    s = frame(spark, [(1, "a", "p", "h", OLD, OLD, OLD, None, True)], SCHEMA)
    b = frame(spark, [(1, "a", "p", "h", NEW, NEW)], BATCH)
    assert merge.append_all(s, b, TS).filter("IsActive").count() == 2


def test_upsert_keeps_inserted_time_and_null_keys(spark):
    sink = spark.createDataFrame([(1, "a", "t0"), (2, "b", "t0"), (None, "n", "t0")], "k int, v string, InsertedDateTime string")
    batch = spark.createDataFrame([(2, None, "t1"), (3, "c", "t1"), (None, "m", "t1")], "k int, v string, InsertedDateTime string")
    assert rows(merge.scd1_upsert(sink, batch, ["k"])) == sorted([
        (1, "a", "t0"), (2, None, "t0"), (3, "c", "t1"), (None, "m", "t1"), (None, "n", "t0")], key=repr)
    partial = merge.scd1_upsert(sink, batch.select("k"), ["K"], null_keys="quarantine")
    assert rows(partial) == sorted([(1, "a", "t0"), (2, "b", "t0"), (3, None, None), (None, "n", "t0")], key=repr)


def test_retention_keeps_open_and_undated_versions(spark):
    data = [
        (1, "a", "p", "h", OLD, OLD, OLD, "2024-05-01 00:00:00", False),
        (2, "a", "p", "h", OLD, OLD, OLD, "2024-05-02 23:00:00", False),
        (3, "a", "p", "h", OLD, OLD, OLD, None, False),
        (4, "a", "p", "h", OLD, OLD, OLD, "2020-05-02 00:00:00", True),
        (5, "a", "p", "h", OLD, OLD, OLD, "2020-05-02 00:00:00", None),
    ]
    kept = merge.retention_purge(frame(spark, data, SCHEMA), 30, TS)
    assert sorted(r["k"] for r in kept.collect()) == [2, 3, 4, 5]


def test_plain_files_refuse_row_level_merges(spark, tmp_path):
    spark.sql(f"create table plain_sink ({SCHEMA}) using parquet location '{tmp_path}/plain'")
    try:
        batch = frame(spark, [(1, "a", "p", "h", NEW, NEW)], BATCH)
        with pytest.raises(Exception, match="(?i)merge"):
            merge.merge_into(batch, "plain_sink", KEYS, TS)
    finally:
        spark.sql("drop table plain_sink")
