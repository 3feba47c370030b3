"""Every registered query equals its SQL; plans keep their shape."""

from __future__ import annotations

import pytest

import __spark_entry__ as driver
from millrace.operators import merge
from millrace.session import work_path
from showcase.fixtures import ORDER_KEY, RUN_TS, order_batch, order_history
from tests.compare import connect, difference

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(driver.queries()))
def test_query_equals_sql(spark, duck, name):
    assert difference(spark, duck, name, SMALL) is None


def test_names_and_entry(spark):
    assert set(driver.oracle_sql()) <= set(driver.queries())
    assert driver.entry(spark).count() > 0


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark):
    sink, batch = order_history(spark, SMALL), order_batch(spark, SMALL)
    sink_path, batch_path = work_path(spark, "plan-sink"), work_path(spark, "plan-batch")
    sink.write.partitionBy("IsActive").parquet(sink_path)
    batch.write.parquet(batch_path)
    return spark.read.schema(sink.schema).parquet(sink_path), spark.read.parquet(batch_path)


def test_shuffled_plan(stored):
    plan = plan_of(merge.scd2_merge(*stored, ORDER_KEY, RUN_TS, strategy="outer"))
    # The table: once whole, once with its keys and compared columns. The batch: whole, and as what is looked up.
    assert plan.count("Exchange hashpartitioning") == 5
    assert "BroadcastHashJoin [_sink.o_orderkey" not in plan and "LeftOuter" in plan
    assert plan.count("PartitionFilters: [isnotnull(IsActive") >= 1


def test_small_batch_is_broadcast(stored):
    plan = plan_of(merge.scd2_merge(*stored, ORDER_KEY, RUN_TS))
    assert "BroadcastHashJoin [_sink.o_orderkey" in plan
    # Compared columns must not become join keys.
    assert "coalesce(_sink.o_custkey" not in plan
    with pytest.raises(ValueError):
        merge.scd2_merge(*stored, ORDER_KEY, RUN_TS, strategy="guess")


def test_bucketed_table_is_not_shuffled(spark, stored):
    sink, batch = stored
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    sink.write.bucketBy(8, "o_orderkey").sortBy("o_orderkey").saveAsTable("bucketed_history")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = plan_of(merge.scd2_merge(spark.table("bucketed_history"), batch, ORDER_KEY, RUN_TS, strategy="outer"))
        # Only the batch and the keys found equal are shuffled.
        assert plan.count("Exchange hashpartitioning") == 3
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        spark.sql("drop table bucketed_history")


def test_queries_register_without_optional_libraries():
    """A hash library is absent: the other queries are registered all the same."""
    import os
    import subprocess
    import sys

    script = "import sys; sys.modules['xxhash'] = None\nimport __spark_entry__ as e\nprint('scd2_merge' in e.queries(), 'pipeline' in e.queries())"
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", script], cwd=root, capture_output=True, text=True, timeout=120)
    assert done.stdout.split() == ["True", "False"], done.stderr[-1000:]
