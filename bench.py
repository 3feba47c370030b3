"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

Each query is written to Spark's ``noop`` sink, so every row and column is
computed; the best of ``$BENCH_RUNS`` runs counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from millrace.catalogue import Attribute, FileFormat  # noqa: E402
from millrace.operators import cast_attributes, merge  # noqa: E402
from millrace.operators.projection import add_history_columns  # noqa: E402
from millrace.session import build_session, work_path  # noqa: E402
from millrace.sinks import HistoryTable, folders  # noqa: E402
from millrace.sources import RawEntity, incremental_read, read_repaired, write_delimited  # noqa: E402
from showcase import QUERIES  # noqa: E402
from showcase.files import write_malformed  # noqa: E402
from showcase.registry import table  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

REGISTERED = [
    "scd2_merge", "scd2_merge_large_batch", "scd2_merge_small_batch", "scd2_composite_key", "scd2_metrics",
    "change_detect_nullsafe", "scd1_upsert", "retention_purge", "dedupe_dirty_key", "dedupe_by_key", "drop_duplicates",
    "cast_types", "cast_timezone", "cast_report", "pipeline_full", "calculate_hash_key", "hwm_date_filter",
    "next_hwm", "hwm_state", "files_to_process", "scan_delimited", "multi_file_union", "incremental_read",
    "repair_delimited", "history_job", "history_stream", "scd2_several_active", "scd1_metrics", "append_repeated",
]


WIDE: list[str] = []


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def wide_cast(spark):
    """Line items as 200 text columns, cast to a catalogue of 200 attributes."""
    lines = table(spark, FOLDER, "lineitem")
    kinds = [("l_orderkey", "bigint"), ("l_linenumber", "int"), ("l_quantity", "double"), ("l_shipdate", "datetime")]
    names = [(f"c{i}", *kinds[i % len(kinds)]) for i in range(200)]
    text = lines.select(*[F.col(source).cast("string").alias(name) for name, source, _ in names])
    path = work_path(spark, "wide")
    # One file per core: the given table is a single small file.
    text.repartition(int(CPUS)).write.parquet(path)
    WIDE.append(path)
    attributes = [Attribute(name, kind) for name, _, kind in names]
    return lambda: run(cast_attributes(spark.read.parquet(path), attributes))


def repair_only(spark):
    path = work_path(spark, "malformed")
    write_malformed(table(spark, FOLDER, "conversations"), path)
    return lambda: run(read_repaired(spark, path))


def chained_cast(spark):
    """The same 200 columns cast one after the other, as a chain of projections."""
    wide_cast(spark)  # writes the table; only its path is of use here
    path = WIDE[-1]
    kinds = ["bigint", "int", "double", "timestamp"]

    def action():
        frame = spark.read.parquet(path)
        for i in range(200):
            frame = frame.withColumn(f"c{i}", F.col(f"c{i}").try_cast(kinds[i % 4]))
        run(frame)

    return action


def customer_merge(spark):
    """Half of the customers, a third of them changed, merged into their history."""
    customers = table(spark, FOLDER, "customer")
    sink = add_history_columns(customers, "2020-01-01 00:00:00")
    third = F.pmod(F.xxhash64("c_custkey"), F.lit(3)) == 0
    batch = customers.filter(F.pmod(F.xxhash64("c_custkey"), F.lit(2)) == 0)
    batch = batch.withColumn("c_acctbal", F.when(third, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal")))
    return lambda: run(merge.scd2_merge(sink, batch, ["c_custkey"], "2024-01-01 00:00:00"))


def stored_merge(spark):
    """A batch of one percent merged into a stored history table of all orders."""
    orders = table(spark, FOLDER, "orders")
    small = orders.filter(F.pmod(F.xxhash64("o_orderkey"), F.lit(100)) == 0).withColumn("o_orderstatus", F.lit("X"))
    history = add_history_columns(orders, "2020-01-01 00:00:00")

    def action():
        sink = HistoryTable(spark, work_path(spark, "history"), history.schema).create()
        sink.replace(history)
        started = time.perf_counter()
        sink.merge(small, ["o_orderkey"], "2024-01-01 00:00:00")
        return time.perf_counter() - started

    return action


def touched_merge(spark):
    """Ten rows merged into a stored history table of all orders in 64 buckets: the cost goes with the batch."""
    orders = table(spark, FOLDER, "orders")
    few = orders.orderBy("o_orderkey").limit(10).withColumn("o_orderstatus", F.lit("X"))
    history = add_history_columns(orders, "2020-01-01 00:00:00")

    def action():
        keys = ["o_orderkey"]
        sink = HistoryTable(spark, work_path(spark, "history"), history.schema, buckets=64, keys=keys).create()
        sink.replace(history)
        started = time.perf_counter()
        sink.merge(few, keys, "2024-01-01 00:00:00")
        return time.perf_counter() - started

    return action


def one_new_of_many(spark):
    """100 delimited files, one of them newer than the mark."""
    path = work_path(spark, "many")
    raw = table(spark, FOLDER, "orders").select(F.col("o_orderkey").cast("string"), "o_orderstatus")
    fmt = FileFormat(delimiter="|", multiline=False)
    write_delimited(raw.repartition(100), path, fmt)
    names = [n for n in folders.children(spark, path) if n.startswith("part-")]
    for number, name in enumerate(names):
        folders.set_time(spark, f"{path}/{name}", 1_000_000_000_000 if number else 1_600_000_000_000)
    entity = RawEntity(path, "orders", fmt)
    return lambda: run(incremental_read(spark, entity, "2015-01-01 00:00:00", "/*"))


def best(action) -> float:
    times = []
    for _ in range(RUNS):
        started = time.perf_counter()
        own = action()  # an action that prepares something tells its own time
        times.append(own if isinstance(own, float) else time.perf_counter() - started)
    return round(min(times), 3)


def main() -> None:
    spark = build_session("bench", f"local[{CPUS}]", **{
        "spark.sql.shuffle.partitions": CPUS, "spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    actions = {name: (lambda name=name: run(QUERIES[name](spark, FOLDER))) for name in REGISTERED}
    actions["cast_200_columns"] = wide_cast(spark)
    actions["cast_200_chained"] = chained_cast(spark)
    actions["repair_only"] = repair_only(spark)
    actions["merge_customer"] = customer_merge(spark)
    actions["merge_small_batch_stored"] = stored_merge(spark)
    actions["merge_touched_buckets"] = touched_merge(spark)
    actions["incremental_one_of_100"] = one_new_of_many(spark)
    chosen = sys.argv[1:] or list(actions)
    actions[chosen[0]]()  # a first run warms the JVM and is not counted
    results = {name: best(actions[name]) for name in chosen}
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(results.values()), 3), "unit": "sec",
        "queries": results, "sf": FOLDER.rstrip("/").rsplit("sf", 1)[-1],
    }))
    spark.stop()


if __name__ == "__main__":
    main()
