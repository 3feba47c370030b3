"""History and current-state merges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.functions.predicates import DEFAULT_EXCLUDE
from millrace.operators import merge
from millrace.operators.cleansing import dedupe_by_key
from millrace.operators.projection import add_history_columns
from millrace.session import work_path
from millrace.sinks import HistoryTable, write_target
from showcase.fixtures import (
    BATCH_SQL,
    CUT,
    HISTORY_SQL,
    NTZ,
    ORDER_KEY,
    PASSES_SQL,
    RUN_TS,
    order_batch,
    order_history,
)
from showcase.registry import query, table


@query("scd2_merge", f"{PASSES_SQL} SELECT * FROM pass_one UNION ALL SELECT * FROM pass_two")
def scd2_merge(spark: SparkSession, folder: str) -> DataFrame:
    return merge.scd2_merge(order_history(spark, folder), order_batch(spark, folder), ORDER_KEY, RUN_TS)


@query("scd2_merge_large_batch", f"{PASSES_SQL} SELECT * FROM pass_one UNION ALL SELECT * FROM pass_two")
def scd2_merge_large_batch(spark: SparkSession, folder: str) -> DataFrame:
    """The plan for batches too large to broadcast: both sides are shuffled by key."""
    sink, batch = order_history(spark, folder), order_batch(spark, folder)
    return merge.scd2_merge(sink, batch, ORDER_KEY, RUN_TS, strategy="outer")


@query("scd2_merge_small_batch", f"{PASSES_SQL} SELECT * FROM pass_one UNION ALL SELECT * FROM pass_two")
def scd2_merge_small_batch(spark: SparkSession, folder: str) -> DataFrame:
    """The plan that the planner picks from the batch's size."""
    sink, batch = order_history(spark, folder), order_batch(spark, folder)
    return merge.scd2_merge(sink, batch, ORDER_KEY, RUN_TS, strategy="lookup")


@query("scd2_several_active", f"""WITH {HISTORY_SQL}, {BATCH_SQL},
doubled AS (
  SELECT * FROM sink
  UNION ALL
  SELECT o_orderkey, o_custkey, 'X', o_totalprice, o_orderpriority, "InsertedDateTime", "UpdatedDateTime",
         "EffectiveStartDate", "EffectiveEndDate", "IsActive"
  FROM sink WHERE "IsActive" AND o_orderstatus = 'F'
),
differing AS (
  SELECT s.*, b.o_orderkey IS NOT NULL AND (s.o_custkey IS DISTINCT FROM b.o_custkey OR s.o_orderstatus IS DISTINCT FROM b.o_orderstatus
     OR s.o_totalprice IS DISTINCT FROM b.o_totalprice OR s.o_orderpriority IS DISTINCT FROM b.o_orderpriority) AS changed
  FROM doubled s LEFT JOIN batch b ON s.o_orderkey = b.o_orderkey AND s."IsActive"
)
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, "InsertedDateTime",
       CASE WHEN changed THEN TIMESTAMP '{RUN_TS}' ELSE "UpdatedDateTime" END AS "UpdatedDateTime", "EffectiveStartDate",
       CASE WHEN changed THEN TIMESTAMP '{RUN_TS}' ELSE "EffectiveEndDate" END AS "EffectiveEndDate",
       "IsActive" AND NOT changed AS "IsActive"
FROM differing
UNION ALL
SELECT b.* FROM batch b
WHERE NOT EXISTS (SELECT 1 FROM differing d WHERE d.o_orderkey = b.o_orderkey AND d."IsActive" AND NOT d.changed)""")
def scd2_several_active(spark: SparkSession, folder: str) -> DataFrame:
    """Keys with two active versions, as appends make them; the batch closes those that differ."""
    sink = order_history(spark, folder)
    twice = sink.filter("IsActive AND o_orderstatus = 'F'").withColumn("o_orderstatus", F.lit("X"))
    return merge.scd2_merge(sink.unionByName(twice), order_batch(spark, folder), ORDER_KEY, RUN_TS, strategy="outer")


@query("scd2_expire", f"{PASSES_SQL} SELECT * FROM pass_one")
def scd2_expire(spark: SparkSession, folder: str) -> DataFrame:
    return merge.scd2_expire(order_history(spark, folder), order_batch(spark, folder), ORDER_KEY, RUN_TS)


@query("scd2_insert", f"""WITH {HISTORY_SQL}, {BATCH_SQL}
SELECT * FROM batch b WHERE NOT EXISTS (
  SELECT 1 FROM sink s WHERE s.o_orderkey = b.o_orderkey AND s."IsActive")""")
def scd2_insert(spark: SparkSession, folder: str) -> DataFrame:
    return merge.scd2_insert(order_history(spark, folder), order_batch(spark, folder), ORDER_KEY, RUN_TS)


@query("scd2_current", f"""{PASSES_SQL}, merged AS (SELECT * FROM pass_one UNION ALL SELECT * FROM pass_two)
SELECT * FROM merged WHERE "IsActive" """)
def scd2_current(spark: SparkSession, folder: str) -> DataFrame:
    return merge.current_versions(scd2_merge(spark, folder))


@query("scd2_metrics", f"""{PASSES_SQL}
SELECT (SELECT count(*) FROM hit) AS expired, (SELECT count(*) FROM pass_two) AS inserted,
       (SELECT count(*) FROM sink WHERE "IsActive") - (SELECT count(*) FROM hit) AS unchanged""")
def scd2_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return merge.scd2_metrics(order_history(spark, folder), order_batch(spark, folder), ORDER_KEY, RUN_TS)


@query("change_detect_nullsafe", f"{PASSES_SQL} SELECT o_orderkey FROM hit")
def change_detect_nullsafe(spark: SparkSession, folder: str) -> DataFrame:
    return merge.find_changes(order_history(spark, folder), order_batch(spark, folder), ORDER_KEY)


@query("change_detect_plain", f"""WITH {HISTORY_SQL}, {BATCH_SQL}
SELECT s.o_orderkey FROM sink s JOIN batch b ON s.o_orderkey = b.o_orderkey AND s."IsActive"
WHERE s.o_custkey <> b.o_custkey OR s.o_orderstatus <> b.o_orderstatus
   OR s.o_totalprice <> b.o_totalprice OR s.o_orderpriority <> b.o_orderpriority""")
def change_detect_plain(spark: SparkSession, folder: str) -> DataFrame:
    sink, batch = order_history(spark, folder), order_batch(spark, folder)
    return merge.find_changes(sink, batch, ORDER_KEY, null_safe=False)


@query("append_all", f"WITH {HISTORY_SQL}, {BATCH_SQL} SELECT * FROM sink UNION ALL SELECT * FROM batch")
def append_all(spark: SparkSession, folder: str) -> DataFrame:
    return merge.append_all(order_history(spark, folder), order_batch(spark, folder), RUN_TS)


@query("scd2_null_keys", f"""WITH {HISTORY_SQL}, {BATCH_SQL.replace("SELECT o_orderkey, o_custkey,", "SELECT CASE WHEN o_orderstatus <> 'P' THEN o_orderkey END AS o_orderkey, o_custkey,", 1)},
hit AS (
  SELECT s.o_orderkey FROM sink s JOIN batch b ON s.o_orderkey = b.o_orderkey AND s."IsActive"
  WHERE s.o_totalprice IS DISTINCT FROM b.o_totalprice OR s.o_orderstatus IS DISTINCT FROM b.o_orderstatus
)
SELECT s.o_orderkey, s.o_custkey, s.o_orderstatus, s.o_totalprice, s.o_orderpriority, s."InsertedDateTime",
       CASE WHEN h.o_orderkey IS NOT NULL THEN TIMESTAMP '{RUN_TS}' ELSE s."UpdatedDateTime" END AS "UpdatedDateTime",
       s."EffectiveStartDate",
       CASE WHEN h.o_orderkey IS NOT NULL THEN TIMESTAMP '{RUN_TS}' ELSE s."EffectiveEndDate" END AS "EffectiveEndDate",
       s."IsActive" AND h.o_orderkey IS NULL AS "IsActive"
FROM sink s LEFT JOIN hit h ON s.o_orderkey = h.o_orderkey AND s."IsActive"
UNION ALL
SELECT b.* FROM batch b WHERE NOT EXISTS (
  SELECT 1 FROM sink s WHERE s.o_orderkey = b.o_orderkey AND s."IsActive"
    AND s.o_orderkey NOT IN (SELECT o_orderkey FROM hit))""")
def scd2_null_keys(spark: SparkSession, folder: str) -> DataFrame:
    """A third of the batch has no key: such rows match nothing and are inserted."""
    open_orders = table(spark, folder, "orders").filter("o_orderstatus = 'P'").select("o_orderkey")
    batch = order_batch(spark, folder).join(open_orders.withColumn("open", F.lit(True)), "o_orderkey", "left")
    keyless = batch.withColumn("o_orderkey", F.when(F.col("open").isNull(), F.col("o_orderkey"))).drop("open")
    return merge.scd2_merge(order_history(spark, folder), keyless, ORDER_KEY, RUN_TS, strategy="outer")


_LATEST = ["o_custkey", "o_orderkey", "o_orderstatus", "o_orderpriority", "o_orderdate"]


@query("scd2_latest_per_key", f"""WITH ranked AS (
  SELECT o_custkey, o_orderkey, o_orderstatus, o_orderpriority, o_orderdate, o_orderdate < TIMESTAMP '{CUT}' AS early,
         row_number() OVER (PARTITION BY o_custkey, o_orderdate < TIMESTAMP '{CUT}' ORDER BY o_orderdate DESC, o_orderkey DESC) AS place
  FROM orders),
s AS (SELECT * FROM ranked WHERE early AND place = 1), b AS (SELECT * FROM ranked WHERE NOT early AND place = 1),
hit AS (SELECT s.o_custkey FROM s JOIN b USING (o_custkey)
        WHERE s.o_orderstatus <> b.o_orderstatus OR s.o_orderpriority <> b.o_orderpriority)
SELECT o_custkey, o_orderkey, o_orderstatus, o_orderpriority, o_orderdate, o_orderdate AS "EffectiveStartDate",
       CASE WHEN o_custkey IN (FROM hit) THEN TIMESTAMP '{RUN_TS}' END AS "EffectiveEndDate",
       o_custkey NOT IN (FROM hit) AS "IsActive" FROM s
UNION ALL
SELECT o_custkey, o_orderkey, o_orderstatus, o_orderpriority, o_orderdate, TIMESTAMP '{RUN_TS}', CAST(NULL AS TIMESTAMP), TRUE
FROM b WHERE o_custkey IN (FROM hit) OR o_custkey NOT IN (SELECT o_custkey FROM s)""")
def scd2_latest_per_key(spark: SparkSession, folder: str) -> DataFrame:
    """A batch with many rows per customer: the latest order of each counts."""
    orders = table(spark, folder, "orders").select(*_LATEST)
    late = F.col("o_orderdate") >= F.lit(CUT).cast(NTZ)
    known = dedupe_by_key(orders.filter(~late), "o_custkey: o_orderdate, o_orderkey").withColumns({
        "EffectiveStartDate": F.col("o_orderdate"), "EffectiveEndDate": F.lit(None).cast(NTZ), "IsActive": F.lit(True),
    })
    return merge.scd2_merge(
        known, orders.filter(late), ["o_custkey"], RUN_TS, exclude=[*DEFAULT_EXCLUDE, "o_orderkey", "o_orderdate"],
        duplicates=["o_orderdate", "o_orderkey"],
    )


@query("history_table_merge", f"{PASSES_SQL} SELECT * FROM pass_one UNION ALL SELECT * FROM pass_two")
def history_table_merge(spark: SparkSession, folder: str) -> DataFrame:
    """The merge on a stored table: active versions rewritten, closed ones added."""
    stored = _stored_history(spark, folder)
    stored.merge(order_batch(spark, folder), ORDER_KEY, RUN_TS)
    return stored.read()


@query("history_table_touched_buckets", f"{PASSES_SQL} SELECT * FROM pass_one UNION ALL SELECT * FROM pass_two")
def history_table_touched_buckets(spark: SparkSession, folder: str) -> DataFrame:
    """The merge on a table in buckets, one customer's share of the batch after the other: only touched buckets are rewritten."""
    history, batch = order_history(spark, folder), order_batch(spark, folder)
    stored = HistoryTable(spark, work_path(spark, "history"), history.schema, buckets=16, keys=ORDER_KEY).create()
    stored.replace(history)
    share = F.pmod(F.col("o_custkey"), F.lit(3))
    for part in range(3):
        stored.merge(batch.filter(share == part), ORDER_KEY, RUN_TS)
    return stored.read()


@query("history_table_append", f"WITH {HISTORY_SQL}, {BATCH_SQL} SELECT * FROM sink UNION ALL SELECT * FROM batch")
def history_table_append(spark: SparkSession, folder: str) -> DataFrame:
    stored = _stored_history(spark, folder)
    write_target(order_batch(spark, folder), stored, "append", ORDER_KEY, RUN_TS)
    return stored.read()


def _stored_history(spark: SparkSession, folder: str) -> HistoryTable:
    history = order_history(spark, folder)
    stored = HistoryTable(spark, work_path(spark, "history"), history.schema).create()
    stored.replace(history)
    return stored


_PURGE_TS = "1999-01-01 12:00:00"


@query("retention_purge", f"""WITH {HISTORY_SQL}
SELECT * FROM sink WHERE "IsActive" OR NOT ("EffectiveEndDate" < DATE '1999-01-01' - INTERVAL 400 DAY)""")
def retention_purge(spark: SparkSession, folder: str) -> DataFrame:
    return merge.retention_purge(order_history(spark, folder), 400, _PURGE_TS)


@query("history_table_purge", f"""WITH {HISTORY_SQL}
SELECT * FROM sink WHERE "IsActive" OR NOT ("EffectiveEndDate" < DATE '1999-01-01' - INTERVAL 400 DAY)""")
def history_table_purge(spark: SparkSession, folder: str) -> DataFrame:
    """Retention on a stored table: folders of old end days are let go unread."""
    stored = _stored_history(spark, folder)
    stored.purge(400, _PURGE_TS)
    return stored.read()


_SUPPLIER_TS, _UPSERT_TS = "2001-01-01 00:00:00", RUN_TS


@query("scd1_metrics", f"""WITH {HISTORY_SQL}, {BATCH_SQL}
SELECT (SELECT count(*) FROM sink s WHERE "IsActive" AND EXISTS (SELECT 1 FROM batch b WHERE b.o_orderkey = s.o_orderkey)) AS updated,
       (SELECT count(*) FROM batch b WHERE NOT EXISTS (SELECT 1 FROM sink s WHERE "IsActive" AND b.o_orderkey = s.o_orderkey)) AS inserted,
       (SELECT count(*) FROM sink s WHERE "IsActive" AND NOT EXISTS (SELECT 1 FROM batch b WHERE b.o_orderkey = s.o_orderkey)) AS unchanged""")
def scd1_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """How many rows an upsert updates, inserts and leaves alone."""
    active = merge.current_versions(order_history(spark, folder))
    return merge.scd1_metrics(active, order_batch(spark, folder), ORDER_KEY)


@query("scd1_upsert", f"""WITH batch AS (
  SELECT s_suppkey, s_name, s_nationkey, 0.0::DOUBLE AS s_acctbal FROM supplier WHERE s_acctbal < 0
  UNION ALL
  SELECT c_custkey + 1000000000, c_name, c_nationkey, c_acctbal FROM customer
)
SELECT coalesce(b.s_suppkey, s.s_suppkey) AS s_suppkey,
       CASE WHEN b.s_suppkey IS NOT NULL THEN b.s_name ELSE s.s_name END AS s_name,
       CASE WHEN b.s_suppkey IS NOT NULL THEN b.s_nationkey ELSE s.s_nationkey END AS s_nationkey,
       CASE WHEN b.s_suppkey IS NOT NULL THEN b.s_acctbal ELSE s.s_acctbal END AS s_acctbal,
       CASE WHEN s.s_suppkey IS NOT NULL THEN TIMESTAMP '{_SUPPLIER_TS}' ELSE TIMESTAMP '{_UPSERT_TS}' END AS "InsertedDateTime",
       CASE WHEN b.s_suppkey IS NOT NULL THEN TIMESTAMP '{_UPSERT_TS}' ELSE TIMESTAMP '{_SUPPLIER_TS}' END AS "UpdatedDateTime"
FROM supplier s FULL OUTER JOIN batch b ON s.s_suppkey = b.s_suppkey""")
def scd1_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """Overdrawn suppliers are reset, and every customer becomes a supplier."""
    suppliers = table(spark, folder, "supplier")
    before, now = F.lit(_SUPPLIER_TS).cast(NTZ), F.lit(_UPSERT_TS).cast(NTZ)
    sink = suppliers.withColumns({"InsertedDateTime": before, "UpdatedDateTime": before})
    reset = suppliers.filter("s_acctbal < 0").withColumn("s_acctbal", F.lit(0.0))
    new = table(spark, folder, "customer").select(
        (F.col("c_custkey") + 1_000_000_000).alias("s_suppkey"), F.col("c_name").alias("s_name"),
        F.col("c_nationkey").alias("s_nationkey"), F.col("c_acctbal").alias("s_acctbal"),
    )
    batch = reset.unionByName(new).withColumns({"InsertedDateTime": now, "UpdatedDateTime": now})
    return merge.scd1_upsert(sink, batch, ["s_suppkey"])


_CONV_TS = "2024-01-01 00:00:00"


@query("scd2_composite_key", f"""WITH batch AS (
  SELECT conv_id, turn, role, CASE WHEN role = 'user' THEN NULL ELSE text END AS text FROM conversations
  UNION ALL
  SELECT conv_id, CAST(-1 AS BIGINT), 'summary', CAST(count(*) AS VARCHAR) || ' turns' FROM conversations GROUP BY conv_id
),
hit AS (
  SELECT c.conv_id, c.turn FROM conversations c JOIN batch b ON c.conv_id = b.conv_id AND c.turn = b.turn
  WHERE c.role IS DISTINCT FROM b.role OR c.text IS DISTINCT FROM b.text
)
SELECT c.conv_id, c.turn, c.role, c.text, TIMESTAMP '{_CONV_TS}' AS "EffectiveStartDate",
       CASE WHEN h.conv_id IS NULL THEN NULL ELSE TIMESTAMP '{RUN_TS}' END AS "EffectiveEndDate",
       h.conv_id IS NULL AS "IsActive"
FROM conversations c LEFT JOIN hit h ON c.conv_id = h.conv_id AND c.turn = h.turn
UNION ALL
SELECT b.conv_id, b.turn, b.role, b.text, TIMESTAMP '{RUN_TS}', CAST(NULL AS TIMESTAMP), TRUE
FROM batch b LEFT JOIN conversations c ON c.conv_id = b.conv_id AND c.turn = b.turn
WHERE c.conv_id IS NULL OR EXISTS (SELECT 1 FROM hit h WHERE h.conv_id = b.conv_id AND h.turn = b.turn)""")
def scd2_composite_key(spark: SparkSession, folder: str) -> DataFrame:
    """User texts are withdrawn, and each conversation gets a summary turn."""
    talks = table(spark, folder, "conversations")
    sink = talks.withColumns({
        "EffectiveStartDate": F.lit(_CONV_TS).cast(NTZ),
        "EffectiveEndDate": F.lit(None).cast(NTZ),
        "IsActive": F.lit(True),
    })
    withdrawn = talks.withColumn("text", F.when(F.col("role") != "user", F.col("text")))
    summaries = talks.groupBy("conv_id").agg(
        F.lit(-1).cast("bigint").alias("turn"), F.lit("summary").alias("role"),
        F.concat(F.count(F.lit(1)).cast("string"), F.lit(" turns")).alias("text"),
    )
    batch = withdrawn.unionByName(summaries)
    return merge.scd2_merge(sink, batch, ["conv_id", "turn"], RUN_TS)


@query("scd2_columns", f"""SELECT c_custkey, c_name,
       CASE WHEN c_acctbal < 0 THEN NULL ELSE TIMESTAMP '{_SUPPLIER_TS}' END AS "InsertedDateTime",
       CASE WHEN c_acctbal < 0 THEN TIMESTAMP '{RUN_TS}' ELSE TIMESTAMP '{_SUPPLIER_TS}' END AS "EffectiveStartDate",
       CAST(NULL AS TIMESTAMP) AS "EffectiveEndDate", TRUE AS "IsActive"
FROM customer""")
def scd2_columns(spark: SparkSession, folder: str) -> DataFrame:
    inserted = F.when(F.col("c_acctbal") >= 0, F.lit(_SUPPLIER_TS).cast(NTZ))
    rows = table(spark, folder, "customer").select("c_custkey", "c_name", inserted.alias("InsertedDateTime"))
    marked = add_history_columns(rows, RUN_TS)
    return marked.withColumns({c: F.col(c).cast(NTZ) for c in ("EffectiveStartDate", "EffectiveEndDate")})
