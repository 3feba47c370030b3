"""Inputs the queries share, as Spark frames and as SQL, built from the given tables.

The history table holds every order placed before the cut, each finished one
with an earlier open version. The batch holds every order from the resend date
on: those before the cut come again, some changed, and those after it are new.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from showcase.registry import table

RESEND, CUT = "1998-01-01", "1999-06-01"
RUN_TS = "2002-01-01 06:00:00"
ORDER_KEY = ["o_orderkey"]

NTZ = "timestamp_ntz"
_BUSINESS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]


def order_history(spark: SparkSession, folder: str) -> DataFrame:
    old = table(spark, folder, "orders").filter(F.col("o_orderdate") < F.lit(CUT).cast(NTZ))
    finished = F.col("o_orderstatus") == "F"
    closing = F.col("o_orderdate") + F.expr("interval 30 days")
    active = old.select(
        *_BUSINESS,
        F.col("o_orderdate").alias("InsertedDateTime"),
        F.col("o_orderdate").alias("UpdatedDateTime"),
        F.when(finished, closing).otherwise(F.col("o_orderdate")).alias("EffectiveStartDate"),
        F.lit(None).cast(NTZ).alias("EffectiveEndDate"),
        F.lit(True).alias("IsActive"),
    )
    closed = old.filter(finished).select(
        "o_orderkey", "o_custkey", F.lit("O").alias("o_orderstatus"), "o_totalprice", "o_orderpriority",
        F.col("o_orderdate").alias("InsertedDateTime"),
        closing.alias("UpdatedDateTime"),
        F.col("o_orderdate").alias("EffectiveStartDate"),
        closing.alias("EffectiveEndDate"),
        F.lit(False).alias("IsActive"),
    )
    return active.unionByName(closed)


def order_batch(spark: SparkSession, folder: str) -> DataFrame:
    recent = table(spark, folder, "orders").filter(F.col("o_orderdate") >= F.lit(RESEND).cast(NTZ))
    again = F.col("o_orderdate") < F.lit(CUT).cast(NTZ)
    shipped = F.when(again & (F.col("o_orderstatus") == "P"), F.lit("F")).otherwise(F.col("o_orderstatus"))
    price = F.when(again & (F.col("o_orderpriority") == "1-URGENT"), F.lit(None)).otherwise(F.col("o_totalprice"))
    return recent.select(
        "o_orderkey", "o_custkey", shipped.alias("o_orderstatus"), price.cast("double").alias("o_totalprice"),
        "o_orderpriority",
        F.lit(RUN_TS).cast(NTZ).alias("InsertedDateTime"),
        F.lit(RUN_TS).cast(NTZ).alias("UpdatedDateTime"),
    )


HISTORY_SQL = f"""
sink AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority,
         o_orderdate AS "InsertedDateTime", o_orderdate AS "UpdatedDateTime",
         CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 30 DAY ELSE o_orderdate END AS "EffectiveStartDate",
         CAST(NULL AS TIMESTAMP) AS "EffectiveEndDate", TRUE AS "IsActive"
  FROM orders WHERE o_orderdate < TIMESTAMP '{CUT}'
  UNION ALL
  SELECT o_orderkey, o_custkey, 'O', o_totalprice, o_orderpriority, o_orderdate,
         o_orderdate + INTERVAL 30 DAY, o_orderdate, o_orderdate + INTERVAL 30 DAY, FALSE
  FROM orders WHERE o_orderdate < TIMESTAMP '{CUT}' AND o_orderstatus = 'F'
)"""

BATCH_SQL = f"""
batch AS (
  SELECT o_orderkey, o_custkey,
         CASE WHEN o_orderdate < TIMESTAMP '{CUT}' AND o_orderstatus = 'P' THEN 'F' ELSE o_orderstatus END AS o_orderstatus,
         CASE WHEN o_orderdate < TIMESTAMP '{CUT}' AND o_orderpriority = '1-URGENT' THEN NULL ELSE o_totalprice END AS o_totalprice,
         o_orderpriority,
         TIMESTAMP '{RUN_TS}' AS "InsertedDateTime", TIMESTAMP '{RUN_TS}' AS "UpdatedDateTime",
         TIMESTAMP '{RUN_TS}' AS "EffectiveStartDate", CAST(NULL AS TIMESTAMP) AS "EffectiveEndDate", TRUE AS "IsActive"
  FROM orders WHERE o_orderdate >= TIMESTAMP '{RESEND}'
)"""

# The two passes of the merge, one statement each.
PASSES_SQL = f"""
WITH {HISTORY_SQL}, {BATCH_SQL},
hit AS (
  SELECT s.o_orderkey FROM sink s JOIN batch b ON s.o_orderkey = b.o_orderkey AND s."IsActive"
  WHERE s.o_custkey IS DISTINCT FROM b.o_custkey OR s.o_orderstatus IS DISTINCT FROM b.o_orderstatus
     OR s.o_totalprice IS DISTINCT FROM b.o_totalprice OR s.o_orderpriority IS DISTINCT FROM b.o_orderpriority
),
pass_one AS (
  SELECT s.o_orderkey, s.o_custkey, s.o_orderstatus, s.o_totalprice, s.o_orderpriority, s."InsertedDateTime",
         CASE WHEN h.o_orderkey IS NOT NULL THEN TIMESTAMP '{RUN_TS}' ELSE s."UpdatedDateTime" END AS "UpdatedDateTime",
         s."EffectiveStartDate",
         CASE WHEN h.o_orderkey IS NOT NULL THEN TIMESTAMP '{RUN_TS}' ELSE s."EffectiveEndDate" END AS "EffectiveEndDate",
         s."IsActive" AND h.o_orderkey IS NULL AS "IsActive"
  FROM sink s LEFT JOIN hit h ON s.o_orderkey = h.o_orderkey AND s."IsActive"
),
pass_two AS (
  SELECT b.* FROM batch b
  WHERE NOT EXISTS (SELECT 1 FROM pass_one p WHERE p.o_orderkey = b.o_orderkey AND p."IsActive")
)"""


def raw_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as they come in files: strings under source names."""
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias("ORD_REF"),
        F.col("o_custkey").cast("string").alias("CUST_REF"),
        F.col("o_orderstatus").alias("STATUS_CD"),
        F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("PRICE"),
        F.date_format("o_orderdate", "dd/MM/yyyy").alias("ORD_DT"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("ORD_TS"),
        F.col("o_orderpriority").alias("PRIO"),
    )
