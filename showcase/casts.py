"""Casting to a catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.catalogue import Attribute
from millrace.operators.casting import cast_attributes, cast_report
from showcase.fixtures import NTZ, raw_orders
from showcase.registry import query, table


def _zoneless(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, the form the given tables use."""
    times = [n for n, kind in df.dtypes if kind == "timestamp"]
    return df.withColumns({n: F.col(n).cast(NTZ) for n in times})


_SIMPLE = [
    Attribute("ORD_REF", "bigint"), Attribute("CUST_REF", "int"), Attribute("STATUS_CD", "nvarchar"),
    Attribute("PRICE", "decimal", 12, 2), Attribute("PRIO", "integer"),
]


@query("cast_simple", """
SELECT o_orderkey AS "ORD_REF", CAST(o_custkey AS INTEGER) AS "CUST_REF", o_orderstatus AS "STATUS_CD",
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DECIMAL(12,2)) AS "PRICE",
       TRY_CAST(o_orderpriority AS INTEGER) AS "PRIO"
FROM orders""")
def cast_simple(spark: SparkSession, folder: str) -> DataFrame:
    """Priorities are texts such as ``1-URGENT``: unreadable as numbers, so NULL."""
    return cast_attributes(raw_orders(spark, folder).drop("ORD_DT", "ORD_TS"), _SIMPLE)


@query("cast_types", """
SELECT l_orderkey, CAST(l_linenumber AS SMALLINT) AS l_linenumber, CAST(l_quantity AS TINYINT) AS l_quantity,
       CAST(l_extendedprice AS DECIMAL(10,0)) AS l_extendedprice, CAST(l_discount AS FLOAT) AS l_discount,
       l_returnflag = 'R' AS l_returnflag, CAST(l_shipdate AS DATE) AS l_shipdate
FROM lineitem""")
def cast_types(spark: SparkSession, folder: str) -> DataFrame:
    """The narrower types, a decimal of scale 0, and booleans."""
    rows = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
        F.when(F.col("l_returnflag") == "R", "true").otherwise("false").alias("l_returnflag"),
        F.col("l_shipdate").cast("string").alias("l_shipdate"),
    )
    return cast_attributes(rows, [
        Attribute("l_orderkey", "long"), Attribute("l_linenumber", "smallint"), Attribute("l_quantity", "tinyint"),
        Attribute("l_extendedprice", "numeric", "10", 0), Attribute("l_discount", "float"),
        Attribute("l_returnflag", "bit"), Attribute("l_shipdate", "date"),
    ])


@query("cast_partial", """
SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS "O_CustKey", o_orderstatus, o_totalprice,
       o_orderdate, o_orderpriority FROM orders""")
def cast_partial(spark: SparkSession, folder: str) -> DataFrame:
    """Absent columns are skipped, right ones left alone, names come out in catalogue case."""
    return cast_attributes(table(spark, folder, "orders"), [
        Attribute("o_orderkey", "bigint"), Attribute("O_CustKey", "varchar"), Attribute("absent", "int"),
        Attribute("o_totalprice", "double"),
    ])


@query("cast_date_format", """
SELECT CAST(o_orderkey AS VARCHAR) AS "ORD_REF", CAST(o_orderdate AS DATE) AS "ORD_DT",
       CAST(NULL AS DATE) AS "PRIO" FROM orders""")
def cast_date_format(spark: SparkSession, folder: str) -> DataFrame:
    raw = raw_orders(spark, folder).select("ORD_REF", "ORD_DT", "PRIO")
    return cast_attributes(raw, [Attribute("ORD_DT", "date", format="dd/MM/yyyy"), Attribute("PRIO", "date", format="dd/MM/yyyy")])


@query("cast_timestamp_format", """
SELECT CAST(o_orderkey AS VARCHAR) AS "ORD_REF", date_trunc('day', o_orderdate)::TIMESTAMP AS "ORD_DT",
       date_trunc('second', o_orderdate)::TIMESTAMP AS "ORD_TS", CAST(NULL AS TIMESTAMP) AS "PRIO" FROM orders""")
def cast_timestamp_format(spark: SparkSession, folder: str) -> DataFrame:
    raw = raw_orders(spark, folder).select("ORD_REF", "ORD_DT", "ORD_TS", "PRIO")
    return _zoneless(cast_attributes(raw, [
        Attribute("ORD_DT", "datetime", format="dd/MM/yyyy"),
        Attribute("ORD_TS", "datetime2"),
        Attribute("PRIO", "datetimeoffset", format="yyyy-MM-dd HH:mm:ss"),
    ]))


def _event_times(spark: SparkSession, folder: str) -> DataFrame:
    """Event times as UTC text, half a year on as well: the given ones are all in winter."""
    second = F.date_trunc("second", F.col("ts"))
    text = F.date_format(second, "yyyy-MM-dd HH:mm:ss")
    later = F.date_format(second + F.expr("interval 180 days"), "yyyy-MM-dd HH:mm:ss")
    return table(spark, folder, "events").select(
        "event_id", text.alias("winter"), later.alias("summer"), later.alias("plain"),
        second.cast("timestamp").alias("stamped"),
    )


@query("cast_timezone", """
WITH e AS (SELECT event_id, date_trunc('second', ts)::TIMESTAMP AS t FROM events)
SELECT event_id, timezone('Europe/London', timezone('UTC', t)) AS winter,
       timezone('America/New_York', timezone('UTC', t + INTERVAL 180 DAY)) AS summer,
       CAST(t + INTERVAL 180 DAY AS DATE) AS plain,
       timezone('Europe/London', timezone('UTC', t)) AS stamped
FROM e""")
def cast_timezone(spark: SparkSession, folder: str) -> DataFrame:
    """Zones apply to times and never to dates; ``stamped`` already is a time and is shifted on request."""
    return _zoneless(cast_attributes(_event_times(spark, folder), [
        Attribute("winter", "datetime", format="yyyy-MM-dd HH:mm:ss", timezone="Europe/London"),
        Attribute("summer", "datetime", timezone="America/New_York"),
        Attribute("plain", "date", format="yyyy-MM-dd HH:mm:ss", timezone="America/New_York"),
        Attribute("stamped", "datetime", timezone="Europe/London"),
    ], shift_existing=True))


@query("cast_timezone_default", """
WITH e AS (SELECT event_id, date_trunc('second', ts)::TIMESTAMP AS t FROM events)
SELECT event_id, timezone('Europe/London', timezone('UTC', t)) AS winter,
       timezone('America/New_York', timezone('UTC', t + INTERVAL 180 DAY)) AS summer,
       timezone('Europe/London', timezone('UTC', t + INTERVAL 180 DAY)) AS plain,
       t AS stamped
FROM e""")
def cast_timezone_default(spark: SparkSession, folder: str) -> DataFrame:
    """The default zone is used where the column names none; existing times stay."""
    return _zoneless(cast_attributes(_event_times(spark, folder), [
        Attribute("winter", "datetime"), Attribute("summer", "datetime", timezone="America/New_York"),
        Attribute("plain", "datetime", format="yyyy-MM-dd HH:mm:ss"), Attribute("stamped", "datetime"),
    ], default_tz="Europe/London"))


@query("cast_report", """
SELECT 'CUST_REF' AS column_name, count(o_custkey) AS present, CAST(0 AS BIGINT) AS failed FROM orders
UNION ALL SELECT 'PRICE', count(o_totalprice), count(o_totalprice) FILTER (o_totalprice >= 100000) FROM orders
UNION ALL SELECT 'ORD_DT', count(o_orderdate), 0 FROM orders
UNION ALL SELECT 'PRIO', count(o_orderpriority), count(o_orderpriority) FROM orders""")
def cast_report_(spark: SparkSession, folder: str) -> DataFrame:
    """Prices of six digits do not fit ``decimal(7,2)``."""
    return cast_report(raw_orders(spark, folder), [
        Attribute("CUST_REF", "bigint"), Attribute("PRICE", "decimal", 7, 2),
        Attribute("ORD_DT", "date", format="dd/MM/yyyy"), Attribute("PRIO", "int"), Attribute("STATUS_CD", "char"),
        Attribute("absent", "int"),
    ])
