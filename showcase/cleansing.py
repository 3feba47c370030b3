"""Cleansing transformations and the pipeline."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.catalogue import catalogue_from
from millrace.functions.columns import file_columns
from millrace.operators import cleansing
from millrace.operators.pipeline import apply_pipeline
from millrace.operators.projection import add_audit_columns, add_extra_columns, order_columns
from showcase.fixtures import NTZ, RUN_TS, raw_orders
from showcase.registry import query, table


@query("drop_duplicates", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def drop_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    customers = table(spark, folder, "customer")
    return cleansing.drop_duplicates(customers.unionByName(customers))


@query("drop_duplicate_orders", "SELECT DISTINCT l_orderkey, l_returnflag, l_linestatus FROM lineitem")
def drop_duplicate_orders(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_returnflag", "l_linestatus")
    return cleansing.drop_duplicates(lines)


@query("dedupe_by_key", """
SELECT * EXCLUDE (place) FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC NULLS LAST, event_id DESC) AS place FROM events
) WHERE place = 1""")
def dedupe_by_key(spark: SparkSession, folder: str) -> DataFrame:
    return cleansing.dedupe_by_key(table(spark, folder, "events"), "user_id, event_type: ts, event_id")


@query("dedupe_hot_key", """
SELECT * EXCLUDE (place) FROM (
  SELECT *, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice DESC NULLS LAST, o_orderkey ASC) AS place FROM orders
) WHERE place = 1""")
def dedupe_hot_key(spark: SparkSession, folder: str) -> DataFrame:
    """Three keys, each with a third of all rows: one row per key and task is shuffled."""
    return cleansing.dedupe_by_key(table(spark, folder, "orders"), "o_orderstatus: o_totalprice, o_orderkey asc")


@query("dedupe_dirty_key", """
SELECT * EXCLUDE (place) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate ASC NULLS LAST,
    l_partkey DESC NULLS LAST, l_suppkey DESC NULLS LAST, l_quantity DESC NULLS LAST, l_extendedprice DESC NULLS LAST,
    l_discount DESC NULLS LAST, l_tax DESC NULLS LAST, l_returnflag DESC NULLS LAST, l_linestatus DESC NULLS LAST) AS place
  FROM lineitem
) WHERE place = 1""")
def dedupe_dirty_key(spark: SparkSession, folder: str) -> DataFrame:
    """Ship dates tie, so the remaining columns decide."""
    return cleansing.dedupe_by_key(table(spark, folder, "lineitem"), "l_orderkey, l_linenumber: l_shipdate asc")


@query("rename_attributes", """
SELECT c_custkey AS "CustomerReference", c_name AS "CustomerName", c_nationkey, c_acctbal, c_mktsegment FROM customer""")
def rename_attributes(spark: SparkSession, folder: str) -> DataFrame:
    pairs = "C_CUSTKEY:CustomerReference, c_name:CustomerName, not_there:Ignored"
    return cleansing.rename_attributes(table(spark, folder, "customer"), pairs)


@query("remove_attributes", "SELECT p_partkey, p_name, p_type, p_size FROM part")
def remove_attributes(spark: SparkSession, folder: str) -> DataFrame:
    return cleansing.remove_attributes(table(spark, folder, "part"), "P_BRAND, p_retailprice, not_there")


@query("calculate_hash_key", """
SELECT *, sha256(concat_ws('||', CAST(c_custkey AS VARCHAR), c_name, c_mktsegment)) AS "hashedKey",
       CASE WHEN c_acctbal < 0 THEN 'a:debit' ELSE 'a:credit' END AS side
FROM customer""")
def calculate_hash_key(spark: SparkSession, folder: str) -> DataFrame:
    return cleansing.calculate_attribute(table(spark, folder, "customer"), [
        "hashedKey:sha2(concat_ws('||', c_custkey, c_name, c_mktsegment), 256)",
        "side:case when c_acctbal < 0 then 'a:debit' else 'a:credit' end",
    ])


@query("null_attributes", """
SELECT c_custkey, CAST(NULL AS VARCHAR) AS c_name, c_nationkey, CAST(NULL AS DOUBLE) AS c_acctbal, c_mktsegment
FROM customer""")
def null_attributes(spark: SparkSession, folder: str) -> DataFrame:
    return cleansing.null_attributes(table(spark, folder, "customer"), "c_name, c_acctbal")


@query("mask_attributes", """
SELECT c_custkey,
       regexp_replace(regexp_replace(regexp_replace(c_name, '[A-Z]', 'X', 'g'), '[a-z]', 'x', 'g'), '[0-9]', 'n', 'g') AS c_name,
       sha256(CAST(c_nationkey AS VARCHAR)) AS c_nationkey, c_acctbal,
       CASE WHEN c_mktsegment IS NULL THEN NULL ELSE '***' END AS c_mktsegment
FROM customer""")
def mask_attributes(spark: SparkSession, folder: str) -> DataFrame:
    return cleansing.mask_attributes(table(spark, folder, "customer"), "c_name, c_nationkey:sha2, c_mktsegment:redact")


@query("string_to_struct", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
       json_extract_string(props, '$.absent') AS absent FROM events""")
def string_to_struct(spark: SparkSession, folder: str) -> DataFrame:
    parsed = cleansing.string_to_struct(table(spark, folder, "events"), "props:k INT, absent STRING")
    return parsed.select("event_id", "props.k", "props.absent")


@query("string_to_struct_inferred", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CAST(event_id AS VARCHAR) AS id,
       CAST(event_id % 3 AS BIGINT) AS tags, CAST(event_id % 2 + 0.5 AS DOUBLE) AS half FROM events""")
def string_to_struct_inferred(spark: SparkSession, folder: str) -> DataFrame:
    """The schema is merged over all rows: lists of several lengths, whole and broken numbers."""
    events = table(spark, folder, "events")
    tags = F.slice(F.array(F.lit("a"), F.lit("b")), F.lit(1), (F.col("event_id") % 3).cast("int"))
    document = F.to_json(F.struct(
        F.get_json_object("props", "$.k").cast("bigint").alias("k"), F.col("event_id").cast("string").alias("id"), tags.alias("tags"),
        (F.col("event_id") % 2 + F.lit(0.5)).alias("half"),
    ))
    parsed = cleansing.string_to_struct(events.select("event_id", document.alias("doc")), "doc")
    return parsed.select(
        "event_id", "doc.k", "doc.id", F.coalesce(F.size("doc.tags"), F.lit(0)).cast("bigint").alias("tags"),
        F.col("doc.half").cast("double").alias("half"),
    )


@query("flatten_struct", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, CAST(event_id AS VARCHAR) AS props_event_id
FROM events""")
def flatten_struct(spark: SparkSession, folder: str) -> DataFrame:
    """A field whose name is taken gets the column's name in front."""
    nested = table(spark, folder, "events").select("event_id", F.struct(
        F.from_json("props", "k INT").getField("k").alias("k"), F.col("event_id").cast("string").alias("event_id"),
    ).alias("props"))
    return cleansing.flatten_attribute(nested, "props")


@query("flatten_array", "SELECT vec_id, label, unnest(embedding) AS embedding FROM embeddings")
def flatten_array(spark: SparkSession, folder: str) -> DataFrame:
    return cleansing.flatten_attribute(table(spark, folder, "embeddings"), "embedding")


@query("extract_optional", """
SELECT event_id, json_extract_string(props, '$.k') AS k, CAST(NULL AS VARCHAR) AS missing_field,
       CAST(NULL AS VARCHAR) AS missing_column, event_type AS whole FROM events""")
def extract_optional(spark: SparkSession, folder: str) -> DataFrame:
    found = cleansing.extract_optional(table(spark, folder, "events"), [
        "k:props.k", "missing_field:props.no.such", "missing_column:nowhere.k", "whole:event_type",
    ])
    return found.select("event_id", "k", "missing_field", "missing_column", "whole")


@query("extract_json_value", """
SELECT s_suppkey, s_name AS name, CAST(s_nationkey AS VARCHAR) AS nation, 'EUR' AS currency, s_name AS from_xml,
       CAST(NULL AS VARCHAR) AS absent FROM supplier""")
def extract_json_value(spark: SparkSession, folder: str) -> DataFrame:
    """Elements with attributes hold their text under a key of its own."""
    documents = table(spark, folder, "supplier").select(
        "s_suppkey",
        F.to_json(F.struct(F.struct(
            F.col("s_name").alias("name"),
            F.struct(F.lit("EUR").alias("@currency"), F.col("s_nationkey").alias("#text")).alias("nation"),
        ).alias("supplier"))).alias("doc"),
        F.concat(F.lit("<supplier><name>"), F.col("s_name"), F.lit("</name></supplier>")).alias("xml"),
    )
    return cleansing.extract_json_value(documents, [
        "name:doc.supplier.name", "nation:doc.supplier.nation", "currency:doc.supplier.nation.@currency",
        "from_xml:xml/supplier/name", "absent:doc.supplier.none",
    ]).drop("doc", "xml")


@query("extract_from_xml_struct", """
SELECT s_suppkey, s_suppkey AS id, s_name AS name, s_nationkey AS nation,
       CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE s_suppkey % 3 END AS parts FROM supplier WHERE s_suppkey % 5 <> 0
UNION ALL SELECT s_suppkey, NULL, NULL, NULL, NULL FROM supplier WHERE s_suppkey % 5 = 0""")
def extract_from_xml_struct(spark: SparkSession, folder: str) -> DataFrame:
    """Attributes, nested and repeated elements under one schema for all rows; every fifth document breaks off."""
    key = F.col("s_suppkey")
    parts = F.array_join(F.transform(F.sequence(F.lit(1), key % 3), lambda n: F.concat(F.lit("<part>"), n, F.lit("</part>"))), "")
    whole = F.concat(
        F.lit('<supplier id="'), key, F.lit('"><name>'), F.col("s_name"), F.lit("</name>\n<place><nation>"), F.col("s_nationkey"),
        F.lit("</nation></place>"), F.when(key % 3 > 0, parts).otherwise(""), F.lit("</supplier>"),
    )
    documents = table(spark, folder, "supplier").select(
        "s_suppkey", F.when(key % 5 == 0, F.substring_index(whole, "</name>", 1)).otherwise(whole).alias("xml")
    )
    found = cleansing.extract_json_value(documents, "doc:xml<>")
    return found.select(
        "s_suppkey", F.col("doc._id").cast("bigint").alias("id"), "doc.name", F.col("doc.place.nation").cast("bigint").alias("nation"),
        F.when(F.col("doc").isNotNull(), F.coalesce(F.size("doc.part"), F.lit(0))).cast("bigint").alias("parts"),
    )


@query("catalogue_order", """
SELECT s_acctbal AS "S_AcctBal", s_suppkey, s_name FROM supplier""")
def catalogue_order(spark: SparkSession, folder: str) -> DataFrame:
    catalogue = catalogue_from({"Catalogue": {"Schema": {"Attributes": [
        {"Name": "s_name", "Type": "string", "OrdinalPosition": 3},
        {"Name": "absent", "Type": "int", "OrdinalPosition": 4},
        {"Name": "S_AcctBal", "Type": "double", "OrdinalPosition": 1},
        {"Name": "s_suppkey", "Type": "bigint", "OrdinalPosition": 2},
    ]}}})
    return order_columns(table(spark, folder, "supplier"), catalogue)


@query("audit_columns", f"""
SELECT o_orderkey, o_orderdate AS "InsertedDateTime", TIMESTAMP '{RUN_TS}' AS "UpdatedDateTime" FROM orders""")
def audit_columns(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", F.col("o_orderdate").alias("InsertedDateTime"))
    return add_audit_columns(orders, RUN_TS).withColumn("UpdatedDateTime", F.col("UpdatedDateTime").cast(NTZ))


@query("extra_columns", f"""
SELECT r_regionkey, r_name, n_name, 'Standard' AS "MemberType", TIMESTAMP '{RUN_TS}' AS "InsertedDateTime",
       TIMESTAMP '{RUN_TS}' AS "UpdatedDateTime"
FROM region JOIN nation ON n_regionkey = r_regionkey""")
def extra_columns(spark: SparkSession, folder: str) -> DataFrame:
    nations = table(spark, folder, "nation")
    rows = table(spark, folder, "region").join(nations, F.col("n_regionkey") == F.col("r_regionkey"))
    rows = rows.select("r_regionkey", "r_name", "n_name")
    added = add_extra_columns(rows, ["MemberType", "InsertedDateTime", "UpdatedDateTime"], RUN_TS)
    return added.withColumns({c: F.col(c).cast(NTZ) for c in ("InsertedDateTime", "UpdatedDateTime")})


@query("file_date_columns", """
SELECT event_id, '/raw/events/' || strftime(ts, '%Y/%m') || '/events_' || strftime(ts, '%Y%m%d') || '.csv' AS "filePath",
       'events_' || strftime(ts, '%Y%m%d') || '.csv' AS "fileName", CAST(ts AS DATE) AS "fileDate",
       CAST(year(ts - INTERVAL 3 MONTH) AS INTEGER) AS "businessYear" FROM events""")
def file_date_columns(spark: SparkSession, folder: str) -> DataFrame:
    path = F.concat(
        F.lit("/raw/events/"), F.date_format("ts", "yyyy/MM"), F.lit("/events_"),
        F.date_format("ts", "yyyyMMdd"), F.lit(".csv"),
    )
    events = table(spark, folder, "events").select("event_id", path.alias("path"))
    return events.select("event_id", *[c.alias(n) for n, c in file_columns("path").items()])


PIPELINE_DOCUMENT = {
    "EntityFullyQualifiedName": "cleansed.sales.Orders",
    "Extended": {"Cleanse": {"CleansingTransformations": [
        {"RenameAttributes": "ORD_REF:OrderReference, CUST_REF:CustomerReference, STATUS_CD:Status, PRICE:Price, ORD_DT:OrderDate, PRIO:Priority"},
        {"DropDuplicates": ""},
        {"CastAttributes": "cleansed.sales.Orders"},
        {"CalculateAttribute": "hashedKey:sha2(concat_ws('||', OrderReference, CustomerReference), 256)"},
        {"MaskAttributes": "Priority"},
        {"RemoveAttributes": "ORD_TS"},
    ]}},
    "Catalogue": {"Schema": {"NaturalKey": ["OrderReference"], "Attributes": [
        {"Name": "OrderReference", "Type": "bigint", "OrdinalPosition": 1},
        {"Name": "CustomerReference", "Type": "bigint", "OrdinalPosition": 2},
        {"Name": "OrderDate", "Type": "date", "Format": "dd/MM/yyyy", "OrdinalPosition": 3},
        {"Name": "Status", "Type": "nvarchar", "OrdinalPosition": 4},
        {"Name": "Price", "Type": "decimal", "Precision": "12", "Scale": "2", "OrdinalPosition": 5},
        {"Name": "Priority", "Type": "string", "OrdinalPosition": 6},
        {"Name": "hashedKey", "Type": "string", "OrdinalPosition": 7},
    ]}},
}


@query("pipeline_full", """
SELECT o_orderkey AS "OrderReference", o_custkey AS "CustomerReference", CAST(o_orderdate AS DATE) AS "OrderDate",
       o_orderstatus AS "Status", CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DECIMAL(12,2)) AS "Price",
       regexp_replace(regexp_replace(regexp_replace(o_orderpriority, '[A-Z]', 'X', 'g'), '[a-z]', 'x', 'g'), '[0-9]', 'n', 'g') AS "Priority",
       sha256(concat_ws('||', CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR))) AS "hashedKey"
FROM orders""")
def pipeline_full(spark: SparkSession, folder: str) -> DataFrame:
    catalogue = catalogue_from(PIPELINE_DOCUMENT)
    cleansed = apply_pipeline(raw_orders(spark, folder), catalogue.transformations, catalogue)
    return order_columns(cleansed, catalogue)
