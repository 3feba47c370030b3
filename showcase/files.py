"""File sources and delimited sinks.

Each query writes rows of the given tables to the shared folder in the format
under test and reads them back.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.catalogue import FileFormat, read_properties_frame
from millrace.session import work_path
from millrace.sinks.targets import output_path, write_delimited_target
from millrace.sources import (
    RawEntity,
    append_log,
    incremental_read,
    read_delimited,
    read_files,
    read_many,
    read_multiline,
    read_repaired,
    read_whole_text,
    write_delimited,
)
from showcase.fixtures import CUT, NTZ
from showcase.registry import query, table

#: Files a task writes, at most, where every row becomes one.
FILES_EACH = 256

_TALK_SQL = 'SELECT conv_id, turn, role, text, TRUE AS has_lineage FROM conversations'


def _lineage() -> F.Column:
    return (F.col("file_name").isNotNull() & F.col("file_modification_time").isNotNull()).alias("has_lineage")


def _talk(df: DataFrame) -> DataFrame:
    return df.select(F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), "role", "text", _lineage())


@query("scan_delimited", _TALK_SQL)
def scan_delimited(spark: SparkSession, folder: str) -> DataFrame:
    """Texts with line breaks and quotes, a delimiter of two characters."""
    path, fmt = work_path(spark, "delimited"), FileFormat(delimiter="||")
    write_delimited(table(spark, folder, "conversations"), path, fmt)
    return _talk(read_delimited(spark, path, fmt))


@query("scan_multiline", _TALK_SQL)
def scan_multiline(spark: SparkSession, folder: str) -> DataFrame:
    """The same scan, each file read by many tasks in spite of the line breaks."""
    path, fmt = work_path(spark, "multiline"), FileFormat(delimiter="||")
    write_delimited(table(spark, folder, "conversations"), path, fmt)
    return _talk(read_multiline(spark, path, fmt))


@query("scan_split_any_quotes", """
SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'in"side ' || o_orderstatus WHEN 1 THEN 'two' || chr(10) || 'lines, "' || o_orderstatus || '"'
         WHEN 2 THEN '"he said "' || o_orderstatus || '" there"' ELSE 'back' || chr(92) END AS note FROM orders""")
def scan_split_any_quotes(spark: SparkSession, folder: str) -> DataFrame:
    """Quotes inside unquoted fields, escaped and unescaped ones inside quoted fields, line breaks: one file, many tasks."""
    status, kind = F.col("o_orderstatus"), F.col("o_orderkey") % 4
    note = (
        F.when(kind == 0, F.concat(F.lit('in"side '), status))
        .when(kind == 1, F.concat(F.lit('"two\nlines, \\"'), status, F.lit('\\""')))
        .when(kind == 2, F.concat(F.lit('"he said "'), status, F.lit('" there"')))
        .otherwise(F.lit('"back\\\\"'))
    )
    path = work_path(spark, "any-quotes")
    lines = table(spark, folder, "orders").select(F.concat_ws(",", F.col("o_orderkey").cast("string"), note).alias("value"))
    lines.coalesce(1).write.text(path)
    setting = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "64k")  # several tasks even for a small table
    try:
        found = read_multiline(spark, path, FileFormat(header=False), columns=["o_orderkey", "note"], lineage=False)
        found = found.select(F.col("o_orderkey").cast("bigint"), "note")
        result = work_path(spark, "any-quotes-read")
        found.write.parquet(result)
    finally:
        spark.conf.set(setting, before)
    return spark.read.parquet(result)


@query("scan_by_format", """
SELECT 'json' AS format, p_partkey, p_name, p_retailprice FROM part
UNION ALL SELECT 'orc', p_partkey, p_name, p_retailprice FROM part
UNION ALL SELECT 'parquet', p_partkey, p_name, p_retailprice FROM part
UNION ALL SELECT 'csv', p_partkey, p_name, p_retailprice FROM part""")
def scan_by_format(spark: SparkSession, folder: str) -> DataFrame:
    parts = table(spark, folder, "part").select("p_partkey", "p_name", "p_retailprice")
    frames = []
    for name in ("json", "orc", "parquet", "csv"):
        path = work_path(spark, name)
        writer = parts.write.option("header", True) if name == "csv" else parts.write
        writer.format(name).save(path)
        read = read_files(spark, path, f".{name}").select(
            F.lit(name).alias("format"), F.col("p_partkey").cast("bigint"), "p_name",
            F.col("p_retailprice").cast("double"),
        )
        frames.append(read)
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


@query("scan_glob", """
SELECT o_orderkey, o_orderstatus, TRUE AS has_lineage FROM orders WHERE year(o_orderdate) < 2000""")
def scan_glob(spark: SparkSession, folder: str) -> DataFrame:
    """Orders in one folder per year, of which a glob takes the nineties."""
    path = work_path(spark, "by-year")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", F.year("o_orderdate").alias("year"))
    orders.write.partitionBy("year").option("header", True).csv(path)
    found = read_delimited(spark, f"{path}/year=199*", FileFormat(multiline=False))
    return found.select(F.col("o_orderkey").cast("bigint"), "o_orderstatus", _lineage())


@query("multi_file_union", """
SELECT c_custkey, c_name, c_acctbal, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment
FROM customer""")
def multi_file_union(spark: SparkSession, folder: str) -> DataFrame:
    """Files with different headers, united by name; one of them lacks a column."""
    customers = table(spark, folder, "customer").drop("c_nationkey")
    credit, debit = work_path(spark, "credit"), work_path(spark, "debit")
    write_delimited(customers.filter("c_acctbal >= 0"), credit)
    write_delimited(customers.filter("c_acctbal < 0").select("c_name", "c_acctbal", "c_custkey"), debit)
    united = read_many(spark, [credit, debit], FileFormat(multiline=False), by_name=True)
    return united.select(
        F.col("c_custkey").cast("bigint"), "c_name", F.col("c_acctbal").cast("double"), "c_mktsegment"
    )


@query("incremental_read", f"""
SELECT o_orderkey, o_orderpriority, 'Standard' AS "MemberType" FROM orders WHERE o_orderdate >= TIMESTAMP '{CUT}'""")
def incremental_read_(spark: SparkSession, folder: str) -> DataFrame:
    """Two drops; the mark is the newest file of the first, so only the second is read."""
    path = work_path(spark, "drops")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority", "o_orderdate")
    late = F.col("o_orderdate") >= F.lit(CUT).cast(NTZ)
    fmt = FileFormat(multiline=False)
    write_delimited(orders.filter(~late), f"{path}/drop=1", fmt)
    seen = read_delimited(spark, f"{path}/drop=1", fmt).agg(F.max("file_modification_time").cast("string"))
    mark = seen.head()[0]
    write_delimited(orders.filter(late), f"{path}/drop=2", fmt)
    new = incremental_read(spark, RawEntity(path, "orders", fmt), mark, "/drop=*", ["MemberType"])
    return new.select(F.col("o_orderkey").cast("bigint"), "o_orderpriority", "MemberType")


@query("incremental_read_by_log", """
SELECT o_orderkey, o_orderstatus FROM orders
WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '2000-01-01'""")
def incremental_read_by_log(spark: SparkSession, folder: str) -> DataFrame:
    """A folder per year; the log says when each was processed, and two marks choose three of them."""
    path, fmt = work_path(spark, "logged"), FileFormat(multiline=False)
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", F.year("o_orderdate").alias("year"))
    orders.write.partitionBy("year").option("header", True).csv(path)
    entity = RawEntity(path, "orders", fmt, log=work_path(spark, "orders.meta"))
    per_year = orders.groupBy("year").agg(F.count(F.lit(1)).cast("int").alias("NumberOfRows"))
    append_log(per_year.select(
        F.lit(".").alias("FilePath"), "NumberOfRows", F.format_string("year=%d", "year").alias("FileName"),
        F.make_timestamp("year", *[F.lit(n) for n in (12, 31, 0, 0, 0)]).alias("ProcessedDateTime"),
    ), entity.log_folder)
    found = incremental_read(spark, entity, "1996-12-31 00:00:00", upper="1999-12-31 00:00:00")
    return found.select(F.col("o_orderkey").cast("bigint"), "o_orderstatus")


@query("overwrite_roundtrip", "SELECT p_partkey, p_name, p_size FROM part WHERE p_size > 25")
def overwrite_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """The second write replaces the first."""
    parts = table(spark, folder, "part").select("p_partkey", "p_name", "p_size")
    path = output_path(work_path(spark, "target"), "part", ".csv")
    write_delimited_target(parts, path, "Overwrite")
    write_delimited_target(parts.filter("p_size > 25"), path, "TruncateReload")
    back = read_delimited(spark, path, lineage=False)
    return back.select(F.col("p_partkey").cast("bigint"), "p_name", F.col("p_size").cast("int"))


def write_file_per_row(lines: DataFrame, path: str) -> None:
    """Each value as a file of its own, written by many tasks however few hold the rows."""
    tasks = max(ceil(lines.count() / FILES_EACH), lines.sparkSession.sparkContext.defaultParallelism)
    lines.repartition(tasks).write.option("maxRecordsPerFile", 1).text(path)


@query("whole_file_text", """
SELECT page_id, html, TRUE AS has_lineage FROM pages""")
def whole_file_text(spark: SparkSession, folder: str) -> DataFrame:
    """One page per file, each read as one value."""
    path = work_path(spark, "pages")
    pages = table(spark, folder, "pages").select(
        F.to_json(F.struct("page_id", "html")).alias("value"))
    write_file_per_row(pages, path)
    whole = read_whole_text(spark, path)
    page = F.from_json(F.col("text"), "page_id bigint, html string")
    return whole.select(page.alias("page"), _lineage()).select("page.page_id", "page.html", "has_lineage")


@query("nested_config_fields", """
SELECT s_name AS entity, '.csv' AS extension, CAST(s_nationkey AS VARCHAR) AS retention, 'csv' AS read_format
FROM supplier""")
def nested_config_fields(spark: SparkSession, folder: str) -> DataFrame:
    """One properties document per supplier, its nested settings as columns."""
    path = work_path(spark, "properties")
    document = F.struct(F.struct(
        F.col("s_name").alias("EntityName"), F.col("s_nationkey").cast("string").alias("AllowedRetention"),
        F.struct(F.lit(".csv").alias("Extension")).alias("FileFormat"),
    ).alias("System"))
    suppliers = table(spark, folder, "supplier").select(F.to_json(document, {"pretty": "true"}).alias("value"))
    write_file_per_row(suppliers, path)
    return read_properties_frame(spark, path, {
        "entity": "System.EntityName", "extension": "System.FileFormat.Extension",
        "retention": "System.AllowedRetention",
    })


_HEADER = "conv_id|*text|*turn|*role"


def _with_header(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    yield pd.DataFrame({"value": [_HEADER]})
    yield from batches


def write_malformed(talks: DataFrame, path: str) -> None:
    """Two bytes per character, every field in quotes, none escaped, CR LF between records."""
    quoted = F.concat(
        F.lit('"'), F.concat_ws('"|*"', F.col("conv_id").cast("string"), "text", F.col("turn").cast("string"), "role"),
        F.lit('"'),
    )
    lines = talks.select(quoted.alias("value")).mapInPandas(_with_header, "value string")
    raw = lines.select(F.encode("value", "UTF-16LE").cast("string").alias("value"))
    raw.write.option("lineSep", "\r\n").option("encoding", "UTF-16LE").text(path)


@query("repair_delimited", _TALK_SQL)
def repair_delimited(spark: SparkSession, folder: str) -> DataFrame:
    """Texts in quotes of their own, with line breaks, are whole after the repair."""
    path = work_path(spark, "malformed")
    write_malformed(table(spark, folder, "conversations"), path)
    return _talk(read_repaired(spark, path, columns=_HEADER.split("|*")))
