"""Registered queries: one function per operator, each with its SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register ``function(spark, folder)`` under ``name``."""

    def register(function: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            # Times are compared without a zone, so the session must not have one.
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return function(spark, folder)

        QUERIES[name] = run
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")
