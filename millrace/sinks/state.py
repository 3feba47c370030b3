"""Stored high-water marks: one row per load, entity and source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.functions.columns import time_literal
from millrace.operators.watermark import FIRST_MARK, latest_marks
from millrace.sinks import folders

STATE_SCHEMA = "entity string, source string, hwm string, rows_affected bigint, written_at timestamp"


class HwmState:
    """The state table below ``path``, partitioned by entity."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def frame(self) -> DataFrame:
        if not folders.exists(self.spark, self.path):
            return self.spark.createDataFrame([], STATE_SCHEMA)
        return self.spark.read.schema(STATE_SCHEMA).parquet(self.path)

    def read(self, entity: str, source: str | None = None) -> str:
        """The latest mark of an entity (and source); the first mark when none is stored."""
        rows = self.frame().filter(F.col("entity") == entity)
        rows = rows.filter(F.col("source").eqNullSafe(F.lit(source)))
        row = latest_marks(rows).head()
        return row["hwm"] if row else FIRST_MARK

    def has(self, entity: str, source: str | None, written_at) -> bool:
        """Whether a mark of that time, or a later one, is stored."""
        rows = self.frame().filter((F.col("entity") == entity) & F.col("source").eqNullSafe(F.lit(source)))
        return not rows.filter(F.col("written_at") >= time_literal(written_at)).isEmpty()

    def for_role(self, role: str, entity: str, source: str | None = None, run_ts=None) -> str:
        """A source's mark is the run's time, a sink's is stored, others start over."""
        name = role.strip().lower()
        if name == "source":
            stamp = time_literal(run_ts).cast("string").alias("hwm")
            return self.spark.range(1).select(stamp).head()["hwm"]
        return self.read(entity, source) if name == "sink" else FIRST_MARK

    def write(self, entity: str, hwm: str | None, rows_affected: int = 0, source: str | None = None, run_ts=None) -> str:
        """Append a mark; an absent mark repeats the stored one. Call after the data is published."""
        mark = hwm if hwm is not None else self.read(entity, source)
        row = self.spark.range(0, 1, 1, 1).select(
            F.lit(entity).alias("entity"), F.lit(source).cast("string").alias("source"), F.lit(str(mark)).alias("hwm"),
            F.lit(int(rows_affected or 0)).cast("bigint").alias("rows_affected"),
            time_literal(run_ts).alias("written_at"),
        )
        row.write.mode("append").partitionBy("entity").parquet(self.path)
        return str(mark)
