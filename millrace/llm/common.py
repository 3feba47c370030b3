"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import threading
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.pandas.types import to_arrow_schema

from millrace.session import work_path
from millrace.sinks.folders import remove

#: Bytes of text that a task holds as Python objects or arrays at a time.
SLICE_BYTES = 4 << 20


#: Where this package lies: workers on the driver's machine find it there; a cluster gets it by ``--py-files``.
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def importable(spark: SparkSession) -> None:
    """Lets Python workers import this package."""
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, ROOT])


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def texts_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``text`` as UTF-8 bytes (null stays null); every other column is left behind, whatever its name."""
    return docs.select(
        docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").cast("binary").alias("text")
    )


#: Shuffle files go as soon as what they were for is written; unset, they stay until the driver happens to collect its garbage.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, label: str, codec: str = "zstd", **options: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again.

    Cuts the lineage: a lost executor costs the tasks it ran, not the steps before.
    """
    spark = df.sparkSession
    path = work_path(spark, label)
    if _scopes():
        _scopes()[-1].append(path)
    before = spark.conf.get(SHUFFLES_GO, "false")
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        df.write.option("compression", codec).options(**options).parquet(path)
    finally:
        spark.conf.set(SHUFFLES_GO, before)
    return spark.read.schema(df.schema).parquet(path)


_OPEN = threading.local()


def _scopes() -> list[list[str]]:
    if not hasattr(_OPEN, "scopes"):
        _OPEN.scopes = []
    return _OPEN.scopes


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Tables stored within go at the end, but for the last one: that is the result, and what is made of it must not read the others."""
    _scopes().append([])
    try:
        yield
    finally:
        *gone, last = _scopes().pop() or [None]
        for path in gone:
            remove(spark, path)
        if last and _scopes():
            _scopes()[-1].append(last)


def map_columns(
    df: DataFrame, function: Callable[[Iterator[dict[str, list]]], Iterable[dict[str, list]]], schema: StructType | str
) -> DataFrame:
    """``mapInArrow`` with batches as dictionaries of columns; ``function`` yields such dictionaries."""
    kind = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    arrow = to_arrow_schema(kind)
    importable(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source = ({n: c.to_pylist() for n, c in zip(b.schema.names, b.columns)} for b in batches if b.num_rows)
        for out in function(source):
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], type=f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, kind)


def keep_rows(df: DataFrame, decide: Callable[[list[bytes | None]], list[bool]], text_col: str = "text") -> DataFrame:
    """The rows whose text passes ``decide``, all columns as they are."""
    importable(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text_col).cast(pa.binary()).to_pylist()
            good = [k for part in slices([{"text": texts}]) for k in decide(part["text"])]
            yield batch.filter(pa.array(good, pa.bool_()))

    return df.mapInArrow(run, df.schema)


def slices(batches: Iterable[dict[str, list]], text: str = "text", limit: int = SLICE_BYTES) -> Iterator[dict[str, list]]:
    """The rows in slices of about ``limit`` bytes of text; a longer text is a slice of its own."""
    for batch in batches:
        names, at, size = list(batch), 0, 0
        for i, value in enumerate(batch[text]):
            size += len(value or b"")
            if size >= limit:
                yield {n: batch[n][at : i + 1] for n in names}
                at, size = i + 1, 0
        if at < len(batch[text]):
            yield {n: batch[n][at:] for n in names}


def remainder(column: str, modulus: int):
    """crc32 of the id as text, modulo ``modulus``; -1 for a null id."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % F.lit(modulus), F.lit(-1))
