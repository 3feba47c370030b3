"""Counting from the start of a file, in parallel.

Formats whose record ends depend on everything before them (the number of
delimiters, open quotes) need a running count or state per file. Files are read
by many tasks, one block each; a block's rows are counted inside the block, and
a prefix sum over a file's blocks, one small row per block, gives the rest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec, functions as F


def read_blocks(
    spark: SparkSession, paths: list[str], line_end: str, text: Column, encoding: str | None = None
) -> DataFrame:
    """Text between line ends with its place: ``path``, ``block``, ``place``, ``segment``."""
    reader = spark.read.option("lineSep", line_end)
    if encoding:
        reader = reader.option("encoding", encoding)
    return reader.text(paths).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
        text.alias("segment"),
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_modification_time").alias("file_modification_time"),
    )


def in_block() -> WindowSpec:
    """Rows of a block in file order."""
    return Window.partitionBy("path", "block").orderBy("place")


def with_counts(segments: DataFrame, counted: str) -> DataFrame:
    """Adds ``offset`` (sum of ``counted`` in earlier blocks of the file), ``running``
    (sum in earlier rows of the block) and ``total`` (sum in the block)."""
    totals = segments.groupBy("path", "block").agg(F.sum(counted).alias("total"))
    earlier_blocks = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.withColumn("offset", F.coalesce(F.sum("total").over(earlier_blocks), F.lit(0)))
    earlier_rows = in_block().rowsBetween(Window.unboundedPreceding, -1)
    running = segments.withColumn("running", F.coalesce(F.sum(counted).over(earlier_rows), F.lit(0)))
    return running.join(offsets, ["path", "block"])


def with_state(segments: DataFrame) -> DataFrame:
    """Adds ``inside``: the state of a two-state automaton before each segment; a file begins outside.

    ``from_outside`` and ``from_inside`` say whether a segment begun in either state ends inside. A segment so
    maps states to states: it leaves them, turns them round, or ends in one state whatever was before. Maps are
    composed along a block by the last segment of the last kind and the number of turns since, and
    block maps, one small row each, along a file in the same way.
    """
    fixes, odd = F.col("from_outside") == F.col("from_inside"), lambda n: n % 2 == 1
    turn = (F.col("from_outside") & ~F.col("from_inside")).cast("bigint")
    upto = in_block().rowsBetween(Window.unboundedPreceding, 0)
    before = in_block().rowsBetween(Window.unboundedPreceding, -1)
    told = segments.withColumn("turn", turn).withColumn("turns", F.sum("turn").over(upto))
    told = told.withColumn("fixed", F.when(fixes, F.struct("place", F.col("from_outside").alias("value"), "turns")))

    blocks = told.groupBy("path", "block").agg(F.max("fixed").alias("fixed"), F.sum("turn").alias("total"))
    ends = F.when(F.col("fixed").isNotNull(), F.col("fixed.value") != odd(F.col("total") - F.col("fixed.turns")))
    blocks = blocks.withColumn("ends", ends).withColumn("turn", F.when(ends.isNull(), odd(F.col("total"))).otherwise(False).cast("bigint"))
    in_file = Window.partitionBy("path").orderBy("block")
    blocks = blocks.withColumn("turns", F.sum("turn").over(in_file))
    earlier = in_file.rowsBetween(Window.unboundedPreceding, -1)
    settled = F.last(F.when(F.col("ends").isNotNull(), F.struct("ends", "turns")), ignorenulls=True).over(earlier)
    turns_so_far = F.coalesce(F.sum("turn").over(earlier), F.lit(0))
    blocks = blocks.withColumn("settled", settled).withColumn("so_far", turns_so_far)
    begins = F.when(F.col("settled").isNull(), odd(F.col("so_far"))).otherwise(
        F.col("settled.ends") != odd(F.col("so_far") - F.col("settled.turns"))
    )
    blocks = blocks.select("path", "block", begins.alias("begins"))

    told = told.withColumn("last_fixed", F.last("fixed", ignorenulls=True).over(before))
    told = told.withColumn("turns_before", F.col("turns") - F.col("turn"))
    inside = F.when(F.col("last_fixed").isNull(), F.col("begins") != odd(F.col("turns_before"))).otherwise(
        F.col("last_fixed.value") != odd(F.col("turns_before") - F.col("last_fixed.turns"))
    )
    helpers = ("turn", "turns", "fixed", "last_fixed", "turns_before", "begins", "from_outside", "from_inside")
    return told.join(blocks, ["path", "block"]).withColumn("inside", inside).drop(*helpers)


def joined_text(line_end: str) -> Column:
    """Aggregate: segments of a group in file order, put together again."""
    pieces = F.sort_array(F.collect_list(F.struct("block", "place", "segment")))
    return F.array_join(F.transform(pieces, lambda piece: piece["segment"]), line_end)
