"""Running totals and row numbers per group, also for groups too large for one task.

Ordinary groups use one window. The rows of hot groups are range-partitioned by their sort
order, so each chunk is a contiguous piece of the order; totals are kept per chunk, and each
chunk starts from the sum of the chunks before it. A chunk can continue at most one group of
the chunk before, so the table of starting values has at most one row per chunk and is
broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyweave.operators.hot_keys import HOT_ROWS, split_hot
from tallyweave.sources.staging import stage

CHUNK = "_chunk"
MIN_CHUNK_ROWS = 500
MANY_CHUNKS = 96


def chunk_count(df: DataFrame, hot_rows: int) -> int:
    """So many pieces that one has about half of ``hot_rows`` rows. A small ``hot_rows`` makes no more than ``MANY_CHUNKS`` pieces, or three per core,
    while one of them has no more than half of ``HOT_ROWS`` rows: every piece costs a sample of its rows in the driver, a block of every task that
    writes to it, and a file."""
    rows = 2 * df.count()
    enough = max(MANY_CHUNKS, 3 * df.sparkSession.sparkContext.defaultParallelism, -(-rows // HOT_ROWS))
    return max(2, min(-(-rows // max(hot_rows, MIN_CHUNK_ROWS)), enough))


def ordered_chunks(df: DataFrame, by: Sequence[str], order: Sequence[Column], name: str,
                   chunks: int) -> DataFrame:
    """Number contiguous pieces of (by, order). Written out, because the piece borders are
    sampled and must be the same for every reader."""
    pieces = df.repartitionByRange(chunks, *by, *order)
    return stage(pieces.withColumn(CHUNK, F.spark_partition_id()), name)


def chunked_running_sum(chunked: DataFrame, by: Sequence[str], order: Sequence[Column],
                        value: Column, out: str) -> DataFrame:
    by = list(by)
    totals = chunked.groupBy(*by, CHUNK).agg(F.sum(value).alias("_total"))
    earlier = Window.partitionBy(*by).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    start = (
        totals.withColumn("_start", F.sum("_total").over(earlier))
        .filter(F.col("_start").isNotNull())
        .select(*by, CHUNK, "_start")
    )
    so_far = Window.partitionBy(CHUNK, *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        chunked.join(F.broadcast(start), [*by, CHUNK], "left")
        .withColumn(out, F.sum(value).over(so_far) + F.coalesce("_start", F.lit(0)))
        .drop("_start")
    )


def sequence(df: DataFrame, by: Sequence[str], order: Sequence[Column], out: str, *,
             hot_rows: int = HOT_ROWS, chunks: int | None = None) -> DataFrame:
    """Row numbers 1..n per group in a total order."""
    cold, hot = split_hot(df, by, hot_rows)
    numbered = cold.withColumn(out, F.row_number().over(Window.partitionBy(*by).orderBy(*order)).cast("long"))
    if hot is None:
        return numbered
    chunked = ordered_chunks(hot, by, order, "sequence", chunks or chunk_count(hot, hot_rows))
    return numbered.unionByName(chunked_running_sum(chunked, by, order, F.lit(1), out).drop(CHUNK))


def positions(df: DataFrame, order: Sequence[Column], out: str = "position") -> DataFrame:
    """The place of each row, from 1, in a total order over the whole frame. Ranges of the order are sorted side by side and written out;
    each starts from the rows of the ranges before it, a table of one row per range."""
    sorted_ranges = df.repartitionByRange(*order).sortWithinPartitions(*order)
    at = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))  # the lower bits number the rows of a partition
    written = stage(sorted_ranges.withColumns({CHUNK: F.spark_partition_id(), "_at": at}), "positions")
    sizes = written.groupBy(CHUNK).agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    earlier = Window.orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)  # over one row per range
    start = sizes.select(CHUNK, (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first") + 1).alias("_start"))
    return written.join(F.broadcast(start), CHUNK).withColumn(out, F.col("_at") + F.col("_start")).drop(CHUNK, "_at", "_start")
