"""Distinct URLs, numbered into batches of equal size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Ranges are cut at the first four hex digits of the hash, so there are at most
# this many however many URLs there are: the offsets table below is of bounded
# size and safe to broadcast.
MOST_RANGES = 16**4
ROW_IN_PARTITION = (1 << 33) - 1  # low bits of monotonically_increasing_id


def distinct_urls(df: DataFrame, col: str = "url") -> DataFrame:
    """Each non-NULL URL once.  Combines on the map side, so a URL that fills a
    third of the input costs one row per task."""
    return df.select(F.col(col).alias("url")).where(F.col("url").isNotNull()).dropDuplicates()


def number_batches(
    urls: DataFrame, batch_size: int = 2000, counted: str | None = None
) -> DataFrame:
    """Add ``batch`` (1, 2, ...) to rows that are distinct in ``url``.

    Rows are ordered by ``(md5(url), url)``, which makes the numbering
    reproducible and spreads the URLs of one host over all batches.  A global
    ``row_number`` would sort everything in one task; here partition ``p`` holds
    the ``p``-th range of hashes, so a row's number is its place in its sorted
    partition plus the sizes of the partitions before.  (A window per range gives
    the same in twice the time: its sort must start with the range, which ties.)

    The frame is read twice, for the sizes and for the numbers.  Spark computes it
    once if both need the same columns: ``counted`` names a column, free of NULLs,
    that the rest of the query needs as well.
    """
    partitions = int(urls.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = min(partitions, MOST_RANGES)
    # Coalesced only to be non-nullable: on a nullable key the join would add a
    # filter that hashes every raw row and keeps the two scans from being shared.
    prefix = F.conv(F.substring(F.md5("url"), 1, 4), 16, 10).cast("int")
    part = F.floor(prefix * F.lit(ranges) / MOST_RANGES).cast("int")
    piece = F.coalesce(part, F.lit(0)).alias("__range")
    sizes = urls.groupBy(piece).agg(F.count(counted or "*").alias("__n"))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        F.col("__range"),
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"),
    )
    place = F.monotonically_increasing_id().bitwiseAND(F.lit(ROW_IN_PARTITION))
    return (
        urls.select("*", piece)
        .repartitionById(ranges, "__range")
        .withColumn("__hash", F.md5("url"))
        .sortWithinPartitions("__hash", "url")
        .withColumn("__place", place)
        .join(F.broadcast(offsets), "__range")
        .withColumn("batch", F.expr(f"(__place + __offset) div {int(batch_size)} + 1"))
        .select(*urls.columns, "batch")
    )


def batch_arrays(numbered: DataFrame) -> DataFrame:
    """One row per batch with its URLs as a sorted array of at most batch_size."""
    return numbered.groupBy("batch").agg(F.sort_array(F.collect_list("url")).alias("urls"))
