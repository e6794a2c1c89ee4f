"""Diagnostics per batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.functions.text import seconds_between


def batch_report(result: DataFrame, succeeded: Column | None = None) -> DataFrame:
    """One row per ``(batch, batch_failrate)`` of a result or an attempt log.

    ``succeeded`` replaces the payload test on frames that carry no payload.
    """
    if succeeded is None:
        succeeded = F.col("payload").isNotNull()
    first, last = F.min("ts_end"), F.max("ts_end")
    return result.groupBy("batch", "batch_failrate").agg(
        first.alias("ts_start"),
        seconds_between(first, last).alias("total_duration"),
        F.avg("duration").alias("avg_duration"),
        F.max("duration").alias("max_duration"),
        F.min("duration").alias("min_duration"),
        F.max("retries").alias("retries"),
        F.count("*").alias("count"),
        F.count_if(succeeded).alias("count_ok"),
        F.count_if(F.col("retries") != 0).alias("count_retried"),
    )
