"""Fail rates, the retry gate, last attempts and durations of an attempt log.

An attempt log has ``url, payload, ts_start, ts_end, batch, retries``; a NULL
payload is a failure.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkloom.functions.text import seconds_between
from linkloom.operators.policy import FetchPolicy


def failed_share(failed: Column) -> Column:
    """Share of failures, as an aggregate."""
    return F.count_if(failed) / F.count("*")


def with_failrate(first: DataFrame, failed: Column | None = None) -> DataFrame:
    """Add ``batch_failrate`` to the rows of first attempts.

    Batches hold at most ``batch_size`` rows, so no window partition is large.
    """
    if failed is None:
        failed = F.col("payload").isNull()
    batch = Window.partitionBy("batch")
    share = F.count_if(failed).over(batch) / F.count("*").over(batch)
    return first.withColumn("batch_failrate", share)


def retry_candidates(attempt: DataFrame, policy: FetchPolicy, failed: Column | None = None) -> DataFrame:
    """Failures of one round that the policy lets through for another attempt.

    ``failed`` replaces the payload test on frames that carry no payload.
    """
    if failed is None:
        failed = F.col("payload").isNull()
    return attempt.where(
        failed
        & (F.col("retries") < policy.batch_retries)
        & (F.col("batch_failrate") <= policy.batch_retries_failrate)
    )


def last_attempts(log: DataFrame) -> DataFrame:
    """Rows with the greatest ``retries`` of their URL.

    The greatest number is found on two narrow columns, so payloads are shuffled
    once and never buffered in an aggregate.
    """
    last = log.groupBy("url").agg(F.max("retries").alias("retries"))
    return log.join(last, ["url", "retries"]).select(*log.columns)


def with_duration(log: DataFrame) -> DataFrame:
    """Add ``duration`` in seconds: end - start, or without a start the gap to
    the previous end in the batch."""
    in_batch = Window.partitionBy("batch").orderBy(F.col("ts_end").asc_nulls_last(), "url")
    gap = seconds_between(F.lag("ts_end").over(in_batch), F.col("ts_end"))
    return log.withColumn("duration", F.coalesce(seconds_between("ts_start", "ts_end"), gap))
