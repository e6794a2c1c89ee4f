"""Batched fetch over a live transport: one stored attempt table per round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkloom.functions.text import seconds_between
from linkloom.operators.attempts import failed_share
from linkloom.operators.fetch import ATTEMPT_SCHEMA, LOG_SCHEMA, Transport, fetch_round, fetch_rounds
from linkloom.operators.policy import FetchPolicy
from linkloom.sources.tables import RunStore

RATE_SCHEMA = T.StructType(
    [T.StructField("batch", T.LongType()), T.StructField("batch_failrate", T.DoubleType())]
)


def run_job(
    requests: DataFrame,
    transport: Transport,
    policy: FetchPolicy,
    store: RunStore,
    tasks: int,
    whole_job: bool = False,
) -> None:
    """Fetch ``(url, batch)`` requests and their retries into the store, in one job."""
    log = store.write("log", fetch_rounds(requests, transport, policy, tasks, whole_job))
    rates = log.where(F.col("batch_failrate").isNotNull()).groupBy("batch")
    store.write("failrates", rates.agg(F.max("batch_failrate").alias("batch_failrate")))


def run_rounds(
    requests: DataFrame,
    transport: Transport,
    policy: FetchPolicy,
    store: RunStore,
    tasks: int,
) -> None:
    """Fetch ``(url, batch)`` requests, then their retries, into the store: a job a round.

    For runs that are resumed under their name.  Every round is written before it is read, so requests are not repeated when
    the result is used twice, and a lost executor costs its own tasks only.
    """
    log = store.write(
        "attempts/0", fetch_round(requests, transport, policy.initial, 0, tasks)
    )
    rates = store.write(
        "failrates",
        log.groupBy("batch").agg(failed_share(~F.col("ok")).alias("batch_failrate")),
    )
    allowed = rates.where(F.col("batch_failrate") <= policy.batch_retries_failrate)
    for number in range(1, policy.batch_retries + 1):
        pending = log.where(~F.col("ok")).select("url", "batch")
        if number == 1:  # later rounds hold URLs of allowed batches only
            pending = pending.join(allowed, "batch", "left_semi")
        if pending.isEmpty():
            return
        log = store.write(
            f"attempts/{number}",
            fetch_round(pending, transport, policy.retry, number, tasks),
        )


def stored_attempts(store: RunStore, policy: FetchPolicy) -> DataFrame:
    """All attempts of a run with ``batch_failrate`` and a flag ``last``.

    An attempt is the last one of its URL when it succeeded, when its batch is
    barred from retries or when retries are used up: a test on the row, so
    payloads are neither shuffled nor sorted to find it.
    """
    rates = store.read_all("failrates", RATE_SCHEMA)
    if store.finished("log"):
        return store.read_all("log", LOG_SCHEMA).drop("batch_failrate").join(rates, "batch")
    last = (
        F.col("ok")
        | (F.col("batch_failrate") > policy.batch_retries_failrate)
        | (F.col("retries") >= policy.batch_retries)
    )
    return store.read_all("attempts", ATTEMPT_SCHEMA).join(rates, "batch").withColumn("last", last)


def result_of(attempts: DataFrame) -> DataFrame:
    """The result relation: last attempts only.

    Live attempts always have both times, so ``duration`` needs no neighbours.
    """
    return attempts.where("last").select(
        "url",
        "payload",
        "ts_end",
        seconds_between("ts_start", "ts_end").alias("duration"),
        "batch",
        "retries",
        "batch_failrate",
    )
