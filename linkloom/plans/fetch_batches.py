"""Validate, deduplicate, batch, fetch, retry: the whole job."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.operators.batching import distinct_urls, number_batches
from linkloom.operators.enforce import enforce_url
from linkloom.operators.fetch import Transport
from linkloom.operators.policy import FetchPolicy
from linkloom.plans.replay import replay
from linkloom.plans.rounds import result_of, run_job, run_rounds, stored_attempts
from linkloom.sources.snapshot import Snapshot
from linkloom.sources.tables import RunStore

# Small tasks lose little when an executor goes; the upper bound keeps the
# shuffle that deals out the batches manageable.
BATCHES_PER_TASK = 16
MOST_TASKS = 50_000


def requested_urls(df: DataFrame, url: str = "url", on_invalid: str = "fail") -> DataFrame:
    """The non-NULL URLs of a frame; a bad one fails the job or is dropped."""
    if on_invalid not in ("fail", "drop"):
        raise ValueError(f"on_invalid is 'fail' or 'drop', not {on_invalid!r}")
    present = df.select(F.col(url).alias("url")).where(F.col("url").isNotNull())
    return enforce_url(present, "url", on_invalid)


def fetch_batches(
    df: DataFrame,
    transport: Snapshot | Transport,
    policy: FetchPolicy = FetchPolicy(),
    *,
    url: str = "url",
    on_invalid: str = "fail",
    ordered: bool = False,
    sequential: bool = False,
    whole_job: bool = False,
    tasks: int | None = None,
    run_id: str | None = None,
) -> DataFrame:
    """``url, payload, ts_end, duration, batch, retries, batch_failrate`` with one
    row per distinct URL of ``df``.

    From a ``Snapshot`` the result is a lazy plan.  With a live transport the
    requests are made now (see ``live_attempts``) and the result reads the stored
    attempts.  ``ordered`` sorts by batch and URL.
    """
    wanted = requested_urls(df, url, on_invalid)
    if isinstance(transport, Snapshot):
        result = replay(wanted, transport, policy)
    else:
        result = result_of(live_attempts(wanted, transport, policy, sequential, tasks, run_id, whole_job))
    return result.orderBy("batch", "url") if ordered else result


def live_attempts(
    wanted: DataFrame,
    transport: Transport,
    policy: FetchPolicy,
    sequential: bool = False,
    tasks: int | None = None,
    run_id: str | None = None,
    whole_job: bool = False,
) -> DataFrame:
    """Fetch the distinct URLs of ``wanted``; every attempt made, as stored.

    Batches run in parallel over ``tasks`` tasks.  A task takes its batches through all their rounds,
    so a run is one job.  The limits of the policy hold per task, or with ``whole_job``
    for all tasks together: at most ``parallel_jobs`` requests in flight, and batch ``k``
    starts ``(k - 1) * (delay + min_latency)`` seconds after the first at the earliest.
    ``sequential`` runs one batch, with its retries, after the other in a single task.

    ``run_id`` names a run that can be resumed: it writes a table a round, and rounds finished under
    the same name are not fetched again; sequential and whole-job runs are resumed as a whole.
    Other URLs, another policy or another way to run under the same name raise.
    """
    spark = wanted.sparkSession
    if spark.conf.get("spark.speculation", "false") == "true":
        warnings.warn("spark.speculation repeats requests; switch it off", stacklevel=2)
    if sequential and (whole_job or tasks not in (None, 1)):
        raise ValueError("a sequential run has one task and needs no other limit")
    store = RunStore(spark, run_id)
    numbered = number_batches(distinct_urls(wanted), policy.batch_size)
    # Before the input is numbered once more: a run about something else must not start.
    if run_id is not None:
        store.guard("policy", repr(policy))
        store.guard("mode", "sequential" if sequential else "whole job" if whole_job else "rounds")
    requests = store.write("requests", numbered)
    total = F.sum(F.xxhash64("url").cast("decimal(38,0)"))
    if run_id is not None:
        n, digest = distinct_urls(wanted).agg(F.count("*"), total).first()
        noted = requests.agg(F.count("*"), total).first()
        if noted != (n, digest):
            raise ValueError(f"{store.root} is a run with another input: {noted[0]} URLs, not {n}")
    batches = requests.agg(F.max("batch")).first()[0] or 0
    if sequential:
        run_job(requests, transport, policy, store, 1)
        return stored_attempts(store, policy)
    cores = spark.sparkContext.defaultParallelism
    tasks = tasks or min(MOST_TASKS, max(cores, -(-batches // BATCHES_PER_TASK)))
    if run_id is not None and not whole_job:
        run_rounds(requests, transport, policy, store, tasks)
    else:
        run_job(requests, transport, policy, store, max(1, min(tasks, batches)), whole_job)
    return stored_attempts(store, policy)
