"""Batched fetch from recorded answers.

The rounds are those of a live run: batches are numbered, the first answers rated, and what the gate
lets through looks up its next answer.  They carry URLs, times and flags only, and every
round is stored; bodies join once at the end, and not at all for reports that do not
show them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.operators.attempts import last_attempts, retry_candidates, with_duration, with_failrate
from linkloom.operators.batching import number_batches
from linkloom.operators.policy import FetchPolicy
from linkloom.sources.snapshot import Snapshot
from linkloom.sources.tables import RunStore

LOG = ("url", "batch", "batch_failrate", "retries", "ok", "ts_start", "ts_end")


def first_answers(urls: DataFrame, snapshot: Snapshot) -> DataFrame:
    """``url, ok, ts_start, ts_end`` for each distinct URL of ``urls``.

    Requests and answers are grouped together instead of joined: one shuffle of
    partly combined rows, however often a URL occurs on either side.
    """
    asked = urls.where(F.col("url").isNotNull()).select("url", F.lit(True).alias("asked"))
    known = snapshot.flags(0).withColumn("asked", F.lit(False))
    rows = asked.unionByName(known, allowMissingColumns=True)
    return snapshot.combined(rows, F.max("asked").alias("asked")).where("asked").drop("asked")


def replay_log(urls: DataFrame, snapshot: Snapshot, policy: FetchPolicy) -> DataFrame:
    """Every attempt, with times and flags but without its body."""
    store = RunStore(urls.sparkSession)
    numbered = number_batches(first_answers(urls, snapshot), policy.batch_size, "ok")
    rated = with_failrate(numbered, ~F.col("ok")).withColumn("retries", F.lit(0)).select(*LOG)
    if policy.batch_retries < 1:
        return rated
    rounds = [store.write("replayed/0", rated)]
    for number in range(1, policy.batch_retries + 1):
        pending = retry_candidates(rounds[-1], policy, ~F.col("ok"))
        if pending.isEmpty():
            break
        answers = snapshot.combined(snapshot.flags(number))
        again = pending.select("url", "batch", "batch_failrate").join(answers, "url", "left")
        again = again.withColumns({"ok": F.coalesce("ok", F.lit(False)), "retries": F.lit(number)})
        rounds.append(store.write(f"replayed/{number}", again.select(*LOG)))
    return reduce(DataFrame.unionByName, rounds)


def replay_attempts(urls: DataFrame, snapshot: Snapshot, policy: FetchPolicy) -> DataFrame:
    """``url, batch, batch_failrate, retries, ok`` of every attempt."""
    return replay_log(urls, snapshot, policy).drop("ts_start", "ts_end")


def replay_outcomes(urls: DataFrame, snapshot: Snapshot, policy: FetchPolicy) -> DataFrame:
    """``url, batch, batch_failrate, retries, ok`` of the last attempt per URL."""
    return last_attempts(replay_attempts(urls, snapshot, policy))


def replay(urls: DataFrame, snapshot: Snapshot, policy: FetchPolicy) -> DataFrame:
    """The result relation: one row per distinct URL.

    Failed attempts keep their times.  The gap to the end before, for attempts without a start, is
    taken within the batch over all attempts.
    """
    last = last_attempts(with_duration(replay_log(urls, snapshot, policy))).alias("o")
    bodies = snapshot.bodies().alias("b")
    same = (F.col("o.url") == F.col("b.url")) & F.col("o.ok")
    if snapshot.attempt:
        same = same & (F.col("o.retries") == F.col("b.attempt"))
    return last.join(bodies, same, "left").select(
        "o.url", "b.payload", "o.ts_end", "o.duration", "o.batch", "o.retries", "o.batch_failrate"
    )
