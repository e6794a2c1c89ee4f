"""Answers taken from a stored table instead of the network."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.functions.text import nullif_empty


@dataclass(frozen=True)
class Snapshot:
    """A ``url -> payload`` table, optionally with the times of the request.

    ``attempt`` names a column with the number of the attempt (0, 1, ...) that a row answers, as a log
    of attempts has it; without it a row answers every attempt.  An attempt that no row
    answers has failed.  Empty and NULL payloads are failures and keep their times.

    Several rows of one URL (and attempt) count as one answer: one with a payload wins, then the latest
    end, the latest start and the greatest payload.  ``unique=True`` states that they do
    not repeat; the statement is checked, and saves aggregating the payloads.
    ``filled`` names a boolean column that tells whether the payload is there and
    not empty; with it the payloads are read once, for the result, and not before.
    """

    table: DataFrame
    url: str = "url"
    payload: str = "payload"
    ts_start: str | None = None
    ts_end: str | None = None
    attempt: str | None = None
    unique: bool = False
    filled: str | None = None

    def _time(self, name: str | None) -> Column:
        return (F.col(name) if name else F.lit(None)).cast("timestamp")

    def flags(self, attempt: int) -> DataFrame:
        """``url, ok, ts_start, ts_end`` of every row that answers the attempt; no bodies."""
        filled = F.col(self.filled) if self.filled else F.col(self.payload) != ""
        rows = self.table.where(F.col(self.url).isNotNull())
        if self.attempt:
            rows = rows.where(F.col(self.attempt) == attempt)
        return rows.select(
            F.col(self.url).alias("url"),
            F.coalesce(filled, F.lit(False)).alias("ok"),
            self._time(self.ts_start).alias("ts_start"),
            self._time(self.ts_end).alias("ts_end"),
            F.lit(1).alias("copies"),
        )

    def combined(self, flags: DataFrame, *more: Column) -> DataFrame:
        """One row per URL of rows of ``flags``; those without ``copies`` are no answers."""
        if self.ts_start or self.ts_end:
            best = F.max(F.struct("ok", "ts_end", "ts_start")).alias("best")
            parts = ("best.ok", "best.ts_start", "best.ts_end")
        else:  # a boolean is combined in place
            best, none = F.max("ok").alias("ok"), F.lit(None).cast("timestamp")
            parts = ("ok", none.alias("ts_start"), none.alias("ts_end"))
        found = flags.groupBy("url").agg(best, F.sum("copies").alias("copies"), *more)
        if self.unique:
            repeated = F.raise_error(F.concat(F.lit("snapshot repeats "), F.col("url")))
            once = F.when(F.col("copies") > 1, repeated.cast("boolean")).otherwise(True)
            found = found.where(once)
        kept = [c for c in found.columns if c not in ("url", "best", "ok", "copies")]
        return found.select("url", *parts, *kept).withColumn("ok", F.coalesce("ok", F.lit(False)))

    def bodies(self) -> DataFrame:
        """``url, payload`` of the URLs that have one, with ``attempt`` where the table has it."""
        key = ["url", "attempt"] if self.attempt else ["url"]
        rows = self.table.select(
            F.col(self.url).alias("url"),
            *([F.col(self.attempt).alias("attempt")] if self.attempt else []),
            nullif_empty(self.payload).alias("payload"),
            self._time(self.ts_start).alias("ts_start"),
            self._time(self.ts_end).alias("ts_end"),
        ).where(F.col("url").isNotNull() & F.col("payload").isNotNull())
        if self.unique:
            return rows.select(*key, "payload")
        best = F.max(F.struct("ts_end", "ts_start", "payload")).alias("best")
        return rows.groupBy(*key).agg(best).select(*key, "best.payload")
