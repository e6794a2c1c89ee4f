"""The live fetch stage: requests run in threads inside Spark tasks.

A transport is a picklable callable ``(url, attempt, settings) -> bytes | str |
None``.  None and empty answers are failures; an exception is a defect and fails
the task.

A request is a side effect.  The stage is run once per round and its output is
written at once (see ``plans.rounds``); a task that Spark repeats after a loss
repeats its own requests, and only one copy of its output is committed.  Keep
``spark.speculation`` off while fetching.
"""

from __future__ import annotations

import itertools
import time
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkloom.functions.urls import is_url_text
from linkloom.operators.enforce import CHECK_VIOLATION
from linkloom.operators.policy import AttemptSettings, FetchPolicy
from linkloom.operators.rounds import BatchRounds, Schedule

Transport = Callable[[str, int, AttemptSettings], "bytes | str | None"]

ATTEMPT_SCHEMA = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("payload", T.StringType()),
        T.StructField("ok", T.BooleanType()),
        T.StructField("ts_start", T.TimestampType()),
        T.StructField("ts_end", T.TimestampType()),
        T.StructField("batch", T.LongType()),
        T.StructField("retries", T.IntegerType()),
    ]
)
# An attempt of a job that runs all rounds; ``batch_failrate`` is on some rows of each batch.
LOG_SCHEMA = T.StructType(
    [
        *ATTEMPT_SCHEMA.fields,
        T.StructField("last", T.BooleanType()),
        T.StructField("batch_failrate", T.DoubleType()),
    ]
)
_TIME = pa.timestamp("us", tz="UTC")
_FETCHED = [pa.field("payload", pa.string()), pa.field("ts_start", _TIME), pa.field("ts_end", _TIME)]
_ANSWER = pa.schema([pa.field("row", pa.int64()), *_FETCHED])
_ATTEMPT_ARROW = pa.schema(
    [
        ("url", pa.string()),
        ("payload", pa.string()),
        ("ok", pa.bool_()),
        ("ts_start", _TIME),
        ("ts_end", _TIME),
        ("batch", pa.int64()),
        ("retries", pa.int32()),
    ]
)
_LOG_ARROW = pa.schema([*_ATTEMPT_ARROW, ("last", pa.bool_()), ("batch_failrate", pa.float64())])

# Answers are handed on in pieces of this size, so a task never holds the bodies
# of a whole batch.
PIECE_ROWS = 256
PIECE_BYTES = 16 << 20


def _text(body: bytes | str | None) -> str | None:
    if isinstance(body, bytes):
        body = body.decode("utf-8", errors="replace")
    return body or None


def requester(transport: Transport) -> Callable:
    """``(url, attempt, settings)`` to payload, start and end."""
    return lambda url, attempt, settings: _timed(transport, url, attempt, settings)


def _timed(transport: Transport, url: str, attempt: int, settings: AttemptSettings):
    start = datetime.now(timezone.utc)
    payload = _text(transport(url, attempt, settings))
    return payload, start, datetime.now(timezone.utc)


def fetch_concurrently(
    requests: Iterable[tuple[int | None, str]],
    transport: Transport,
    attempt: int,
    settings: AttemptSettings,
    pool: ThreadPoolExecutor,
) -> Iterator[tuple]:
    """Fetch ``(batch, url)`` pairs with at most ``parallel_jobs`` in flight.

    Gives ``(batch, url, payload, ts_start, ts_end)`` in order of completion and
    ends after ``min_latency`` at the earliest.
    """
    floor = time.monotonic() + settings.min_latency
    waiting, in_flight = iter(requests), {}
    while True:
        room = max(1, settings.parallel_jobs) - len(in_flight)
        for batch, url in itertools.islice(waiting, room):
            in_flight[pool.submit(_timed, transport, url, attempt, settings)] = batch, url
        if not in_flight:
            break
        done, _ = wait(in_flight, return_when=FIRST_COMPLETED)
        for future in done:
            yield (*in_flight.pop(future), *future.result())
    time.sleep(max(0.0, floor - time.monotonic()))


def _pieces(rows: Iterable[tuple], columns: list[str], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    def piece(held: list[tuple]) -> pa.RecordBatch:
        arrays = [
            pa.array(values, type=field.type)
            for values, field in zip(zip(*held), schema, strict=True)
        ]
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    payload_at = columns.index("payload")
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[payload_at] or "")
        if len(held) >= PIECE_ROWS or size >= PIECE_BYTES:
            yield piece(held)
            held, size = [], 0
    if held:
        yield piece(held)


def fetch_round(
    requests: DataFrame,
    transport: Transport,
    settings: AttemptSettings,
    attempt: int,
    tasks: int | None = None,
) -> DataFrame:
    """Fetch ``(url, batch)`` rows once each; a lazy frame of ``ATTEMPT_SCHEMA``.

    Batches are dealt out to ``tasks`` partitions in turn, which keeps them even;
    hashing few batch numbers would not.  A task works through its batches in
    ascending order and sleeps ``delay`` before each, batch 1 of the first
    attempt excepted, as a sequential loop would.
    """
    tasks = tasks or requests.sparkSession.sparkContext.defaultParallelism
    schema = _ATTEMPT_ARROW

    def answers(requested: Iterator[pa.RecordBatch], pool: ThreadPoolExecutor) -> Iterator[tuple]:
        pairs = itertools.chain.from_iterable(
            zip(part["batch"].to_pylist(), part["url"].to_pylist()) for part in requested
        )
        paced = settings.delay > 0 or settings.min_latency > 0
        # Without pacing one batch need not end before the next begins.
        groups = itertools.groupby(pairs, key=lambda pair: pair[0] if paced else None)
        for number, group in groups:
            if paced and (attempt > 0 or number != 1):
                time.sleep(settings.delay)
            for batch, url, payload, start, end in fetch_concurrently(
                group, transport, attempt, settings, pool
            ):
                yield url, payload, payload is not None, start, end, batch, attempt

    def run(requested: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with ThreadPoolExecutor(max(1, settings.parallel_jobs)) as pool:
            yield from _pieces(answers(requested, pool), schema.names, schema)

    return _dealt(requests, tasks).mapInArrow(run, ATTEMPT_SCHEMA)


def _dealt(requests: DataFrame, tasks: int) -> DataFrame:
    return (
        requests.select("batch", "url")
        .repartitionById(tasks, F.pmod(F.col("batch") - 1, F.lit(tasks)).cast("int"))
        .sortWithinPartitions("batch", "url")
    )


def fetch_rounds(
    requests: DataFrame, transport: Transport, policy: FetchPolicy, tasks: int, whole_job: bool = False
) -> DataFrame:
    """Fetch ``(url, batch)`` rows with all their retries; a lazy frame of ``LOG_SCHEMA``.

    One job: a batch is in one task, which knows its fail rate when the first answers are in and
    goes on with its retries.  With ``whole_job`` the limits of the policy hold for all tasks together.
    """
    schedule = Schedule.of(policy, tasks) if whole_job else None
    tasks = schedule.tasks if schedule else tasks

    def rows(requested: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        pairs = itertools.chain.from_iterable(
            zip(part["batch"].to_pylist(), part["url"].to_pylist()) for part in requested
        )
        with BatchRounds(requester(transport), policy, schedule) as rounds:
            now = next(pairs, None)
            while now:
                after = next(pairs, None)
                yield from rounds.ask(*now, after is None or after[0] != now[0])
                now = after
            yield from rounds.finish()

    def run(requested: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        log = (
            (a.url, a.payload, a.payload is not None, a.start, a.end, a.batch, a.retries, a.last, a.failrate)
            for a in rows(requested)
        )
        yield from _pieces(log, _LOG_ARROW.names, _LOG_ARROW)

    return _dealt(requests, tasks).mapInArrow(run, LOG_SCHEMA)


def fetch(
    df: DataFrame,
    url: str,
    transport: Transport,
    settings: AttemptSettings = AttemptSettings(),
    *,
    on_invalid: str = "fail",
    tasks: int | None = None,
) -> DataFrame:
    """Fetch the URL of every row: adds ``payload, ts_start, ts_end``.

    Each request by itself takes ``min_latency`` at least.  Rows are dealt out evenly to
    ``tasks`` tasks, by default one a core, as requests take far longer than rows; they leave in order
    of completion, in pieces of at most 16 MB of bodies or one row.
    A value that is no URL fails the job, or with ``on_invalid="skip"`` is not requested;
    neither is NULL.  The frame is lazy and requests are made again whenever it is
    computed again: write it before use.
    """
    if on_invalid not in ("fail", "skip"):
        raise ValueError(f"on_invalid is 'fail' or 'skip', not {on_invalid!r}")
    df = df.repartition(tasks or df.sparkSession.sparkContext.defaultParallelism)
    added = T.StructType(
        [
            T.StructField("payload", T.StringType()),
            T.StructField("ts_start", T.TimestampType()),
            T.StructField("ts_end", T.TimestampType()),
        ]
    )

    def one(value: str) -> tuple:
        floor = time.monotonic() + settings.min_latency
        answer = _timed(transport, value, 0, settings)
        time.sleep(max(0.0, floor - time.monotonic()))
        return answer

    def answers(part: pa.RecordBatch, pool: ThreadPoolExecutor) -> Iterator[tuple]:
        """Row number and answer, in order of completion."""
        at = part.schema.get_field_index(url)
        waiting, in_flight = enumerate(part.column(at).to_pylist()), {}
        while True:
            for row, value in itertools.islice(waiting, max(1, settings.parallel_jobs) - len(in_flight)):
                if value is not None and is_url_text(value):
                    in_flight[pool.submit(one, value)] = row
                elif value is None or on_invalid == "skip":
                    yield row, None, None, None
                else:
                    raise ValueError(f"{CHECK_VIOLATION} url: not a URL: {value[:200]!r}")
            if not in_flight:
                if (last := next(waiting, None)) is None:
                    return
                waiting = itertools.chain([last], waiting)
                continue
            done, _ = wait(in_flight, return_when=FIRST_COMPLETED)
            for future in done:
                yield (in_flight.pop(future), *future.result())

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with ThreadPoolExecutor(max(1, settings.parallel_jobs)) as pool:
            for part in parts:
                for piece in _pieces(answers(part, pool), _ANSWER.names, _ANSWER):
                    rows = part.take(piece.column("row"))
                    yield pa.RecordBatch.from_arrays(
                        [*rows.columns, *piece.columns[1:]], schema=pa.schema([*part.schema, *_FETCHED])
                    )

    return df.mapInArrow(run, T.StructType(df.schema.fields + added.fields))
