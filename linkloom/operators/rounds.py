"""The rounds of a batch inside one task: first attempts, fail rate, gate, retries.

A batch is a small state machine: requests of an attempt go out, failures are kept, and when
the last answer is in, the share of failures of the first attempt decides whether
they go out again.  Only URLs are kept; bodies leave as they come.  Without
pacing, requests of the next batch fill the pool while answers of this one are still out.
"""

from __future__ import annotations

import contextlib
import time
from collections import deque
from collections.abc import Iterator
from concurrent.futures import Future, ThreadPoolExecutor
from datetime import datetime
from queue import Empty, SimpleQueue
from typing import NamedTuple

from linkloom.operators.policy import AttemptSettings, FetchPolicy


class Attempt(NamedTuple):
    """One request and its answer.

    ``last`` is false when the URL is requested again.  ``failrate`` is that of the batch, on rows
    given when it is known; at least one row of every batch has it.
    """

    url: str
    payload: str | None
    start: datetime
    end: datetime
    batch: int
    retries: int
    last: bool
    failrate: float | None


class _Batch:
    def __init__(self, number: int):
        self.number, self.attempt = number, 0
        self.whole = False  # all requests of this attempt are out
        self.out = self.total = 0
        self.failed: list[tuple] = []
        self.failrate: float | None = None
        self.began = time.monotonic()


class Schedule(NamedTuple):
    """Limits that hold for all tasks of a job together; ``slot`` numbers the task, which else follows from its batches.

    Batch ``k`` starts ``(k - 1) * step`` seconds after ``began``, or after its task if that came later, at
    the earliest, and every task has its share of the requests in flight; the shares of
    all ``tasks`` add up to ``parallel_jobs``.
    """

    tasks: int
    began: float
    step: float
    slot: int | None = None

    @classmethod
    def of(cls, policy: FetchPolicy, tasks: int) -> Schedule:
        jobs = min(max(1, s.parallel_jobs) for s in (policy.initial, policy.retry))
        step = policy.initial.delay + policy.initial.min_latency
        return cls(max(1, min(tasks, jobs)), time.time(), step)

    def share(self, jobs: int, batch: int) -> int:
        """Requests in flight for the task that ``batch`` is in."""
        jobs, slot = max(1, jobs), (batch - 1) % self.tasks if self.slot is None else self.slot
        return jobs // self.tasks + (slot < jobs % self.tasks)

    def wait(self, batch: int, task_began: float) -> float:
        return max(self.began, task_began) + (batch - 1) * self.step - time.time()


class BatchRounds:
    """Runs batches, one after the other when they are paced.  Use as a context.

    ``ask`` takes the URLs of a batch in a row, with ``ends`` on its last one.
    """

    def __init__(self, request, policy: FetchPolicy, schedule: Schedule | None = None):
        self._request, self._policy, self._schedule = request, policy, schedule
        settings = (policy.initial, policy.retry)
        self._paced = schedule is not None or any(s.delay > 0 or s.min_latency > 0 for s in settings)
        self._jobs = [max(1, s.parallel_jobs) for s in settings]
        self._pool = ThreadPoolExecutor(max(self._jobs))
        self._out = [0, 0]  # first attempts and retries in flight
        self._answers: SimpleQueue[Future] = SimpleQueue()
        self._asked: dict[Future, tuple[_Batch, str]] = {}
        self._again: deque[tuple[_Batch, str]] = deque()
        self._new: deque[tuple[int, str, bool]] = deque()
        self._open: _Batch | None = None  # gets new URLs
        self._under_way = 0
        self._began = time.time()
        self._due = 0.0
        self._free = time.monotonic()  # when the batch before has ended

    def __enter__(self) -> BatchRounds:
        return self

    def __exit__(self, *_) -> None:
        self._pool.shutdown(wait=True, cancel_futures=True)

    def ask(self, batch: int, url: str, ends: bool) -> Iterator[Attempt]:
        """Have one more URL requested; gives the attempts that ended meanwhile."""
        self._new.append((batch, url, ends))
        while self._new:
            yield from self._step()

    def finish(self) -> Iterator[Attempt]:
        while self._under_way:
            yield from self._step(True)
        time.sleep(max(0.0, self._free - time.monotonic()))

    def _settings(self, attempt: int) -> AttemptSettings:
        return self._policy.retry if attempt else self._policy.initial

    def _step(self, finishing: bool = False) -> Iterator[Attempt]:
        self._send()
        held = finishing or bool(self._new)
        if held and not self._asked:
            time.sleep(max(0.0, self._due - time.monotonic()))
            return
        with contextlib.suppress(Empty):
            yield from self._answered(self._answers.get(block=held))
            while True:
                yield from self._answered(self._answers.get(block=False))

    def _send(self) -> None:
        if self._paced and time.monotonic() < self._due:
            return
        while self._again and self._out[1] < self._jobs[1]:
            self._submit(*self._again.popleft())
        while self._new and self._out[0] < self._jobs[0]:
            number, url, ends = self._new[0]
            if self._open is None:
                if self._paced and not self._may_begin(number):
                    return
                self._open = _Batch(number)
                self._under_way += 1
            self._new.popleft()
            batch = self._open
            batch.total += 1
            batch.out += 1
            if ends:
                batch.whole, self._open = True, None
            self._submit(batch, url)

    def _may_begin(self, number: int) -> bool:
        """Paced batches wait for the one before, their delay and their place in the schedule."""
        if self._under_way:
            return False
        if self._schedule is None:
            self._due = self._free + (self._policy.initial.delay if number != 1 else 0.0)
        else:
            settings = (self._policy.initial, self._policy.retry)
            self._jobs = [self._schedule.share(s.parallel_jobs, number) for s in settings]
            self._due = max(self._free, time.monotonic() + self._schedule.wait(number, self._began))
        return time.monotonic() >= self._due

    def _submit(self, batch: _Batch, url: str) -> None:
        self._out[batch.attempt > 0] += 1
        future = self._pool.submit(self._request, url, batch.attempt, self._settings(batch.attempt))
        self._asked[future] = batch, url
        future.add_done_callback(self._answers.put)

    def _answered(self, future: Future) -> Iterator[Attempt]:
        batch, url = self._asked.pop(future)
        payload, start, end = future.result()
        self._out[batch.attempt > 0] -= 1
        batch.out -= 1
        if payload is None:
            batch.failed.append((url, start, end))
        ended = batch.whole and not batch.out
        if ended and batch.attempt == 0:
            batch.failrate = len(batch.failed) / batch.total
        if payload is not None:
            yield Attempt(url, payload, start, end, batch.number, batch.attempt, True, batch.failrate)
        if ended:
            yield from self._ended(batch)

    def _ended(self, batch: _Batch) -> Iterator[Attempt]:
        failed, attempt = batch.failed, batch.attempt
        again = (
            bool(failed)
            and attempt < self._policy.batch_retries
            and batch.failrate <= self._policy.batch_retries_failrate
        )
        floor = max(time.monotonic(), batch.began + self._settings(attempt).min_latency)
        if again:
            self._due = batch.began = floor + self._policy.retry.delay
            batch.attempt, batch.failed, batch.out = attempt + 1, [], len(failed)
            self._again.extend((batch, url) for url, _, _ in failed)
        else:
            self._under_way -= 1
            self._free = floor
        for url, start, end in failed:
            yield Attempt(url, None, start, end, batch.number, attempt, not again, batch.failrate)
