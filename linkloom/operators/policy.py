"""Settings of a batched fetch."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class AttemptSettings:
    """How one attempt over a batch behaves; times in seconds."""

    min_latency: float = 0.0
    timeout: float = 5.0
    tries: int = 1
    waitretry: float = 0.0
    parallel_jobs: int = 10
    delay: float = 0.0


@dataclass(frozen=True)
class FetchPolicy:
    """Batching, the first attempt, and retries.

    Failures are fetched again up to ``batch_retries`` times with ``retry``
    settings, in batches whose first attempt failed for a share of at most
    ``batch_retries_failrate``.
    """

    initial: AttemptSettings = field(default_factory=AttemptSettings)
    retry: AttemptSettings = field(default_factory=AttemptSettings)
    batch_size: int = 2000
    batch_retries: int = 1
    batch_retries_failrate: float = 0.05

    def __post_init__(self):
        if self.batch_size < 1:
            raise ValueError("batch_size must be at least 1")
