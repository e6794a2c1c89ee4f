from linkloom.operators.attempts import (
    last_attempts,
    retry_candidates,
    with_duration,
    with_failrate,
)
from linkloom.operators.batching import batch_arrays, distinct_urls, number_batches
from linkloom.operators.enforce import (
    all_urls,
    enforce_url,
    enforce_url_array,
    enforce_url_shlist,
    reject_counts,
)
from linkloom.operators.fetch import fetch, fetch_round
from linkloom.operators.frames import frame_files, frame_record, frames
from linkloom.operators.policy import AttemptSettings, FetchPolicy
from linkloom.operators.report import batch_report

__all__ = [
    "AttemptSettings",
    "FetchPolicy",
    "all_urls",
    "batch_arrays",
    "batch_report",
    "distinct_urls",
    "enforce_url",
    "enforce_url_array",
    "enforce_url_shlist",
    "fetch",
    "fetch_round",
    "frame_files",
    "frame_record",
    "frames",
    "last_attempts",
    "number_batches",
    "reject_counts",
    "retry_candidates",
    "with_duration",
    "with_failrate",
]
