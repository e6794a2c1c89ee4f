"""Validate, batch and fetch large tables of URLs on Spark, and read what comes back."""

from linkloom.functions import (
    is_url,
    is_url_array,
    is_url_shlist,
    json_fields,
    reject_reason,
)
from linkloom.operators import (
    AttemptSettings,
    FetchPolicy,
    batch_report,
    enforce_url,
    fetch,
    number_batches,
)
from linkloom.plans import fetch_batches, register_sql
from linkloom.sources import HttpTransport, Snapshot, save_table

__all__ = [
    "AttemptSettings",
    "FetchPolicy",
    "HttpTransport",
    "Snapshot",
    "batch_report",
    "enforce_url",
    "fetch",
    "fetch_batches",
    "is_url",
    "is_url_array",
    "is_url_shlist",
    "json_fields",
    "number_batches",
    "register_sql",
    "reject_reason",
    "save_table",
]
