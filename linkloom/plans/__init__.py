from linkloom.plans.fetch_batches import fetch_batches, live_attempts, requested_urls
from linkloom.plans.replay import replay, replay_attempts, replay_outcomes
from linkloom.plans.sql_surface import register_sql

__all__ = [
    "fetch_batches",
    "live_attempts",
    "register_sql",
    "replay",
    "replay_attempts",
    "replay_outcomes",
    "requested_urls",
]
