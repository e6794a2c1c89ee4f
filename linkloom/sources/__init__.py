from linkloom.sources.http import HttpTransport
from linkloom.sources.snapshot import Snapshot
from linkloom.sources.tables import RunStore, load_table, save_table, shared_folder
from linkloom.sources.urls import unnest_urls, url_list, url_range, url_template

__all__ = [
    "HttpTransport",
    "RunStore",
    "Snapshot",
    "load_table",
    "save_table",
    "shared_folder",
    "unnest_urls",
    "url_list",
    "url_range",
    "url_template",
]
