from linkloom.functions.json_payload import json_fields, json_text, parse_payload
from linkloom.functions.text import (
    array_literal,
    array_to_string,
    nullif_empty,
    seconds_between,
    split_to_fields,
    split_to_rows,
    string_to_array,
)
from linkloom.functions.urls import is_url, is_url_array, is_url_shlist, reject_reason

__all__ = [
    "array_literal",
    "array_to_string",
    "is_url",
    "is_url_array",
    "is_url_shlist",
    "json_fields",
    "json_text",
    "nullif_empty",
    "parse_payload",
    "reject_reason",
    "seconds_between",
    "split_to_fields",
    "split_to_rows",
    "string_to_array",
]
