"""Text and time helpers with the NULL and empty-string rules of the data model."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.functions.urls import as_column


def literal_pattern(text: str) -> str:
    """A regular expression that matches ``text`` itself."""
    return re.sub(r"([^\w\s])", r"\\\1", text)


def string_to_array(col: Column | str, sep: str) -> Column:
    """Split on a literal separator; '' gives an empty array, NULL gives NULL."""
    text = as_column(col)
    return F.when(text == "", F.array().cast("array<string>")).otherwise(
        F.split(text, literal_pattern(sep), -1)
    )


def array_to_string(col: Column | str, sep: str) -> Column:
    """Join the non-NULL elements."""
    return F.array_join(as_column(col), sep)


def array_literal(col: Column | str) -> Column:
    """Read a ``{a,"b,c",NULL}`` array literal into an array of text.

    Malformed and nested literals raise (SQLSTATE 22P02); NULL gives NULL. A backslash
    escapes inside quotes only.
    """
    text = as_column(col)
    body = F.regexp_extract(text, r"(?s)^\s*\{(.*)\}\s*\z", 1)
    pattern = F.lit(r'(?s)\s*("[^"\\]*+(?:\\.[^"\\]*+)*+"|[^,"{}]++)\s*(?:,|\z)')
    items = F.regexp_extract_all(body, pattern, 1)

    def bare(item: Column) -> Column:
        return F.regexp_replace(item, r"^\s+|\s+\z", "")

    def value(item: Column) -> Column:
        plain = bare(item)
        quoted = F.regexp_replace(
            F.substring(plain, F.lit(2), F.length(plain) - 2), r"(?s)\\(.)", "$1"
        )
        return F.when(plain.startswith('"'), quoted).when(F.upper(plain) != "NULL", plain)

    # Items cover the body without gaps, and none is missing.
    whole = F.array_join(F.regexp_extract_all(body, pattern, 0), "") == body
    whole = whole & ~body.rlike(r",\s*\z") & ~F.exists(items, lambda item: bare(item) == "")
    empty = F.trim(F.regexp_replace(body, r"\s", "")) == ""
    good = text.rlike(r"(?s)^\s*\{.*\}\s*\z") & (empty | whole)
    raised = F.raise_error(F.concat(F.lit("22P02 malformed array literal: "), text))
    none = F.array().cast("array<string>")
    return F.when(good, F.when(empty, none).otherwise(F.transform(items, value))).when(
        text.isNotNull(), raised.cast("array<string>")
    )


def split_to_rows(
    df: DataFrame, col: str, pattern: str, item: str, position: str = "pos"
) -> DataFrame:
    """One output row per piece of ``col``, with its 0-based position."""
    return df.select("*", F.posexplode(F.split(col, pattern, -1)).alias(position, item))


def split_to_fields(col: Column | str, pattern: str, names: list[str]) -> list[Column]:
    """The first ``len(names)`` pieces as columns; a missing piece is NULL."""
    pieces = F.split(as_column(col), pattern, -1)
    return [F.get(pieces, i).alias(name) for i, name in enumerate(names)]


def nullif_empty(col: Column | str) -> Column:
    text = as_column(col)
    return F.when(text != "", text)


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """``end - start`` in seconds as a double, exact to the microsecond."""
    micros = F.timestamp_diff("MICROSECOND", as_column(start), as_column(end))
    return micros / F.lit(1e6)
