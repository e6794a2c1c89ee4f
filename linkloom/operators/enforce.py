"""Constrained columns: fail the job, split the rows, or flag them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.functions.urls import (
    authority_parts,
    clause_of,
    is_url,
    is_url_array,
    is_url_shlist,
)

# --- fixed values: SQLSTATE of the two ways a value can break a constraint -----
NOT_NULL_VIOLATION = "23502"
CHECK_VIOLATION = "23514"
# ------------------------------------------------------------------------------


def _fail(df: DataFrame, col: str, check: Column, label: str) -> DataFrame:
    # The test is a filter, not a projected column: Spark prunes an unused
    # column, and with it the error, but never a filter.  It must not look
    # deterministic either, or a later join on the column copies the filter to
    # its other side and raises for values that were never in ``df``.
    def error(state: str, text: str) -> Column:
        return F.raise_error(F.lit(f"{state} {label}: {text}")).cast("boolean")

    return df.where(
        F.when(F.col(col).isNull(), error(NOT_NULL_VIOLATION, f"{col} is NULL"))
        .when(~check, error(CHECK_VIOLATION, f"{col} breaks the check"))
        .otherwise(F.spark_partition_id() >= 0)
    )


def _enforce(df: DataFrame, col: str, check: Column, label: str, mode: str):
    # An undecided check passes, as a constraint does in SQL; a NULL value does not.
    passes = F.col(col).isNotNull() & F.coalesce(check, F.lit(True))
    if mode == "fail":
        return _fail(df, col, check, label)
    if mode == "drop":
        return df.where(passes)
    if mode == "quarantine":
        return df.where(passes), df.where(~passes)
    if mode == "flag":
        return df.withColumn("valid", passes)
    raise ValueError(f"unknown mode {mode!r}")


def enforce_url(df: DataFrame, col: str = "url", mode: str = "fail", strict: bool = False):
    """``fail``: error on the first bad value.  ``drop``: keep good rows.
    ``quarantine``: (good, bad), two frames that each read the source.  ``flag``:
    add a boolean ``valid``, to write both kinds in one pass."""
    return _enforce(df, col, is_url(col, strict), "url", mode)


def enforce_url_array(df: DataFrame, col: str, mode: str = "fail", strict: bool = False):
    return _enforce(df, col, is_url_array(col, strict), "url_array", mode)


def enforce_url_shlist(df: DataFrame, col: str, mode: str = "fail", strict: bool = False):
    return _enforce(df, col, is_url_shlist(col, strict), "url_shlist", mode)


def all_urls(df: DataFrame, by: list[str], col: str = "url", name: str = "valid") -> DataFrame:
    """The array check for lists kept as rows: NULLs are ignored, a group of only
    NULLs gives NULL.  Combines on the map side, so no list is ever gathered."""
    return df.groupBy(*by).agg(F.bool_and(is_url(col)).alias(name))


def reject_counts(df: DataFrame, col: str = "url") -> DataFrame:
    """Rows per rejection reason."""
    # The chain of tests runs on the rejected rows only, and on parts that are cut
    # out of the text in a step of their own, once each.
    texts = df.select(F.col(col).alias("url"))
    rejected = texts.where(~F.coalesce(is_url("url"), F.lit(False)))
    userinfo, host, port = authority_parts(F.col("url"))
    parts = rejected.select(
        "url", userinfo.alias("userinfo"), host.alias("host"), port.alias("port")
    )
    clause = clause_of(F.col("url"), F.col("userinfo"), F.col("host"), F.col("port"))
    return parts.groupBy(clause.alias("reason")).agg(F.count("*").alias("rows"))
