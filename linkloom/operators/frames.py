"""Framed text: records of delimiter-separated fields in text values or files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.functions.text import literal_pattern, split_to_fields, split_to_rows
from linkloom.functions.urls import as_column

# --- fixed values: the token and field order of a response frame --------------
TOKEN = "@wget_token@"
FIELDS = ["url", "payload", "ts_start", "ts_end"]
# ------------------------------------------------------------------------------


def frame_record(*fields: Column | str, token: str = TOKEN) -> Column:
    """One record: the fields separated by a token, closed by two tokens.  A NULL
    field is written as empty text."""
    texts = [F.coalesce(as_column(f).cast("string"), F.lit("")) for f in fields]
    return F.concat(F.concat_ws(token, *texts), F.lit(token * 2))


def frames(
    df: DataFrame, col: str, names: list[str] = FIELDS, token: str = TOKEN, position: str = "pos"
) -> DataFrame:
    """One row per record of ``col``; missing fields are NULL."""
    record_end = literal_pattern(token * 2) + "\n"
    rows = split_to_rows(df, col, record_end, "__record", position)
    others = [c for c in df.columns if c != col]
    return rows.select(
        *others, position, *split_to_fields("__record", literal_pattern(token), names)
    )


def frame_files(
    spark: SparkSession, path: str | list[str], names: list[str] = FIELDS, token: str = TOKEN, file: str | None = None
) -> DataFrame:
    """One row per record of framed files; missing fields are NULL.

    Files are split at the record separator wherever a split of the file ends, so many tasks read one large
    file and none holds more than a record.  What stands before the first and after the last
    separator is a record too, unless it is empty.  ``file`` names a column for the file a record is from.
    """
    rows = spark.read.option("lineSep", token * 2 + "\n").text(path)
    source = [F.col("_metadata.file_path").alias(file)] if file else []
    return rows.where("value <> ''").select(*source, *split_to_fields("value", literal_pattern(token), names))
