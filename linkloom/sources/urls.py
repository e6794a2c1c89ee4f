"""URL lists: from a template, an array column or a Python list."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def url_template(df: DataFrame, key: str, template: str, name: str = "url") -> DataFrame:
    """Add a URL made from ``key`` with a ``%s`` template."""
    return df.withColumn(name, F.format_string(template, F.col(key)))


def url_range(spark: SparkSession, first: int, last: int, template: str) -> DataFrame:
    """``(id, url)`` for every id of ``first..last``, both ends included."""
    return url_template(spark.range(first, last + 1), "id", template)


def unnest_urls(df: DataFrame, col: str, name: str = "url") -> DataFrame:
    """One row per element of an array column, NULL elements included."""
    return df.select(F.explode(col).alias(name))


def url_list(spark: SparkSession, urls: list[str | None]) -> DataFrame:
    """A frame of the URLs.  Passed as an Arrow table, so Spark knows its size."""
    return spark.createDataFrame(pa.table({"url": pa.array(urls, pa.string())}))
