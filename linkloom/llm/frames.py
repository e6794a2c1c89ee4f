"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import functools
import pickle
import uuid

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.sources.tables import shared_folder


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once to the folder all executors share, and read again.

    Cuts the lineage: what reads the result never recomputes ``df``, whichever
    executors are lost.
    """
    path = f"{shared_folder(df.sparkSession)}/linkloom-llm/{uuid.uuid4()}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Shared:
    """A value that tasks read through one broadcast.

    Its classes travel with it where the driver registered their package, as those of
    functions do, so workers need no copy of the package.
    """

    def __init__(self, spark: SparkSession, value: object):
        self._held = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    @functools.cached_property
    def value(self):
        return pickle.loads(self._held.value)

    def drop(self) -> None:
        """Free it everywhere; what has not run yet must not need it."""
        self._held.destroy()


def fold(doc_id: str = "doc_id") -> Column:
    """``crc32`` of the id as text modulo 5; rows of fold 0 are held out."""
    return F.crc32(F.col(doc_id).cast("string")) % 5


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(fold(doc_id) == 0, F.lit(False))


def training_labels(labels: DataFrame, name: str, doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, label``: one row per labelled id outside the held-out fold.

    Ids without a usable label are left out; contradicting rows of one id count
    with the greatest label.
    """
    rows = labels.select(F.col(doc_id).alias("doc_id"), F.col(name).cast("int").alias("label"))
    usable = rows.where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out())
    return usable.groupBy("doc_id").agg(F.max("label").alias("label"))


#: Words of 64 bits in a filter of ids.
FILTER_WORDS = 1 << 17


def likely_among(rows: DataFrame, ids: DataFrame, name: str = "doc_id") -> DataFrame:
    """The rows whose id is among ``ids``, and a few others: what a filter of fixed size lets through.

    It spares shuffling the rest before an exact join. With very many ids it lets all rows through.
    """
    place = F.xxhash64(name)
    word, bit = F.pmod(F.shiftright(place, 6), F.lit(FILTER_WORDS)), F.pmod(place, F.lit(64)).cast("int")
    one = F.call_function("shiftleft", F.lit(1).cast("long"), bit)
    bits = ids.groupBy(word.alias("_word")).agg(F.bit_or(one).alias("_bits"))
    # At most FILTER_WORDS rows, hence the broadcast.
    able = rows.withColumn("_word", word).join(F.broadcast(bits), "_word")
    return able.where(F.col("_bits").bitwiseAND(one) != 0).drop("_word", "_bits")
