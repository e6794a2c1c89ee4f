"""The batch loop over a stream of URLs: results are appended as batches finish."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from linkloom.operators.fetch import Transport
from linkloom.operators.policy import FetchPolicy
from linkloom.plans.fetch_batches import fetch_batches
from linkloom.sources.snapshot import Snapshot


def fetch_stream(
    urls: DataFrame,
    transport: Snapshot | Transport,
    policy: FetchPolicy,
    results: str,
    progress: str,
    *,
    url: str = "url",
    on_invalid: str = "fail",
    once: bool = True,
) -> StreamingQuery:
    """Fetch what is there in micro-batches and stop; call again for what is new.

    With ``once`` a URL is requested when it first arrives and never again, in whatever micro-batch and after
    whatever restart: the stream's state holds the URLs seen, dealt out by URL.  (For more than memory holds,
    set ``spark.sql.streaming.stateStore.providerClass`` to the RocksDB provider.)  Without it URLs
    are distinct within a micro-batch only.

    ``results`` gets one folder ``epoch=<n>`` per micro-batch, replaced when a
    micro-batch is repeated after a failure.  Batches are numbered within a
    micro-batch.  ``progress`` is the stream's checkpoint; both
    belong in storage that all executors share.
    """

    def one(part: DataFrame, epoch: int) -> None:
        # The query's id is kept with its progress: a repeated micro-batch finds its finished
        # rounds under the same name, and a stream begun anew never finds those of an old one.
        run = part.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        fetched = fetch_batches(
            part, transport, policy, url=url, on_invalid=on_invalid, run_id=f"{run}-{epoch}"
        )
        fetched.write.mode("overwrite").parquet(f"{results}/epoch={epoch}")

    wanted = urls.select(F.col(url)).where(F.col(url).isNotNull())
    if once:
        wanted = wanted.dropDuplicates([url])
    return (
        wanted.writeStream.foreachBatch(one)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )
