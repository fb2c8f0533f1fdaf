"""Incremental landing ingest with Structured Streaming (T1).

New landing files (JSON, ``run_date=/ticker=`` folders) are picked up by the
file source; each micro-batch is normalised and loaded like a batch (rejects
split off, latest version per (date, ticker), anti-join against the keys already
in the raw table, year-partitioned append).

* File-level exactly-once comes from the stream checkpoint (shared folder).
* Rows and rejects (rows without a date or ticker; beside the target unless
  another path is given) are keyed by the stream and the number of the
  micro-batch. A batch that runs again after a failure between write and commit
  replaces what its first run left, so both tables end as after one clean run.
* No watermark: the anti-join is against the target's keys, as in the batch
  loader; state lives in the target table, not in the stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.sources import sinks
from marketlake.sources.files import normalize_prices


def ingest_batch(target_path: str, rejects_path: str | None = None):
    def handle(batch: DataFrame, epoch_id: int) -> None:
        rows = normalize_prices(batch, ticker="ticker",
                                ingested_at=F.col("run_date").cast("timestamp"))
        spark = batch.sparkSession
        # the id of the stream's checkpoint: a new stream does not replace an older one's batches
        stream = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"
        sinks.insert_new(spark, rows, target_path, rejects_path, f"{stream}-{epoch_id}")
    return handle


def start_landing_ingest(spark: SparkSession, landing_path: str, target_path: str,
                         checkpoint_path: str, available_now: bool = True,
                         rejects_path: str | None = None):
    """Start the stream; with ``available_now`` it processes what is there
    and stops (scheduled runs), otherwise it keeps polling."""
    rejects_path = rejects_path or target_path.rstrip("/") + "-rejects"
    stream = (spark.readStream.schema(sinks.LANDING_SCHEMA)
              .option("basePath", landing_path).json(landing_path))
    writer = (stream.writeStream.foreachBatch(ingest_batch(target_path, rejects_path))
              .option("checkpointLocation", checkpoint_path))
    writer = writer.trigger(availableNow=True) if available_now \
        else writer.trigger(processingTime="1 minute")
    return writer.start()


def run_once(spark: SparkSession, landing_path: str, target_path: str,
             checkpoint_path: str, rejects_path: str | None = None) -> None:
    q = start_landing_ingest(spark, landing_path, target_path, checkpoint_path,
                             rejects_path=rejects_path)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def incremental_ingest_demo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two scheduled runs: the first run date's landing files, then the
    second's; the stream checkpoint skips files already taken."""
    from marketlake.plans import layers
    landing = sinks.scratch(spark, "stream-landing")
    target = sinks.scratch(spark, "stream-raw")
    ckpt = sinks.scratch(spark, "stream-ckpt")
    for batch in layers.raw_batches(spark, sf_dir).values():
        sinks.write_landing(batch, landing)
        run_once(spark, landing, target, ckpt)
    return sinks.read_prices(spark, target)
