"""Feed load as a Structured Streaming job over the landing folder.

The original pipeline loads each feed on a schedule. Here the same load --
each file's own header, quoted line ends, missing-value tokens, quarantine
split -- runs as a file stream: each new CSV file in a feed's landing folder is processed once, the
source's file log and the query checkpoint (in the shared checkpoint folder)
record progress, and ``trigger(availableNow=True)`` gives the scheduled
"process what has arrived, then stop" behaviour.

Each micro-batch writes its raw rows and rejects under a folder named after
the batch id, with overwrite: if a batch is replayed after a failure, it
replaces its own output instead of duplicating it. :func:`streamed_feeds`
hands what has been loaded to the batch pipeline.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerline.operators import ingest
from ledgerline.session import ensure_checkpoint_dir
from ledgerline.sources.csv_feed import literal_path, read_feed_csv
from ledgerline.sources.feeds import FEEDS, FeedSpec
from ledgerline.sources.sinks import read_split, write_split

# Bounds a micro-batch, whatever the backlog.
FILES_PER_BATCH = 256

def _arrivals(spark: SparkSession, landing_dir: str, max_files: int) -> DataFrame:
    """The paths of new files; their content is not read here."""
    return (spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length bigint, content binary")
            .option("maxFilesPerTrigger", max_files).load(landing_dir).select("path"))


def _raw_folder(out_root: str, spec: FeedSpec) -> str:
    return os.path.join(out_root, "raw", spec.name)


def _batch_writer(out_root: str, spec: FeedSpec):
    def write(arrived: DataFrame, batch_id: int) -> None:
        # The files of a micro-batch are read as the batch load reads them;
        # the reject records come from the rejected rows as written.
        paths = [literal_path(r.path) for r in arrived.collect()]  # FILES_PER_BATCH at most
        batch = read_feed_csv(arrived.sparkSession, paths, spec)
        flagged = ingest.flag_rejects(ingest.feed_cells(batch, spec), spec)
        path = os.path.join(_raw_folder(out_root, spec), f"batch={batch_id}")
        write_split(ingest.split_rows(flagged, spec).withColumn("_loaded_at", F.current_timestamp()), path)
        rejects = ingest.reject_records(read_split(batch.sparkSession, path, spec), spec)
        (rejects.drop("source_table").withColumn("rejected_at", F.current_timestamp())
         .write.mode("overwrite").parquet(os.path.join(
             out_root, "raw", "rejected_records", f"source_table={spec.name}", f"batch={batch_id}")))
    return write


def start_feed_ingest(spark: SparkSession, landing_dir: str, out_root: str, spec: FeedSpec, *,
                      checkpoint: str | None = None, available_now: bool = True,
                      max_files_per_trigger: int = FILES_PER_BATCH) -> StreamingQuery:
    """Start the ingest stream for one feed; returns the running query."""
    checkpoint = checkpoint or os.path.join(ensure_checkpoint_dir(spark), "streams", f"ingest-{spec.name}")
    writer = (_arrivals(spark, landing_dir, max_files_per_trigger).writeStream
              .foreachBatch(_batch_writer(out_root, spec))
              .option("checkpointLocation", checkpoint)
              .queryName(f"ingest_{spec.name}"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def run_feed_ingest_once(spark: SparkSession, landing_dir: str, out_root: str, spec: FeedSpec,
                         checkpoint: str | None = None, max_files_per_trigger: int = FILES_PER_BATCH) -> DataFrame:
    """Process every file that has arrived, wait, and return the raw table."""
    q = start_feed_ingest(spark, landing_dir, out_root, spec, checkpoint=checkpoint,
                          max_files_per_trigger=max_files_per_trigger)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return read_streamed_raw(spark, out_root, spec)


def read_streamed_raw(spark: SparkSession, out_root: str, spec: FeedSpec) -> DataFrame:
    rows = read_split(spark, _raw_folder(out_root, spec), spec)
    return rows.where(~F.col("is_rejected")).drop("is_rejected", "batch")


def streamed_feeds(spark: SparkSession, out_root: str) -> dict[str, DataFrame]:
    """Everything the two ingest streams have loaded so far, rejected rows
    included, as feeds for ``plans.pipeline.run``: the batch pipeline then
    gives what it would over the files themselves."""
    feeds = {}
    for spec in FEEDS:
        rows = read_split(spark, _raw_folder(out_root, spec), spec)
        feeds[spec.name] = rows.select(*[F.col(c).alias(h) for c, h in zip(spec.raw_columns, spec.headers)])
    return feeds
