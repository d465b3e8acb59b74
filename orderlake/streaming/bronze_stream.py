"""Incremental Bronze ingest of landing files with Structured Streaming.

The batch Bronze job re-reads whatever landing path it is given; this stream
remembers (in its checkpoint) which landing files it has already ingested, so each
file enters Bronze once. Every micro-batch is appended to Bronze under a
deterministic batch id, in files of its own that a retry replaces, and, optionally,
merged into Silver right away.

Late data needs no watermark: the Silver merge keeps a record however late it
arrives, as long as its ``updated_at`` is newer than the current row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from orderlake.operators.bronze import prepare_bronze
from orderlake.operators.staging import stage_latest
from orderlake.plans import jobs
from orderlake.plans import silver_merge as sm
from orderlake.sources import tables as T
from orderlake.sources.schemas import LANDING_COLUMNS, LANDING_SCHEMA


def landing_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """New landing JSON files as a stream (explicit schema, file source)."""
    reader = spark.readStream.schema(LANDING_SCHEMA).option("mode", "PERMISSIVE")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.json(path)
    return stream.select(*LANDING_COLUMNS, F.col("_metadata.file_path").alias("__file"))


def ingest_epoch(
    spark: SparkSession,
    lake: T.Lake,
    batch: DataFrame,
    epoch_id: int,
    merge_into_silver: bool = True,
    keys: Sequence[str] = ("order_id",),
    run_prefix: str = "stream",
) -> None:
    """Take one micro-batch in. Doing it again, after a failure anywhere, leaves the same tables: Bronze
    holds the epoch's rows once (``silver_merge.append_once``), and the Silver merge is idempotent."""
    batch_id = f"{run_prefix}-bronze-{epoch_id:012d}"
    # One ingest clock per micro-batch, so the Bronze append and the staged Silver rows (two evaluations
    # of the batch) carry the same value.
    clock = F.lit(jobs._now()).cast("timestamp")
    bronze = prepare_bronze(batch, batch_id=batch_id, source_file=F.col("__file"), ingested_at=clock).drop("__file")
    if lake.format == "parquet":
        sm.append_once(spark, lake, bronze, batch_id, jobs.staging_path(spark, lake, "bronze_stream", batch_id))
    else:  # pragma: no cover - needs the delta package
        T.append(bronze, lake.bronze_orders, lake.format, partition_by="event_date")
    if merge_into_silver:
        staged = stage_latest(bronze, keys=keys)
        jobs.merge_silver(spark, lake, f"{run_prefix}-silver-{epoch_id}", keys=keys, staged=staged)


def start_bronze_stream(
    spark: SparkSession,
    lake: T.Lake,
    checkpoint: str | None = None,
    merge_into_silver: bool = True,
    keys: Sequence[str] = ("order_id",),
    run_prefix: str = "stream",
    available_now: bool = True,
) -> StreamingQuery:
    """Start the ingest. ``available_now`` processes what has landed, then stops.

    The checkpoint lives under the lake root (shared storage) unless given. A micro-batch that is retried
    after a failure enters Bronze and Silver once.
    """
    ckpt = checkpoint or lake.path("_checkpoints/bronze_stream")

    def per_batch(batch: DataFrame, epoch_id: int) -> None:
        ingest_epoch(batch.sparkSession, lake, batch, epoch_id, merge_into_silver, keys, run_prefix)

    writer = landing_stream(spark, lake.landing).writeStream.foreachBatch(per_batch).option("checkpointLocation", ckpt)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
