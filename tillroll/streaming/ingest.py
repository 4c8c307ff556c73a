"""Raw sales files -> cleaned parquet, incrementally.

The batch path reads one sales file and converts its text dates once. New sales files
that keep arriving in a folder are the same job as a stream: the file source picks up
only unseen files and the same cleaning expressions type each row. One ``foreachBatch``
reads each micro-batch once and writes its clean rows, its quarantined rows and, if asked
for, its daily rollup and month cube, each to the folder of that micro-batch. A replayed micro-batch
overwrites its own folders, so rows are neither lost nor counted twice. No state is kept,
so the stream scales with the number of files per trigger.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillroll.operators.cleaning import clean_sales, rejected
from tillroll.session import ensure_checkpoint_dir
from tillroll.sources.schemas import CORRUPT_COLUMN, PARTITION_COLUMN, SALES_RAW
from tillroll.sources.sinks import STREAM, STREAM_DAILY, STREAM_MONTHLY, monthly, rollup, with_month

QUARANTINE = "quarantine"


def sales_stream(spark: SparkSession, input_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming read of raw sales CSV files (declared schema, header line skipped)."""
    reader = (spark.readStream.schema(SALES_RAW)
              .option("header", "true")
              .option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
              .option("columnPruning", "false"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.csv(input_dir)


def clean_sales_stream(raw: DataFrame) -> DataFrame:
    """Typed sales rows plus an ``is_quarantined`` flag: lines that do not fit the schema, and
    date text that does not parse. The raw line is kept in ``_corrupt_record``."""
    typed = clean_sales(raw)
    return typed.select("sale_id", "date", "sales_date", "store_id", "product_id", "unit", CORRUPT_COLUMN,
                        rejected(typed).alias("is_quarantined"))


def write_batch(batch: DataFrame, batch_id: int, output_dir: str, ingest: str, daily_rollup: bool) -> None:
    """Write one micro-batch to its own folders; written again, it replaces them."""
    root, own = output_dir.rstrip("/"), f"ingest={ingest}/batch={batch_id}"
    batch = batch.persist()  # read once for the two or three writes
    try:
        good = with_month(batch.filter(~F.col("is_quarantined"))
                          .select("sale_id", "sales_date", "store_id", "product_id", "unit"))
        bad = batch.filter("is_quarantined").drop("is_quarantined", "sales_date")
        bad.write.mode("overwrite").parquet(f"{root}/{QUARANTINE}/{own}")
        if daily_rollup:
            # before the rows: a part whose rows are not there yet is overwritten by the replay
            rollup(good).write.mode("overwrite").parquet(f"{root}/{STREAM_DAILY}/{own}")
            monthly(rollup(good)).write.mode("overwrite").parquet(f"{root}/{STREAM_MONTHLY}/{own}")
        good.write.mode("overwrite").partitionBy(PARTITION_COLUMN).parquet(f"{root}/{STREAM}/{own}")
    finally:
        batch.unpersist()


def start_sales_ingest(spark: SparkSession, input_dir: str, output_dir: str,
                       checkpoint_dir: str | None = None, available_now: bool = True,
                       processing_time: str = "1 minute",
                       max_files_per_trigger: int | None = None,
                       daily_rollup: bool = False) -> tuple[StreamingQuery, ...]:
    """Start the ingest; with ``daily_rollup`` each micro-batch's rollup and its part of
    the month cube are written as well.
    ``RetailModel.from_parquet(output_dir)`` reads the rows together with batch-written ones.

    ``checkpoint_dir`` defaults to a folder under ``spark.checkpoint.dir`` (shared storage
    on a cluster) that is named by the input and output folders, so that each ingest has
    its own. The folders written are named by the checkpoint: a new checkpoint on old
    output adds to it and replaces nothing. ``available_now=True`` processes what is there
    and stops (batch-like scheduling); otherwise a trigger every ``processing_time``.
    """
    out = output_dir.rstrip("/")
    if checkpoint_dir is None:
        pair = hashlib.sha256(f"{input_dir.rstrip('/')}\n{out}".encode()).hexdigest()[:16]
        checkpoint_dir = f"{ensure_checkpoint_dir(spark).rstrip('/')}/sales-ingest-{pair}"
    root = checkpoint_dir.rstrip("/")
    ingest = "i" + hashlib.sha256(root.encode()).hexdigest()[:16]
    cleaned = clean_sales_stream(sales_stream(spark, input_dir, max_files_per_trigger))
    writer = (cleaned.writeStream.queryName(f"tillroll_sales_{ingest}")
              .option("checkpointLocation", root)
              .foreachBatch(lambda batch, n: write_batch(batch, n, out, ingest, daily_rollup)))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    return (writer.start(),)
