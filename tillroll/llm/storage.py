"""Intermediate tables in the shared folder that the cluster names in spark.checkpoint.dir."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tillroll.session import ensure_checkpoint_dir


def new_path(spark: SparkSession, name: str) -> str:
    """A path of its own below the shared folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


#: Bytes of an Arrow batch between Spark and a Python worker while a table is written: whole
#: texts travel in them, and each batch is held on both sides.
BATCH_BYTES = 8 << 20
_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs of this block get Arrow batches of about BATCH_BYTES; the session's own setting
    comes back afterwards."""
    old = spark.conf.get(_BATCH_CONF, None)
    spark.conf.set(_BATCH_CONF, str(BATCH_BYTES))
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(_BATCH_CONF)
        else:
            spark.conf.set(_BATCH_CONF, old)


def written(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """The rows of ``df`` as a written table: later steps read it again instead of working
    the rows out anew, and it outlives lost executors. It goes when the application ends,
    since a lazy result may read it until then."""
    spark = df.sparkSession
    path = new_path(spark, name)
    with small_batches(spark):
        df.write.option("compression", compression).parquet(path)
    remove_at_end(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def _folder(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def remove(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table of this run."""
    fs, target = _folder(spark, path)
    fs.delete(target, True)


def remove_at_end(spark: SparkSession, path: str) -> None:
    """Delete an existing intermediate table when the application ends."""
    fs, target = _folder(spark, path)
    fs.deleteOnExit(target)
