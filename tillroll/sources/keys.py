"""Key constraints kept up by appends (A6-A8 for a table that grows).

A full audit groups all rows by the key. Here the keys seen so far are stored below a folder,
and an append is checked against them:

* ``keys/batch=<n>``: each key of batch n with its rows, in buckets of the key. Spark reads
  all batches as one bucketed table, so the stored keys are joined without a shuffle: only
  the append's keys move. Its smallest and largest key bound the scan, which for growing
  ids skips the row groups of old keys;
* ``counts/batch=<n>``: what batch n added to the five counts, one row, written last;
* ``layout``: the number of buckets and the type of the key.

A batch with written counts is not counted again; one that failed before is done anew, its
own keys left out. One append at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.sources.bucketed import ddl, read_table, write_table
from tillroll.sources.sinks import exists

COUNTS = ("total_rows", "null_key_rows", "duplicated_keys", "duplicate_rows")


def _layout(rows: DataFrame, key: str, root: str, buckets: int | None) -> tuple[int, str]:
    spark = rows.sparkSession
    if not exists(spark, f"{root}/layout/_SUCCESS"):
        n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        schema = f"{ddl(rows.select(F.col(key).alias('key')))}, n bigint, batch bigint"
        spark.range(1).select(F.lit(n).alias("buckets"), F.lit(schema).alias("keys")).write.mode("overwrite") \
            .parquet(f"{root}/layout")
    layout = spark.read.parquet(f"{root}/layout").first()
    return layout["buckets"], layout["keys"]


def audit_append(rows: DataFrame, key: str, path: str, batch: int, *, check: str = "key",
                 buckets: int | None = None) -> DataFrame:
    """Add the ``rows`` of batch number ``batch`` to the audit below ``path`` and return its
    summary (``key_violations``'s columns) over all batches so far."""
    root, spark = path.rstrip("/"), rows.sparkSession
    if exists(spark, f"{root}/counts/batch={batch}/_SUCCESS"):
        return summary(spark, root, check)
    buckets, schema = _layout(rows, key, root, buckets)
    own = f"{root}/keys/batch={batch}"
    per_key = rows.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    # null keys are a row of their own: they are kept with the others and never join
    write_table(per_key.withColumn("batch", F.lit(batch).cast("bigint")), own, "key", buckets, "key")

    keys = read_table(spark, f"{root}/keys", schema, "key", buckets)
    new = read_table(spark, own, schema, "key", buckets)
    low, high = new.agg(F.min("key"), F.max("key")).first()
    seen = keys.filter(F.col("batch") != batch)
    if low is not None:
        seen = seen.filter(F.col("key").between(F.lit(low), F.lit(high)))
    seen = seen.groupBy("key").agg(F.sum("n").alias("before"))
    both = new.join(seen, "key", "left").select(
        "n", F.coalesce("before", F.lit(0)).alias("before"), F.col("key").isNull().alias("is_null"))
    after = F.col("before") + F.col("n")
    doubled = ~F.col("is_null") & (after > 1)
    added = both.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum(F.when(F.col("is_null"), F.col("n"))), F.lit(0)).alias("null_key_rows"),
        F.count(F.when(doubled & (F.col("before") <= 1), F.lit(1))).alias("duplicated_keys"),
        # a key that was single until now counts with its first row, too
        F.coalesce(F.sum(F.when(doubled, F.when(F.col("before") <= 1, after).otherwise(F.col("n")))), F.lit(0))
        .alias("duplicate_rows"))
    added.write.mode("overwrite").parquet(f"{root}/counts/batch={batch}")
    return summary(spark, root, check)


def summary(spark: SparkSession, path: str, check: str = "key") -> DataFrame:
    """The audit's counts over all batches, in one row."""
    schema = ", ".join(f"{c} bigint" for c in COUNTS)
    rows = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(f"{path.rstrip('/')}/counts")
    return rows.agg(F.lit(check).alias("check"),
                    *[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in COUNTS])


def duplicates(spark: SparkSession, path: str) -> DataFrame:
    """The keys that occur more than once in all batches, with their rows."""
    root = path.rstrip("/")
    layout = spark.read.parquet(f"{root}/layout").first()
    keys = read_table(spark, f"{root}/keys", layout["keys"], "key", layout["buckets"])
    return (keys.filter("key is not null").groupBy("key").agg(F.sum("n").alias("n_rows"))
            .filter(F.col("n_rows") > 1))
