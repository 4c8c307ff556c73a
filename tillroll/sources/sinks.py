"""Persist the cleaned model as parquet and read it back.

Layout of a folder, shared by batch writes and streaming ingests:

* ``sales`` (by calendar month, so that trailing windows skip whole directories),
  ``products``, ``stores``, ``inventory``: the batch-written tables.
* ``sales_daily``: the daily rollup of ``sales``, or absent. Every batch write replaces or
  removes it, or its part for the months that are rewritten, so that it never stands for
  other sales than those beside it.
* ``sales_monthly``: the month cube, units and lines per store, product and month, summed from
  the daily rollup; written, replaced and removed together with it.
* ``sales_sets``: for each month and store the sets of sale ids and of units of its sales whose
  product exists (``operators.sets``), or absent; kept in step with ``sales`` like the rollup.
* ``sales_stream/ingest=<i>/batch=<n>/sales_month=<m>``: streamed rows, one folder for each
  micro-batch of each ingest. They are no part of ``sales``: a batch write leaves them.
* ``sales_stream_daily/ingest=<i>/batch=<n>``: the rollup of such a micro-batch, if its
  ingest writes one; ``sales_stream_monthly`` holds its part of the month cube. Rows that come
  late are in the part of the micro-batch that brought them: parts are summed when read.
* ``sales_stream*/ingest=folded/batch=<k>`` and ``sales_folds/fold=<k>``: many micro-batches
  put together, see ``sources.folding``.

Reading takes batch and streamed rows together. The daily rollup is put together from the
parts that are written; what has no part is rolled up from its rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.operators import sets
from tillroll.sources import folding
from tillroll.sources.folding import exists, folder, live, remove
from tillroll.sources.latest import MonthFolders
from tillroll.sources.schemas import PARTITION_COLUMN

TABLES = ("sales", "products", "stores", "inventory")
STREAM = "sales_stream"
STREAM_DAILY = "sales_stream_daily"
STREAM_MONTHLY = "sales_stream_monthly"
BATCH_KEYS = ["ingest", "batch"]
DERIVED = ("sales_daily", "sales_monthly", "sales_sets")  # from the sales beside them
HIVE_NULL = "__HIVE_DEFAULT_PARTITION__"  # Spark's folder name for a NULL partition value
SALES_COLUMNS = ["sale_id", "sales_date", "store_id", "product_id", "unit", PARTITION_COLUMN]
DAILY_COLUMNS = ["store_id", "product_id", "sales_date", "unit", "lines", PARTITION_COLUMN]
SALES_SCHEMA = (f"sale_id int, sales_date date, store_id int, product_id int, unit int, "
                f"{PARTITION_COLUMN} string")
SET_KEYS = ["kind", "store_id"]
SET_KINDS = {"sale": "sale_id", "unit": "unit"}
DAILY_SCHEMA = f"store_id int, product_id int, sales_date date, unit long, lines long, {PARTITION_COLUMN} string"


def _months(spark: SparkSession, path: str) -> set[str]:
    """Names of the month folders below ``path``."""
    fs, target = folder(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(target)] if fs.exists(target) else []
    return {n.split("=", 1)[1] for n in names if n.startswith(f"{PARTITION_COLUMN}=")}


def with_month(df: DataFrame) -> DataFrame:
    return df if PARTITION_COLUMN in df.columns else df.withColumn(
        PARTITION_COLUMN, F.date_format("sales_date", "yyyy-MM"))


def rollup(sales: DataFrame, *keys: str) -> DataFrame:
    """Units and lines per store, product and day (and ``keys``)."""
    return (sales.groupBy("store_id", "product_id", "sales_date", PARTITION_COLUMN, *keys)
            .agg(F.sum("unit").alias("unit"), F.count(F.lit(1)).alias("lines")))


def monthly(daily: DataFrame) -> DataFrame:
    """Rolled-up rows summed per month, which its first day stands for."""
    return (daily.groupBy("store_id", "product_id", F.trunc("sales_date", "month").alias("sales_date"), PARTITION_COLUMN)
            .agg(F.sum("unit").alias("unit"), F.sum("lines").alias("lines")))


def number_sets(sales: DataFrame, products: DataFrame) -> DataFrame:
    """Per month and store, the sets of sale ids and of units of the sales whose product exists:
    (kind, store_id, sales_month, block, bits)."""
    known = sales.join(products.select("product_id"), "product_id", "left_semi")
    kinds = [sets.collect(known, ["store_id", PARTITION_COLUMN], number).withColumn("kind", F.lit(kind))
             for kind, number in SET_KINDS.items()]
    return kinds[0].unionByName(kinds[1]).select(*SET_KEYS, sets.BLOCK, sets.BITS, PARTITION_COLUMN)


def write_clean(tables: dict[str, DataFrame], path: str, mode: str = "overwrite",
                daily: DataFrame | None = None, with_sets: bool = False) -> None:
    """Write the four cleaned tables; ``daily`` (``RetailModel.daily()``) is written too,
    as ``sales_daily`` partitioned by month like the sales table, with the month cube, and ``with_sets`` the sets
    of sale ids and units.

    Without them, or when sales are appended, a rollup or sets that were there would no longer
    cover ``sales`` and are removed before anything is written. Streamed rows stay.
    """
    root = path.rstrip("/")
    spark = tables["sales"].sparkSession
    # removed first: a failure in between leaves no rollup rather than a wrong one
    for name in DERIVED:
        remove(spark, f"{root}/{name}")
    for name in TABLES:
        df = tables[name]
        writer = df.write.mode(mode)
        if name == "sales":
            # Sort inside each task (no shuffle): a month holding a third of all rows is still
            # written by every task in parallel, each task keeping one file open at a time.
            writer = (with_month(df).sortWithinPartitions(PARTITION_COLUMN).write.mode(mode)
                      .option("maxRecordsPerFile", 5_000_000).partitionBy(PARTITION_COLUMN))
        writer.parquet(f"{root}/{name}")
    if daily is not None and mode == "overwrite":
        def add(df: DataFrame, name: str) -> None:
            (df.sortWithinPartitions(PARTITION_COLUMN).write.mode(mode)
             .partitionBy(PARTITION_COLUMN).parquet(f"{root}/{name}"))

        daily = with_month(daily)
        add(daily, "sales_daily")
        add(monthly(spark.read.schema(daily.schema).parquet(f"{root}/sales_daily")), "sales_monthly")
    if with_sets and mode == "overwrite":
        (number_sets(with_month(tables["sales"]), tables["products"]).sortWithinPartitions(PARTITION_COLUMN)
         .write.mode(mode).partitionBy(PARTITION_COLUMN).parquet(f"{root}/sales_sets"))


def _streamed(spark: SparkSession, root: str) -> DataFrame | None:
    """Streamed rows with the micro-batch that each came with, or None."""
    if not exists(spark, f"{root}/{STREAM}"):
        return None
    schema = SALES_SCHEMA.replace(f", {PARTITION_COLUMN} string", "")
    return spark.read.schema(f"{schema}, ingest string, batch long, {PARTITION_COLUMN} string") \
        .parquet(f"{root}/{STREAM}").filter(live(spark, root))


def _batch_sales(spark: SparkSession, root: str) -> DataFrame | None:
    if not exists(spark, f"{root}/sales"):
        return None
    return spark.read.parquet(f"{root}/sales").select(*SALES_COLUMNS)


def write_months(sales: DataFrame, path: str, daily: bool = False) -> None:
    """Replace the months that ``sales`` has rows of, in the batch-written table; other months
    and streamed rows stay as they are.

    ``daily`` writes the months' rollup, and their sets, as well. Where these are written, the
    months' part goes first and comes back last, so a failure in between leaves months without
    them (readers make them from the rows), never those of other rows. Written again,
    the months are replaced again. ``sales`` must not be read from the same folder.
    """
    root = path.rstrip("/")
    spark = sales.sparkSession
    sales = with_month(sales)
    months = [r[0] for r in sales.select(PARTITION_COLUMN).distinct().collect()]  # one for each month
    derived = [name for name in DERIVED if exists(spark, f"{root}/{name}")]
    for name in derived:
        for month in months:
            remove(spark, f"{root}/{name}/{PARTITION_COLUMN}={HIVE_NULL if month is None else month}")

    def replace(df: DataFrame, name: str) -> None:
        (df.sortWithinPartitions(PARTITION_COLUMN).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", 5_000_000)
         .partitionBy(PARTITION_COLUMN).parquet(f"{root}/{name}"))

    replace(sales, "sales")
    if daily and "sales_daily" in derived:
        replace(rollup(sales), "sales_daily")
    if daily and "sales_monthly" in derived:
        replace(monthly(rollup(sales)), "sales_monthly")
    if daily and "sales_sets" in derived:
        replace(number_sets(sales, spark.read.parquet(f"{root}/products")), "sales_sets")


def clean_months(path: str) -> MonthFolders:
    """Where the months of the sales below ``path`` are known from: batch-written and streamed."""
    root = path.rstrip("/")
    return MonthFolders(((f"{root}/sales", 0), (f"{root}/{STREAM}", len(BATCH_KEYS))))


def read_clean(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The cleaned tables. ``sales`` holds batch-written and streamed rows and keeps its
    ``sales_month`` partition column last, so trailing-window filters prune month
    directories of both."""
    root = path.rstrip("/")
    out = {name: spark.read.parquet(f"{root}/{name}") for name in TABLES[1:]
           if exists(spark, f"{root}/{name}")}
    parts = [_batch_sales(spark, root)]
    streamed = _streamed(spark, root)
    parts.append(None if streamed is None else streamed.select(*SALES_COLUMNS))
    found = [p for p in parts if p is not None]
    if not found:
        raise FileNotFoundError(f"no sales below {root}")
    out["sales"] = found[0] if len(found) == 1 else found[0].unionByName(found[1])
    return {name: out[name] for name in TABLES if name in out}


def _months_without(spark: SparkSession, root: str, batch: DataFrame | None, name: str) -> DataFrame | None:
    """Batch-written sales of the months without a part of ``name``: rewritten since, or never
    rolled up. None where there is no such month."""
    missing = _months(spark, f"{root}/sales") - _months(spark, f"{root}/{name}") if batch is not None else ()
    if not missing:
        return None
    month = F.col(PARTITION_COLUMN)
    return batch.filter(month.isin([m for m in missing if m != HIVE_NULL])
                        | (month.isNull() if HIVE_NULL in missing else F.lit(False)))


def read_sets(spark: SparkSession, path: str) -> DataFrame | None:
    """Sets of sale ids and units of all sales below ``path``, or None when none are written.

    Months without a written part and streamed rows are read for theirs. A store's set of a
    kind may come in several rows of a block: ``operators.sets`` merges them.
    """
    root = path.rstrip("/")
    if not _months(spark, f"{root}/sales_sets"):
        return None
    columns = [*SET_KEYS, sets.BLOCK, sets.BITS]
    frames = [spark.read.parquet(f"{root}/sales_sets").select(*columns)]
    products = spark.read.parquet(f"{root}/products")
    for sales in (_months_without(spark, root, _batch_sales(spark, root), "sales_sets"), _streamed(spark, root)):
        if sales is not None:
            frames.append(number_sets(sales, products).select(*columns))
    merged = frames[0]
    for extra in frames[1:]:
        merged = merged.unionByName(extra)
    return merged


def read_daily(spark: SparkSession, path: str) -> DataFrame | None:
    """The daily rollup of all sales below ``path``, see ``_read_rollup``."""
    return _read_rollup(spark, path, "sales_daily", STREAM_DAILY, rollup)


def read_monthly(spark: SparkSession, path: str) -> DataFrame | None:
    """The month cube of all sales below ``path``, see ``_read_rollup``."""
    return _read_rollup(spark, path, "sales_monthly", STREAM_MONTHLY, lambda sales: monthly(rollup(sales)))


def _read_rollup(spark: SparkSession, path: str, name: str, parts_name: str,
                 rolled: Callable[[DataFrame], DataFrame]) -> DataFrame | None:
    """The rollup of all sales below ``path``, batch-written and streamed, or None when
    no part of it is written.

    Written parts are taken for the rows that they cover: a month of ``name`` for that
    month of ``sales``, the part of a micro-batch for that micro-batch. All other rows are rolled up here, so
    the result always covers every row.
    """
    root = path.rstrip("/")
    has_batch = bool(_months(spark, f"{root}/{name}"))
    has_parts = exists(spark, f"{root}/{parts_name}")
    if not has_batch and not has_parts:
        return None  # computed from the sales table instead
    frames = []
    batch = _batch_sales(spark, root)
    if has_batch:
        written = spark.read.parquet(f"{root}/{name}").select(*DAILY_COLUMNS)
        frames.append(written)
        rest = _months_without(spark, root, batch, name)
        if rest is not None:
            frames.append(rolled(rest).select(*DAILY_COLUMNS))
    elif batch is not None:
        frames.append(rolled(batch).select(*DAILY_COLUMNS))
    streamed = _streamed(spark, root)
    if streamed is not None:
        if has_parts:
            parts = spark.read.schema(f"{DAILY_SCHEMA}, ingest string, batch long") \
                .parquet(f"{root}/{parts_name}").filter(live(spark, root))
            unfinished = folding.parts(spark, root, parts_name) - folding.parts(spark, root, parts_name, finished=True)
            frames.append(parts.filter(~folding.of_parts(unfinished)).select(*DAILY_COLUMNS))
        # by the names of the folders: rows of parts that are rolled up are not read
        finished = folding.parts(spark, root, parts_name, finished=True)
        rest = folding.parts(spark, root, STREAM) - finished
        if rest:
            frames.append(rolled(streamed.filter(folding.of_parts(rest))).select(*DAILY_COLUMNS))
    if len(frames) == 1 and streamed is None:
        return frames[0]  # one row per (store, product, day) already; micro-batches may share keys
    merged = frames[0]
    for extra in frames[1:]:
        merged = merged.unionByName(extra)
    return (merged.groupBy("store_id", "product_id", "sales_date", PARTITION_COLUMN)
            .agg(F.sum("unit").alias("unit"), F.sum("lines").alias("lines"))
            .select(*DAILY_COLUMNS))
