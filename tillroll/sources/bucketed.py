"""The cleaned tables laid out so that sales meet a large product dimension without a shuffle.

Layout of a folder:

* ``sales_bucketed``: in a fixed number of buckets of ``product_id``, each one file sorted by
  date, so that trailing windows skip most row groups;
* ``products``: in the same number of buckets of the same key, so that bucket i of the one
  joins bucket i of the other where both are read;
* ``sales_hot``, ``products_hot``: sales of products that would make their bucket much larger
  than the others, cut anywhere, and these products. There are fewer than
  ``buckets / HOT_BUCKETS`` such ids, so they are broadcast (behind the model's counted
  check). Sales without a product are kept here too;
* ``stores``, ``inventory``: plain;
* ``bucket_layout``: one row with the number of buckets and the schemas, written last and removed first, so a
  failure in between leaves no layout rather than half of an old one.

The buckets are those of Spark's bucketed tables. The catalog is only passed through: a table
is declared over its folder, resolved and dropped again, so nothing is left in the catalog
and any session can read a folder.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.sources.latest import FlatDates
from tillroll.sources.sinks import exists, remove

KEY = "product_id"
LAYOUT = "bucket_layout"
#: A product with more sales than this many mean buckets is kept apart.
HOT_BUCKETS = 4
COLUMNS = ["sale_id", "sales_date", "store_id", "product_id", "unit"]


@dataclass(frozen=True)
class DealtSales:
    """Sales in buckets, and those of the hot products with these products."""

    cold: DataFrame
    hot: DataFrame
    hot_products: DataFrame


def hot_ids(sales: DataFrame, buckets: int) -> DataFrame:
    """Ids of products with more than ``HOT_BUCKETS`` times the mean sales of a bucket: fewer
    than ``buckets / HOT_BUCKETS`` of them."""
    per = sales.groupBy(KEY).agg(F.count(F.lit(1)).alias("n"))
    total = per.agg(F.sum("n")).scalar()
    return per.filter(F.col(KEY).isNotNull() & (F.col("n") * buckets > total * HOT_BUCKETS)).select(KEY)


def _table() -> str:
    return f"tillroll_{uuid.uuid4().hex}"


def write_table(df: DataFrame, path: str, key: str, buckets: int, order: str) -> None:
    """Write ``df`` in buckets of ``key``, each one file sorted by ``order``, in place of what is
    below ``path``."""
    spark, name = df.sparkSession, _table()
    try:  # a task holds one bucket and writes one file
        (df.repartition(buckets, key).write.mode("overwrite").format("parquet").bucketBy(buckets, key)
         .sortBy(order).option("path", path).saveAsTable(name))
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")  # the declaration alone: files at a path stay


def read_table(spark: SparkSession, path: str, schema: str, key: str, buckets: int) -> DataFrame:
    """Files written by ``write_table`` in ``path`` and in folders below it, with their buckets."""
    name = _table()
    try:
        spark.sql(f"CREATE TABLE {name} ({schema}) USING parquet OPTIONS (path '{path}', recursiveFileLookup 'true') "
                  f"CLUSTERED BY ({key}) INTO {buckets} BUCKETS")
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def write_bucketed(tables: dict[str, DataFrame], path: str, buckets: int | None = None) -> int:
    """Write the four cleaned tables in this layout and return the number of buckets (by
    default that of shuffle partitions). ``tables`` must not be read from the same folder."""
    root = path.rstrip("/")
    sales = tables["sales"].select(*COLUMNS)
    spark = sales.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    remove(spark, f"{root}/{LAYOUT}")
    hot_ids(sales, buckets).write.mode("overwrite").parquet(f"{root}/hot_ids")
    ids = F.broadcast(spark.read.parquet(f"{root}/hot_ids"))  # fewer than buckets / HOT_BUCKETS
    tables["products"].join(ids, KEY, "left_semi").write.mode("overwrite").parquet(f"{root}/products_hot")
    marked = sales.join(ids.withColumn("hot", F.lit(True)), KEY, "left")
    apart = F.col("hot").isNotNull() | F.col(KEY).isNull()
    (marked.filter(apart).select(*COLUMNS).sortWithinPartitions("sales_date").write.mode("overwrite")
     .option("maxRecordsPerFile", 5_000_000).parquet(f"{root}/sales_hot"))
    write_table(marked.filter(~apart).select(*COLUMNS), f"{root}/sales_bucketed", KEY, buckets, "sales_date")
    write_table(tables["products"], f"{root}/products", KEY, buckets, KEY)
    for name in ("stores", "inventory"):
        tables[name].write.mode("overwrite").parquet(f"{root}/{name}")
    spark.range(1).select(F.lit(buckets).alias("buckets"), F.lit(ddl(sales)).alias("sales"),
                          F.lit(ddl(tables["products"])).alias("products")).write.mode("overwrite").parquet(f"{root}/{LAYOUT}")
    return buckets


def read_bucketed(spark: SparkSession, path: str) -> tuple[dict[str, DataFrame], DealtSales]:
    """The cleaned tables of this layout, and its sales as they are dealt. ``sales`` of the
    tables are all sales."""
    root = path.rstrip("/")
    if not exists(spark, f"{root}/{LAYOUT}"):
        raise FileNotFoundError(f"no bucketed layout below {root}")
    layout = spark.read.parquet(f"{root}/{LAYOUT}").first()
    cold = read_table(spark, f"{root}/sales_bucketed", layout["sales"], KEY, layout["buckets"])
    hot = spark.read.schema(layout["sales"]).parquet(f"{root}/sales_hot")
    products = read_table(spark, f"{root}/products", layout["products"], KEY, layout["buckets"])
    tables = {"sales": cold.unionByName(hot), "products": products,
              **{name: spark.read.parquet(f"{root}/{name}") for name in ("stores", "inventory")}}
    return tables, DealtSales(cold, hot, spark.read.schema(layout["products"]).parquet(f"{root}/products_hot"))


def bucketed_dates(path: str) -> FlatDates:
    """Where the months of the sales of this layout are known from."""
    root = path.rstrip("/")
    return FlatDates(f"{root}/sales_bucketed", "sales_date", further=(f"{root}/sales_hot",))
