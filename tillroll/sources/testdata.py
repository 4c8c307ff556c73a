"""The driver's TPC-H-style parquet tables seen as the retail star schema.

part -> products, supplier x nation x region -> stores, lineitem -> sales, and an
inventory snapshot derived from the distinct (supplier, part) pairs of lineitem.
Only the columns named here are read, so the parquet scans are pruned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.sources.latest import FlatDates

# Fixed values of the mapping (kept equal in the SQL oracle).
STORE_EPOCH = "1990-01-01"
STORE_DAY_STEP = 37
STORE_DAY_SPAN = 3650
COST_BASE_PERCENT = 30
STOCK_STORE_FACTOR = 31
STOCK_PRODUCT_FACTOR = 17
STOCK_MODULUS = 30


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")


def testdata_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = _table(spark, sf_dir, "part")
    price = F.col("p_retailprice").cast("decimal(10,2)")
    cost = F.round(price * (F.lit(COST_BASE_PERCENT) + F.col("p_size")).cast("decimal(4,0)")
                   * F.lit(0.01).cast("decimal(3,2)"), 2).cast("decimal(10,2)")
    return part.select(
        F.col("p_partkey").alias("product_id"),
        F.concat(F.col("p_name"), F.lit(" #"), F.col("p_partkey").cast("string")).alias("product_name"),
        F.col("p_type").alias("product_category"),
        cost.alias("product_cost"),
        price.alias("product_price"),
    )


def testdata_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = _table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    nation = _table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = _table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey)
    open_offset = ((F.col("s_suppkey") * STORE_DAY_STEP) % STORE_DAY_SPAN).cast("int")
    return (supplier.join(geo, supplier.s_nationkey == geo.n_nationkey)
            .select(
                F.col("s_suppkey").alias("store_id"),
                F.col("s_name").alias("store_name"),
                F.col("n_name").alias("store_city"),
                F.col("r_name").alias("store_location"),
                F.date_add(F.lit(STORE_EPOCH).cast("date"), open_offset).alias("store_open_date"),
            ))


def testdata_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = _table(spark, sf_dir, "lineitem")
    return lineitem.select(
        F.col("l_orderkey").alias("sale_id"),
        F.col("l_shipdate").cast("date").alias("sales_date"),
        F.col("l_suppkey").alias("store_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("unit"),
    )


def testdata_dates(sf_dir: str) -> FlatDates:
    return FlatDates(f"{str(sf_dir).rstrip('/')}/lineitem.parquet", "l_shipdate", micros=True)


def testdata_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = _table(spark, sf_dir, "lineitem")
    stock = ((F.col("store_id") * STOCK_STORE_FACTOR + F.col("product_id") * STOCK_PRODUCT_FACTOR)
             % STOCK_MODULUS).cast("int")
    pairs = (lineitem.select(F.col("l_suppkey").alias("store_id"), F.col("l_partkey").alias("product_id"))
             .distinct())
    return pairs.select("store_id", "product_id", stock.alias("stock_on_hand"))


def testdata_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "sales": testdata_sales(spark, sf_dir),
        "products": testdata_products(spark, sf_dir),
        "stores": testdata_stores(spark, sf_dir),
        "inventory": testdata_inventory(spark, sf_dir),
    }
