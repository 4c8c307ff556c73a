"""Delimited (CSV) readers for the four raw tables.

Comma separated, one header line, no quoting needed; CRLF or LF line ends are both
handled by Spark's reader. Files are split across executors by
``spark.sql.files.maxPartitionBytes``; malformed lines are kept (PERMISSIVE) with the
original text in ``_corrupt_record``; cleaning moves them to the quarantine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillroll.sources.schemas import (
    CORRUPT_COLUMN, INVENTORY_RAW, PRODUCTS_RAW, SALES_RAW, STORES_RAW,
)


def _read(spark: SparkSession, path: str, schema) -> DataFrame:
    return (spark.read
            .option("header", "true")
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
            # parse whole lines whatever columns a query reads, so that every query finds
            # the same lines malformed
            .option("columnPruning", "false")
            .option("ignoreTrailingWhiteSpace", "false")
            .schema(schema)
            .csv(path))


def read_sales(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, SALES_RAW)


def read_products(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, PRODUCTS_RAW)


def read_stores(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, STORES_RAW)


def read_inventory(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, INVENTORY_RAW)
