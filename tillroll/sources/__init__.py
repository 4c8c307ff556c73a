"""Readers and writers: raw delimited files, the driver's parquet tables, cleaned output."""

from tillroll.sources.schemas import (
    CORRUPT_COLUMN, INVENTORY_RAW, PRODUCTS_RAW, SALES_RAW, STORES_RAW,
)
from tillroll.sources.delimited import read_inventory, read_products, read_sales, read_stores
from tillroll.sources.testdata import testdata_tables
from tillroll.sources.sinks import read_clean, write_clean

__all__ = [
    "CORRUPT_COLUMN", "INVENTORY_RAW", "PRODUCTS_RAW", "SALES_RAW", "STORES_RAW",
    "read_inventory", "read_products", "read_sales", "read_stores", "testdata_tables",
    "read_clean", "write_clean",
]
