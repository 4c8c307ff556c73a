"""Declared text-first schemas of the raw files (no inference).

Dates and money arrive as text and are typed by the cleaning operators; integer keys are
declared as integers so that a malformed key becomes NULL plus a corrupt-record entry.
"""

from pyspark.sql import types as T

CORRUPT_COLUMN = "_corrupt_record"
PARTITION_COLUMN = "sales_month"  # 'yyyy-MM' month partition of the cleaned sales layout


def _fields(*cols):
    return [T.StructField(name, dtype, True) for name, dtype in cols]


SALES_RAW = T.StructType(_fields(
    ("Sale_ID", T.IntegerType()),
    ("date", T.StringType()),
    ("Store_ID", T.IntegerType()),
    ("Product_ID", T.IntegerType()),
    ("Unit", T.IntegerType()),
    (CORRUPT_COLUMN, T.StringType()),
))

PRODUCTS_RAW = T.StructType(_fields(
    ("Product_ID", T.IntegerType()),
    ("Product_Name", T.StringType()),
    ("Product_Category", T.StringType()),
    ("Product_Cost", T.StringType()),
    ("Product_Price", T.StringType()),
    (CORRUPT_COLUMN, T.StringType()),
))

STORES_RAW = T.StructType(_fields(
    ("Store_ID", T.IntegerType()),
    ("Store_Name", T.StringType()),
    ("Store_City", T.StringType()),
    ("Store_Location", T.StringType()),
    ("Store_Open_Date", T.StringType()),
    (CORRUPT_COLUMN, T.StringType()),
))

INVENTORY_RAW = T.StructType(_fields(
    ("Store_ID", T.IntegerType()),
    ("Product_ID", T.IntegerType()),
    ("Stock_On_Hand", T.IntegerType()),
    (CORRUPT_COLUMN, T.StringType()),
))
