"""Cleaning / structuring: text dates and currency text to typed columns.

All steps are lazy column expressions in one projection; nothing is mutated in place
and every row is converted in the same pass (no batch limit). Values that do not parse
become NULL and are routed to a quarantine frame instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.dates import parse_us_date
from tillroll.sources.schemas import CORRUPT_COLUMN

# Fixed value: currency symbols removed from money text.
CURRENCY_SYMBOLS = "$"
MONEY_TYPE = "decimal(10,2)"


def parse_date(df: DataFrame, src: str, dst: str, drop_source: bool = False) -> DataFrame:
    """C1-C3: add ``dst`` (if missing), fill it from text ``src`` only where still NULL
    (idempotent), optionally drop the text column."""
    if dst not in df.columns:
        df = df.withColumn(dst, F.lit(None).cast("date"))
    df = df.withColumn(dst, F.coalesce(F.col(dst), parse_us_date(src)))
    return df.drop(src) if drop_source else df


def unparsed(df: DataFrame, src: str, dst: str) -> DataFrame:
    """Rows whose text was present but did not convert (the quarantine)."""
    return df.filter(F.col(src).isNotNull() & F.col(dst).isNull())


def cast_date(df: DataFrame, col: str) -> DataFrame:
    """C4: ISO text to DATE; malformed text becomes NULL."""
    return df.withColumn(col, F.col(col).try_cast("date"))


def strip_currency(df: DataFrame, col: str, symbols: str = CURRENCY_SYMBOLS) -> DataFrame:
    """C5, C6: remove currency symbols and surrounding spaces from money text."""
    pattern = "[" + "".join("\\" + s for s in symbols) + "]"
    return df.withColumn(col, F.trim(F.regexp_replace(F.col(col), pattern, "")))


def to_decimal(df: DataFrame, cols, dtype: str = MONEY_TYPE) -> DataFrame:
    """C7: money text to decimal; malformed text becomes NULL."""
    for c in ([cols] if isinstance(cols, str) else cols):
        df = df.withColumn(c, F.col(c).try_cast(dtype))
    return df


def clean_money(df: DataFrame, col: str, symbols: str = CURRENCY_SYMBOLS,
                dtype: str = MONEY_TYPE) -> DataFrame:
    return to_decimal(strip_currency(df, col, symbols), col, dtype)


def replace_values(df: DataFrame, col: str, mapping: dict[str, str]) -> DataFrame:
    """Map known spelling variants of a text column to one form (e.g. a misspelt city)."""
    return df.replace(mapping, subset=[col]) if mapping else df


def _lower(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def malformed(df: DataFrame) -> Column:
    """Lines that do not fit the declared schema: a field that is missing, too many or not of
    its type. The CSV reader keeps the raw text of such a line."""
    corrupt = F.col(CORRUPT_COLUMN)
    others = [F.col(c).cast("string") for c in df.columns if c != CORRUPT_COLUMN]
    # The reader refuses plans that read the corrupt-record column alone, so the condition
    # names the others too; a line never ends in a line break, which keeps it true.
    return corrupt.isNotNull() & (F.concat_ws(",", *others) != F.concat(corrupt, F.lit("\n")))


def _with_corrupt(df: DataFrame) -> DataFrame:
    """Lower-case column names; frames without a corrupt-record column have no such lines."""
    lowered = _lower(df)
    return lowered if CORRUPT_COLUMN in lowered.columns else lowered.withColumn(
        CORRUPT_COLUMN, F.lit(None).cast("string"))


def clean_sales(raw: DataFrame) -> DataFrame:
    """Raw sales with ``sales_date`` typed next to its text."""
    return parse_date(_with_corrupt(raw), "date", "sales_date")


def rejected(sales: DataFrame) -> Column:
    """Sales rows for the quarantine: malformed lines, and dates that do not parse."""
    return malformed(sales) | (F.col("date").isNotNull() & F.col("sales_date").isNull())


def _split(df: DataFrame, bad: Column, columns: list[str], drop: list[str]) -> tuple[DataFrame, DataFrame]:
    """Clean rows (typed columns) and quarantined rows (with the raw text); each row is in one."""
    bad = F.coalesce(bad, F.lit(False))
    return df.filter(~bad).select(*columns), df.filter(bad).drop(*drop)


def clean_raw_tables(raw: dict[str, DataFrame], city_aliases: dict[str, str] | None = None
                     ) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """Raw text tables (as read by ``tillroll.sources.delimited``) to the clean model.

    ``city_aliases`` optionally maps spelling variants of store cities to one form
    (grouping is otherwise literal). Returns (clean tables, quarantined rows per table):
    every raw row is in exactly one of the two. Quarantined are lines that do not fit the
    schema and rows whose date or money text does not parse; they keep their raw text.
    """
    clean, quarantine = {}, {}
    sales = clean_sales(raw["sales"])
    clean["sales"], quarantine["sales"] = _split(
        sales, rejected(sales), ["sale_id", "sales_date", "store_id", "product_id", "unit"], ["sales_date"])

    products = _with_corrupt(raw["products"])
    bad = malformed(products)
    for name in ("product_cost", "product_price"):
        products = products.withColumn(f"{name}_text", F.col(name))
        products = clean_money(products, name)
        bad = bad | (F.col(f"{name}_text").isNotNull() & F.col(name).isNull())
    clean["products"], quarantine["products"] = _split(
        products, bad, ["product_id", "product_name", "product_category", "product_cost", "product_price"], [])

    stores = _with_corrupt(raw["stores"])
    bad = malformed(stores)
    stores = cast_date(stores.withColumn("store_open_date_text", F.col("store_open_date")), "store_open_date")
    bad = bad | (F.col("store_open_date_text").isNotNull() & F.col("store_open_date").isNull())
    clean["stores"], quarantine["stores"] = _split(
        stores, bad, ["store_id", "store_name", "store_city", "store_location", "store_open_date"], [])
    clean["stores"] = replace_values(clean["stores"], "store_city", city_aliases or {})

    inventory = _with_corrupt(raw["inventory"])
    clean["inventory"], quarantine["inventory"] = _split(
        inventory, malformed(inventory), ["store_id", "product_id", "stock_on_hand"], [])
    return clean, quarantine
