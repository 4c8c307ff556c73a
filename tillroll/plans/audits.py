"""Star view, audits and cleaning checks (S5, A1-A12, C1-C7) on a model.

The cleaning checks rebuild the raw text forms (``m/d/Y`` dates, ``$x.xx `` money,
ISO open dates) from the typed tables, run the cleaning operators on them and return
the result, so every row of the tables goes through the text-to-type path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.model import RetailModel
from tillroll.operators import cleaning, quality, sets


def star_view(model: RetailModel) -> DataFrame:
    return model.line_view()


def null_store_keys(model: RetailModel) -> DataFrame:
    return quality.violation_summary(quality.null_keys(model.stores, "store_id"), "stores.store_id is null")


def null_product_keys(model: RetailModel) -> DataFrame:
    return quality.violation_summary(quality.null_keys(model.products, "product_id"),
                                     "products.product_id is null")


def duplicate_store_keys(model: RetailModel) -> DataFrame:
    return quality.violation_summary(quality.duplicate_keys(model.stores, "store_id"),
                                     "stores.store_id duplicated")


def duplicate_product_keys(model: RetailModel) -> DataFrame:
    return quality.violation_summary(quality.duplicate_keys(model.products, "product_id"),
                                     "products.product_id duplicated")


def duplicate_sale_keys(model: RetailModel) -> DataFrame:
    return quality.duplicate_keys(model.sales, "sale_id")


def product_key_check(model: RetailModel) -> DataFrame:
    return quality.key_violations(model.products, "product_id", "products")


def store_key_check(model: RetailModel) -> DataFrame:
    return quality.key_violations(model.stores, "store_id", "stores")


def sale_key_check(model: RetailModel) -> DataFrame:
    return quality.key_violations(model.sales, "sale_id", "sales")


def zero_prices(model: RetailModel) -> DataFrame:
    return quality.violation_summary(quality.value_check(model.products, "product_price", "==", 0),
                                     "product_price = 0")


def negative_prices(model: RetailModel) -> DataFrame:
    return quality.violation_summary(quality.value_check(model.products, "product_price", "<", 0),
                                     "product_price < 0")


def negative_units(model: RetailModel) -> DataFrame:
    return quality.violation_summary(quality.value_check(model.sales, "unit", "<", 0), "unit < 0")


def distinct_units(model: RetailModel) -> DataFrame:
    """A12: from the written sets of units at daily grain, else from the sales."""
    stored = model.store_sets("unit")
    if stored is not None:
        return sets.members(stored, [], "unit").select(F.col("unit").cast("int"))
    return quality.distinct_values(model.line_view(), "unit")


# ---- audits over tables with violations -------------------------------------------------

def damaged(model: RetailModel) -> RetailModel:
    """The model with faults by rule, so that every audit has something to find: of every 7
    stores and 11 products the key of one is NULL and of another repeats the key before it,
    prices of every 13 products are zero or negative, units of every 17 sales negative."""
    def keyed(df: DataFrame, key: str, step: int) -> DataFrame:
        at = F.pmod(F.col(key), F.lit(step))
        return df.withColumn(key, F.when(at == 1, F.lit(None)).when(at == 3, F.col(key) - 1).otherwise(F.col(key)))

    at = F.pmod(F.col("product_id"), F.lit(13))
    price = (F.when(at == 2, F.lit(0)).when(at == 5, -F.col("product_price")).otherwise(F.col("product_price"))
             .cast("decimal(10,2)"))
    products = keyed(model.products.withColumn("product_price", price), "product_id", 11)
    sales = model.sales.withColumn(
        "unit", F.when(F.pmod(F.col("sale_id"), F.lit(17)) == 4, -F.col("unit")).otherwise(F.col("unit")))
    return RetailModel(sales, products, keyed(model.stores, "store_id", 7), model.inventory)


def violations(model: RetailModel) -> DataFrame:
    """The summaries of A1-A4 and A9-A11 over the damaged tables, one row for each audit."""
    model = damaged(model)
    out = None
    for audit in (null_store_keys, null_product_keys, duplicate_store_keys, duplicate_product_keys,
                  zero_prices, negative_prices, negative_units):
        out = audit(model) if out is None else out.unionByName(audit(model))
    return out


def key_constraints(model: RetailModel) -> DataFrame:
    """The summaries of A6 and A7 over the damaged tables."""
    model = damaged(model)
    return product_key_check(model).unionByName(store_key_check(model))


# ---- cleaning checks ---------------------------------------------------------------

def raw_sales_text(model: RetailModel) -> DataFrame:
    """Sales with the date rendered back to ``m/d/Y`` text (no zero padding)."""
    return model.sales.select("sale_id", F.date_format("sales_date", "M/d/yyyy").alias("date"),
                              "store_id", "product_id", "unit")


def raw_products_text(model: RetailModel) -> DataFrame:
    """Products with money rendered back to ``$x.xx `` text (symbol and trailing space)."""
    def text(c):
        return F.concat(F.lit("$"), F.col(c).cast("string"), F.lit(" "))
    return model.products.select("product_id", text("product_cost").alias("product_cost"),
                                 text("product_price").alias("product_price"))


def date_column_added(model: RetailModel) -> DataFrame:
    """C1 + C2: the parsed date next to its text."""
    return cleaning.parse_date(raw_sales_text(model), "date", "sales_date").select(
        "sale_id", "date", "sales_date")


def half_filled(model: RetailModel) -> DataFrame:
    """Raw sales of which some have their date already and some have a text that is no date: by
    sale id, 0 is filled and its text unparsable (the date stays), 1 has no text, 2 has an
    unparsable text and no date, 3 is filled with another day than its text (the date stays)."""
    at = F.pmod(F.col("sale_id"), F.lit(10))
    raw = model.sales.select(
        "sale_id", "sales_date", F.date_format("sales_date", "M/d/yyyy").alias("text"))
    return raw.select(
        F.col("sale_id").alias("sid"),
        F.when(at == 1, F.lit(None)).when(at.isin(0, 2), F.lit("13/45/2023")).otherwise(F.col("text")).alias("date"),
        F.when(at == 0, F.col("sales_date")).when(at == 3, F.date_add("sales_date", 1)).cast("date").alias("parsed"))


def date_parse_check(model: RetailModel) -> DataFrame:
    """C2 (idempotent fill) on half-filled rows, filled twice: rows, rows with a date, the days
    of these summed up, and quarantined rows (a text, but no date) as one row."""
    once = cleaning.parse_date(half_filled(model), "date", "parsed")
    twice = cleaning.parse_date(once, "date", "parsed")
    return twice.agg(
        F.count(F.lit(1)).cast("bigint").alias("n_rows"),
        F.count("parsed").cast("bigint").alias("n_parsed"),
        F.sum(F.datediff("parsed", F.lit("1970-01-01").cast("date"))).cast("bigint").alias("days"),
        F.count(F.when(F.col("date").isNotNull() & F.col("parsed").isNull(), 1)).cast("bigint")
        .alias("n_quarantined"))


def date_text_dropped(model: RetailModel) -> DataFrame:
    """C3: the cleaned sales table without the text column."""
    return cleaning.parse_date(raw_sales_text(model), "date", "sales_date", drop_source=True).select(
        "sale_id", "sales_date", "store_id", "product_id", "unit")


def open_date_cast(model: RetailModel) -> DataFrame:
    """C4: ISO text open dates back to DATE."""
    raw = model.stores.select("store_id", F.col("store_open_date").cast("string").alias("store_open_date"))
    return cleaning.cast_date(raw, "store_open_date")


def cost_text_stripped(model: RetailModel) -> DataFrame:
    """C5."""
    return cleaning.strip_currency(raw_products_text(model), "product_cost").select("product_id", "product_cost")


def price_text_stripped(model: RetailModel) -> DataFrame:
    """C6."""
    return cleaning.strip_currency(raw_products_text(model), "product_price").select("product_id", "product_price")


def money_cast(model: RetailModel) -> DataFrame:
    """C7: both money columns from text to decimal(10,2)."""
    df = raw_products_text(model)
    df = cleaning.clean_money(cleaning.clean_money(df, "product_cost"), "product_price")
    return df.select("product_id", "product_cost", "product_price")
