"""Growth-driver questions (Q38a-f)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.dates import month_name_of
from tillroll.functions.measures import revenue
from tillroll.model import RetailModel
from tillroll.operators.grouping import final_order, revenue_by, revenue_by_bucket
from tillroll.operators.periods import factor_compare

# Fixed labels of the price and cost brackets.
PRICE_BRACKETS = ("Low", "Medium", "High", "Premium (50€+)")
PRICE_BRACKET_EDGES = (10, 30, 50)
COST_BRACKETS = ("Low cost", "Medium cost", "High cost")
COST_BRACKET_EDGES = (5, 15)


@final_order(("revenue", False), ("store_name", True), ("store_city", True))
def revenue_by_store_city(model: RetailModel) -> DataFrame:
    """Q38a."""
    return revenue_by(model.view(), ["store_name", "store_city"], "revenue")


@final_order(("revenue", False), ("month", True))
def revenue_by_month_name(model: RetailModel) -> DataFrame:
    """Q38b: grouped on the month number, named once per group."""
    per = revenue_by(model.view("month"), F.month("sales_date").alias("month_number"), "revenue")
    return per.select(month_name_of("month_number").alias("month"), "revenue")


@final_order(("revenue", False), ("product_name", True))
def revenue_by_product(model: RetailModel) -> DataFrame:
    """Q38c."""
    return revenue_by(model.view(of="products"), "product_name", "revenue")


@final_order(("revenue", False), ("price_range", True))
def revenue_by_price_bracket(model: RetailModel, edges: Sequence = PRICE_BRACKET_EDGES,
                             labels: Sequence[str] = PRICE_BRACKETS) -> DataFrame:
    """Q38d: brackets with exclusive upper edges."""
    return revenue_by_bucket(model.view(of="products"), "product_price", edges, labels, False, "price_range")


@final_order(("revenue", False), ("cost_range", True))
def revenue_by_cost_bracket(model: RetailModel, edges: Sequence = COST_BRACKET_EDGES,
                            labels: Sequence[str] = COST_BRACKETS) -> DataFrame:
    """Q38e."""
    return revenue_by_bucket(model.view(of="products"), "product_cost", edges, labels, False, "cost_range")


def compare_factors(model: RetailModel, k: int = 3, one_scan: bool = True) -> DataFrame:
    """Q38f: top k stores, months and categories by revenue (one scan by default)."""
    factors = {"Store": F.col("store_name"), "Month": (F.month("sales_date"), month_name_of),
               "Category": F.col("product_category")}
    return factor_compare(model.view("month"), factors, revenue(), k, one_scan)
