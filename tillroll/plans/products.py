"""Product questions (Q7-Q12, Q31, Q34-Q36, Q39, Q42)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.measures import (
    line_count, money_sum, per_line_sum, percent, profit, ratio, revenue, round_half_up, unit_margin,
)
from tillroll.functions.rules import bucketize, classify
from tillroll.model import RetailModel
from tillroll.operators.grouping import (
    final_order, mean_by, revenue_by, share_of_total, top_k, versus_average,
)
from tillroll.operators.periods import declining, median_by
from tillroll.operators.ranking import rank_within


@final_order(("total_units_sold", False), ("product_name", True))
def high_volume_low_profit(model: RetailModel, min_units: int = 5000,
                           max_profit: int = 20000) -> DataFrame:
    """Q7: products selling more than ``min_units`` units with profit below ``max_profit``."""
    view = model.view(of="products")
    per = view.groupBy("product_name").agg(
        money_sum(revenue()).alias("revenue"),
        F.sum("unit").cast("bigint").alias("total_units_sold"),
        money_sum(profit()).alias("total_profit"),
        round_half_up(ratio(per_line_sum(view, unit_margin()), line_count(view)), 2).alias("unit_profit_margin"))
    return per.filter((F.col("total_units_sold") > min_units) & (F.col("total_profit") < max_profit))


def least_sold(model: RetailModel, k: int = 10) -> DataFrame:
    """Q8: the k products with the fewest units sold."""
    per = model.view(of="products").groupBy("product_name").agg(F.sum("unit").cast("bigint").alias("sold"))
    return top_k(per, "sold", k, ascending=True, tie_break=["product_name"])


def most_profitable_category(model: RetailModel, k: int = 1) -> DataFrame:
    """Q9."""
    per = revenue_by(model.view(of="products"), "product_category", "total_profit", measure=profit())
    return top_k(per, "total_profit", k, tie_break=["product_category"])


def declining_products(model: RetailModel, months: int = 3, zero_fill: bool = False,
                       complete_months_only: bool = False) -> DataFrame:
    """Q10: products whose monthly sale count fell versus the previous month present
    (``zero_fill``: versus the calendar month before, absent months counting zero)."""
    return declining(model.view("day"), "product_name", months, zero_fill=zero_fill,
                     complete_months_only=complete_months_only, stored_months=model.months())


def best_margin(model: RetailModel, k: int = 1) -> DataFrame:
    """Q11: products with the best mean margin percent (rounded to an integer).

    Rows are first counted per (product, price, cost); the mean of the per-row ratio is
    then sum(count x ratio) / sum(count): the same value, computed without a long
    order-dependent sum of doubles. Ranking uses the unrounded mean, then the name.
    """
    view = model.view(of="products")
    combos = view.groupBy("product_name", "product_price", "product_cost").agg(line_count(view).alias("n"))
    row_margin = ratio(F.col("product_price") - F.col("product_cost"), F.col("product_price")) * F.lit(100.0)
    per = (combos.withColumn("m", row_margin * F.col("n"))
           .groupBy("product_name").agg(ratio(F.sum("m"), F.sum("n")).alias("mean_margin")))
    best = top_k(per, "mean_margin", k, tie_break=["product_name"])
    return best.select("product_name",
                       round_half_up(F.col("mean_margin"), 0).cast("bigint").alias("profit_margin_percent"))


@final_order(("average_per_category", False), ("product_category", True))
def category_price(model: RetailModel) -> DataFrame:
    """Q12: mean list price per category, from the products table alone."""
    return mean_by(model.products, "product_category", "product_price", "average_per_category", 2)


def rank_in_category(model: RetailModel) -> DataFrame:
    """Q31: product rank by revenue inside its category."""
    per = revenue_by(model.view(of="products"), ["product_category", "product_name"], "revenue")
    ranked = rank_within(per, ["product_category"], [("revenue", False)], "rank_product_category",
                         bounded=model.bounded_by("products"))
    return ranked.select("product_category", "product_name", "rank_product_category")


@final_order(("revenue", False), ("product_name", True))
def market_share(model: RetailModel) -> DataFrame:
    """Q34: each product's share of total revenue."""
    per = revenue_by(model.view(of="products"), "product_name", "revenue")
    return share_of_total(per, "revenue", "market_share_percent", 2, bounded=model.bounded_by("products"))


def above_average_products(model: RetailModel, round_avg: int | None = 2) -> DataFrame:
    """Q35: products whose revenue exceeds the (rounded) mean product revenue."""
    per = revenue_by(model.view(of="products"), "product_name", "revenue")
    return versus_average(per, "revenue", "above", round_avg, bounded=model.bounded_by("products"))


def median_daily_sales(model: RetailModel, measure: str = "count", as_written: bool = False,
                       approximate: bool = False, selection: bool = False) -> DataFrame:
    """Q36: median per category of the daily number of sales (``measure='revenue'`` for the
    daily sales value the original's comment describes; ``selection``: by ranges of values)."""
    return median_by(model.view("day"), "product_category", "sales_date", measure, as_written,
                     approximate=approximate, selection=selection)


# Fixed labels of the discontinue question.
REVENUE_STATUS = ("low_sales", "medium_sales", "high_revenue")
PROFIT_STATUS = ("low_profit", "medium_profit", "high_profit")


def discontinue_candidates(model: RetailModel, revenue_edges: Sequence = (10000, 30000),
                           profit_edges: Sequence = (3, 8), keep_all: bool = False) -> DataFrame:
    """Q39: low-revenue and low-unit-profit products. ``keep_all`` returns every product classified.

    The original computes two aggregations with the same key; here they are one groupBy.
    """
    view = model.view(of="products")
    per = view.groupBy("product_id").agg(
        money_sum(revenue()).alias("total_revenue"),
        ratio(per_line_sum(view, unit_margin()), line_count(view)).alias("profit"))
    per = (per.withColumn("revenue_status", bucketize("total_revenue", revenue_edges, REVENUE_STATUS, False))
              .withColumn("profit_status", bucketize("profit", profit_edges, PROFIT_STATUS, False)))
    names = model.dim("products").select("product_id", "product_name")
    out = names.join(per, "product_id", "inner")
    low = (F.col("profit_status") == PROFIT_STATUS[0]) & (F.col("revenue_status") == REVENUE_STATUS[0])
    return ((out if keep_all else out.filter(low))
            .select("product_name", "total_revenue", "profit", "profit_status", "revenue_status"))


# Fixed labels of the promotion question.
PROMOTION_DECISION = ("promoted", "not promoted")
PROMOTION_PRIORITY = ("PRIORITY 1 - Best margin", "PRIORITY 2 - Great margin", "PRIORITY 3 - Good margin")


@final_order(("margin_profit", False), ("revenue", True), ("product_name", True))
def promotion_candidates(model: RetailModel, max_revenue: float = 50000, min_margin: float = 50,
                         priority_edges: Sequence = (70, 60), keep_all: bool = False) -> DataFrame:
    """Q42: good margin but slow sales. ``keep_all`` returns every product classified."""
    per = model.view(of="products").groupBy("product_name").agg(
        money_sum(revenue()).alias("revenue"), money_sum(profit()).alias("profit"))
    per = per.withColumn("margin_profit", percent(F.col("profit"), F.col("revenue"), 2))
    promoted = (F.col("revenue") < max_revenue) & (F.col("margin_profit") > min_margin)
    per = per.withColumn("decision", F.when(promoted, F.lit(PROMOTION_DECISION[0]))
                         .otherwise(F.lit(PROMOTION_DECISION[1])))
    per = per.withColumn("priority", classify(
        [(F.col("margin_profit") > priority_edges[0], PROMOTION_PRIORITY[0]),
         (F.col("margin_profit") > priority_edges[1], PROMOTION_PRIORITY[1])], PROMOTION_PRIORITY[2]))
    return per if keep_all else per.filter(promoted)
