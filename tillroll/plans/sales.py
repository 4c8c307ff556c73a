"""Sales and revenue questions (Q1-Q6, Q19, Q37)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.measures import revenue
from tillroll.functions.rules import bucketize
from tillroll.model import RetailModel
from tillroll.operators.grouping import avg_per_group, final_order, revenue_by, share_by_bucket, top_k
from tillroll.operators.periods import monthly, period_change
from tillroll.operators.ranking import pareto, rank_groups, running_total

# Price bands of the revenue-distribution question.
PRICE_BAND_EDGES = (10, 30)
PRICE_BAND_LABELS = ("Low price", "Medium price", "High price")


def revenue_per_year(model: RetailModel) -> DataFrame:
    """Q1: from sales x products (not the view), so orphan stores count."""
    return revenue_by(model.sales_with_products("month"),
                      F.year("sales_date").cast("int").alias("year"), "total")


def month_over_month(model: RetailModel, zero_fill: bool = False) -> DataFrame:
    """Q2: monthly revenue and its change on the previous month."""
    return period_change(model.view("month"), "revenue_per_month", "monthly_change", zero_fill)


def top_products(model: RetailModel, k: int = 5) -> DataFrame:
    """Q3: top k products by revenue (sales x products), ties broken by name."""
    per = revenue_by(model.sales_with_products(), "product_name", "revenue")
    return top_k(per, "revenue", k, tie_break=["product_name"])


def pareto_products(model: RetailModel, pct: float = 80, include_crossing: bool = False) -> DataFrame:
    """Q4: products that make up ``pct`` % of revenue (peers share a cumulative value)."""
    per = revenue_by(model.view(of="products"), "product_name", "revenue_per_product")
    return pareto(per, "revenue_per_product", pct, include_crossing,
                  bounded=model.bounded_by("products")).select(
        "product_name", "revenue_per_product", "cumulative_revenue", "total_revenue",
        "cumulative_percent")


def average_per_order(model: RetailModel, order_key: str = "sale_id") -> DataFrame:
    """Q5: mean line revenue per order (always at line grain: needs the order key)."""
    return avg_per_group(model.line_view(), order_key, revenue(), "average_per_order")


@final_order(("total_revenue", False), ("price_range", True))
def price_band_share(model: RetailModel, edges: Sequence = PRICE_BAND_EDGES,
                     labels: Sequence[str] = PRICE_BAND_LABELS) -> DataFrame:
    """Q6: revenue and share of total per price band (upper edges inclusive)."""
    band = bucketize("product_price", edges, labels, right_closed=True)
    return share_by_bucket(model.view(of="products"), band, "price_range", revenue())


def month_rank(model: RetailModel) -> DataFrame:
    """Q19: revenue per calendar month with its rank (12 rows at most)."""
    per = revenue_by(model.view("month"), F.month("sales_date").cast("int").alias("month"),
                     "monthly_revenue")
    return rank_groups(per, [("monthly_revenue", False)], "rank_month", bounded=True)


def cumulative_months(model: RetailModel) -> DataFrame:
    """Q37: running total of monthly revenue (rows bounded by the calendar)."""
    m = monthly(model.view("month"), revenue(), "revenue_per_month")
    return running_total(m, "revenue_per_month", [("year", True), ("month", True)],
                         "running_total", bounded=True).withColumn(
        "running_total", F.col("running_total").cast("decimal(38,2)"))
