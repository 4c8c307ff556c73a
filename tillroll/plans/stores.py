"""Store and city questions (Q13-Q18, Q32, Q40, Q41)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.measures import money_sum, percent, profit, ratio, revenue, round_half_up
from tillroll.functions.rules import bucketize, classify
from tillroll.model import RetailModel
from tillroll.operators import sets
from tillroll.operators.grouping import final_order, revenue_by, spread, top_k, versus_average
from tillroll.operators.ranking import compare_to_previous, rank_groups, top_k_within


def best_store(model: RetailModel, k: int = 1) -> DataFrame:
    """Q13."""
    per = revenue_by(model.view(), "store_name", "revenue_store")
    return top_k(per, "revenue_store", k, tie_break=["store_name"])


def store_ranking(model: RetailModel) -> DataFrame:
    """Q14: every store ranked by revenue.

    A single-task window only when the store count is proven small; otherwise the
    range-partitioned rank."""
    per = revenue_by(model.view(), "store_name", "revenue_store")
    return rank_groups(per, [("revenue_store", False)], "rank_store",
                       bounded=model.bounded_by("stores")).select("store_name", "rank_store")


def stores_below_average(model: RetailModel) -> DataFrame:
    """Q15."""
    per = revenue_by(model.view(), "store_name", "revenue_per_store")
    return versus_average(per, "revenue_per_store", "below", bounded=model.bounded_by("stores"))


def best_city(model: RetailModel, k: int = 1) -> DataFrame:
    """Q16."""
    per = revenue_by(model.view(), "store_city", "total_revenue_per_city")
    return top_k(per, "total_revenue_per_city", k, tie_break=["store_city"])


def store_gap(model: RetailModel) -> DataFrame:
    """Q17: best minus worst store revenue."""
    per = revenue_by(model.view(), "store_name", "revenue_per_store")
    return spread(per, "revenue_per_store", "gap_performance")


# Fixed labels of the store-age question.
AGE_LABELS = ("Newer store sells more", "Older store sells more", "Comparison not available")


def store_age(model: RetailModel) -> DataFrame:
    """Q18: each store vs the store opened just before it (name breaks date ties)."""
    per = revenue_by(model.view(), ["store_name", "store_open_date"], "total_revenue")
    return compare_to_previous(per, "total_revenue", [("store_open_date", True), ("store_name", True)],
                               AGE_LABELS, "comparison", bounded=model.bounded_by("stores"))


def top_products_per_store(model: RetailModel, k: int = 3) -> DataFrame:
    """Q32: top k products in every store, rank ties kept."""
    per = revenue_by(model.view(), ["store_id", "product_name"], "revenue")
    return top_k_within(per, ["store_id"], [("revenue", False)], k, "rank_product")


# Fixed labels of the store-review question.
REVIEW_LABELS = ("Consider closing", "relocated", "keep open")


@final_order(("total_revenue", True), ("store_name", True), ("store_city", True))
def store_review(model: RetailModel, edges: Sequence = (400000, 600000),
                 labels: Sequence[str] = REVIEW_LABELS, max_revenue: float | None = 400000) -> DataFrame:
    """Q40: revenue, profit, margin and a recommendation per store."""
    per = model.view().groupBy("store_name", "store_city").agg(
        money_sum(revenue()).alias("total_revenue"), money_sum(profit()).alias("total_profit"))
    per = (per.withColumn("profit_margin_percent", percent(F.col("total_profit"), F.col("total_revenue"), 2))
              .withColumn("recommendation", bucketize("total_revenue", edges, labels, right_closed=False)))
    return per if max_revenue is None else per.filter(F.col("total_revenue") < max_revenue)


# Fixed labels of the city-expansion question.
EXPANSION_LABELS = (
    "HIGH POTENTIAL - Open new store",
    "GROWTH OPPORTUNITY - Consider expansion",
    "SATURATED - Market may be saturated",
    "MODERATE - Need more analysis",
    "RISKY - Market might be weak",
    "INCONCLUSIVE - Further study needed",
)
PRIORITY_LABELS = ("PRIORITY 1 - High potential", "PRIORITY 2 - Growth opportunity",
                   "PRIORITY 3 - Low priority")


@final_order(("total_profit", False), ("store_city", True))
def city_expansion(model: RetailModel, high: float = 80000, mid: float = 60000, low: float = 30000,
                   few_stores: int = 2, some_stores: int = 3,
                   min_profit: float | None = 60000, approximate: bool = False) -> DataFrame:
    """Q41: city statistics with an expansion decision and a priority.

    Money is summed per store first, where a row is a store, so that only the distinct
    (city, transaction) pairs are shuffled as such: two distinct counts in one aggregation
    would expand every row into three. At daily grain with written sets of sale ids, these are
    merged and no line is read. ``approximate=True`` counts stores and transactions
    with HyperLogLog++ sketches (fixed memory) in one pass instead.
    """
    view = model.line_view()  # distinct transactions need the sale id (line grain)
    stored = model.store_sets("sale")
    if approximate:
        per = view.groupBy("store_city").agg(
            F.approx_count_distinct("store_id").alias("number_of_stores"),
            F.approx_count_distinct("sale_id").alias("number_of_transactions"),
            money_sum(revenue()).alias("total_revenue"),
            money_sum(profit()).alias("total_profit"))
    else:
        per_store = model.view().groupBy("store_city", "store_id").agg(
            money_sum(revenue()).alias("revenue"), money_sum(profit()).alias("profit"))
        money = per_store.groupBy("store_city").agg(
            F.count("store_id").alias("number_of_stores"),
            money_sum(F.col("revenue")).alias("total_revenue"),
            money_sum(F.col("profit")).alias("total_profit"))
        if stored is None:
            transactions = (view.select(F.col("store_city").alias("city"), "sale_id").distinct()
                            .groupBy("city").agg(F.count("sale_id").alias("number_of_transactions")))
        else:
            transactions = sets.count(stored.withColumnRenamed("store_city", "city"), ["city"],
                                      "number_of_transactions")
        per = (money.join(transactions, money["store_city"].eqNullSafe(transactions["city"]), "inner")
               .select("store_city", "number_of_stores", "number_of_transactions", "total_revenue",
                       "total_profit"))
    stores = F.col("number_of_stores")
    prof = F.col("total_profit")
    per = (per
           .withColumn("profit_margin_percent", percent(prof, F.col("total_revenue"), 2))
           .withColumn("avg_revenue_per_store", round_half_up(ratio(F.col("total_revenue"), stores), 2))
           .withColumn("avg_profit_per_store", round_half_up(ratio(prof, stores), 2)))
    decision = classify([
        ((prof > high) & (stores <= few_stores), EXPANSION_LABELS[0]),
        ((prof > mid) & (stores <= some_stores), EXPANSION_LABELS[1]),
        ((prof > mid) & (stores > some_stores), EXPANSION_LABELS[2]),
        (prof.between(low, mid), EXPANSION_LABELS[3]),
        ((prof < low) & (stores >= few_stores), EXPANSION_LABELS[4]),
    ], EXPANSION_LABELS[5])
    priority = classify([
        ((prof > high) & (stores <= few_stores), PRIORITY_LABELS[0]),
        ((prof > mid) & (stores <= some_stores), PRIORITY_LABELS[1]),
    ], PRIORITY_LABELS[2])
    per = per.withColumn("expansion_decision", decision).withColumn("priority", priority)
    return per if min_profit is None else per.filter(prof > min_profit)
