"""Time questions (Q20-Q24, Q33)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.dates import day_name_of
from tillroll.model import RetailModel
from tillroll.operators.grouping import final_order, revenue_by
from tillroll.operators.periods import (
    consistent_top_periods, last_vs_previous, peak_season, promotion_months, trend,
)
from tillroll.operators.ranking import rank_groups


@final_order(("years_in_top_k", False), ("month", True))
def strong_months(model: RetailModel, k: int = 3, min_years: int | None = None) -> DataFrame:
    """Q20: months in the top k of every year (or of at least ``min_years`` years)."""
    return consistent_top_periods(model.view("month"), k, min_years)


def weekday_rank(model: RetailModel) -> DataFrame:
    """Q21: revenue per weekday with its rank (7 rows)."""
    per = revenue_by(model.view("day"), F.dayofweek("sales_date").alias("day_number"), "daily_revenue")
    per = per.select(day_name_of("day_number").alias("day_name"), "daily_revenue")
    return rank_groups(per, [("daily_revenue", False)], "rank_day", bounded=True)


def twelve_month_trend(model: RetailModel, months: int = 12, flat_label: str | None = None,
                       complete_months_only: bool = False) -> DataFrame:
    """Q22: latest vs earliest month revenue of the trailing window."""
    return trend(model.view("day"), months, flat_label, complete_months_only, model.months())


def peak_seasons(model: RetailModel) -> DataFrame:
    """Q23: each product's peak calendar month(s)."""
    return peak_season(model.view("month"), "product_name")


@final_order(("revenue", False), ("month", True))
def promotion_timing(model: RetailModel, as_written: bool = False) -> DataFrame:
    """Q24: weakest and strongest calendar month."""
    return promotion_months(model.view("month"), as_written)


def last_month_trend(model: RetailModel, flat_label: str | None = None) -> DataFrame:
    """Q33: last month vs the month before."""
    return last_vs_previous(model.view("day"), flat_label, model.months())

