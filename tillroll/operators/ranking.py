"""Ranks, running totals, Pareto, lag comparisons.

Each operator takes a ``bounded`` flag. ``bounded=True`` is for inputs with a proven
small row count: fixed by the calendar (months, weekdays, years x 12), or one row per
member of a dimension that passed the counted size check (``RetailModel.bounded_by``).
A plain window is then the cheapest plan. Otherwise (anything that grows with the data)
the range-partitioned operators of :mod:`tillroll.operators.ordered` are used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions.measures import percent
from tillroll.operators import ordered
from tillroll.operators.grouping import over_all, scalar_of


def _w(order, partition=()):
    w = Window.orderBy(*ordered.sort_exprs(order))
    return w.partitionBy(*partition) if partition else w


def rank_groups(df: DataFrame, order: Sequence[tuple[str, bool]], name: str = "rank",
                bounded: bool = False) -> DataFrame:
    """Global ``rank()`` over ``order`` (Q14, Q19, Q21, Q24)."""
    if bounded:
        return df.withColumn(name, F.rank().over(_w(order)))
    return ordered.rank(df, order, name)


def rank_within(df: DataFrame, partition: Sequence[str], order: Sequence[tuple[str, bool]],
                name: str = "rank", bounded: bool = False) -> DataFrame:
    """``rank() OVER (PARTITION BY partition ORDER BY order)`` (Q31).

    Unbounded groups go through the range-partitioned rank, so one group holding a
    third of the rows is still spread over many tasks.
    """
    if bounded:
        return df.withColumn(name, F.rank().over(_w(order, partition)))
    return ordered.rank(df, order, name, partition=partition)


def top_k_within(df: DataFrame, partition: Sequence[str], order: Sequence[tuple[str, bool]],
                 k: int, name: str = "rank") -> DataFrame:
    """Rows ranked ``<= k`` inside each group, ties kept (Q32, Q38f).

    Spark plans a WindowGroupLimit before and after the shuffle: each map task keeps only
    the top k (plus ties) of every group, so a hot group ships k rows per task.
    """
    ranked = df.withColumn(name, F.rank().over(_w(order, partition)))
    return ranked.filter(F.col(name) <= k)


def running_total(df: DataFrame, value: str, order: Sequence[tuple[str, bool]], name: str,
                  bounded: bool = False) -> DataFrame:
    """``sum(value) OVER (ORDER BY order)``, RANGE frame (peers share the total) (Q37)."""
    if bounded:
        return df.withColumn(name, F.sum(value).over(_w(order)))
    return ordered.cumulative_sum(df, value, order, name)


def pareto(df: DataFrame, value: str, pct: float = 80.0, include_crossing: bool = False,
           cumulative_name: str = "cumulative_revenue", total_name: str = "total_revenue",
           percent_name: str = "cumulative_percent", bounded: bool = False) -> DataFrame:
    """Items by descending ``value`` with cumulative share; keep cumulative % <= pct (Q4).

    ``include_crossing=True`` also keeps the first item group that crosses ``pct``.
    """
    order = [(value, False)]
    if bounded:
        with_cum = running_total(df, value, order, cumulative_name, bounded=True)
    else:
        with_cum = ordered.cumulative_sum(df, value, order, cumulative_name)
    total = over_all(df, F.sum(value), bounded)
    out = (with_cum.withColumn(total_name, total)
           .withColumn(percent_name, percent(F.col(cumulative_name), F.col(total_name), 2)))
    if not include_crossing:
        return out.filter(F.col(percent_name) <= F.lit(float(pct)))
    # Keep everything up to and including the first cumulative value reaching pct.
    crossing = scalar_of(out.filter(F.col(percent_name) > F.lit(float(pct))),
                         F.min(cumulative_name))
    return out.filter((F.col(percent_name) <= F.lit(float(pct)))
                      | (F.col(cumulative_name) == crossing))


def lag_over(df: DataFrame, value: str, order: Sequence[tuple[str, bool]], name: str,
             partition: Sequence[str] = (), bounded: bool = False) -> DataFrame:
    """``lag(value) OVER ([PARTITION BY] ORDER BY order)``."""
    if bounded or partition:
        return df.withColumn(name, F.lag(value).over(_w(order, partition)))
    return ordered.lag(df, value, order, name)


def compare_to_previous(df: DataFrame, value: str, order: Sequence[tuple[str, bool]],
                        labels: tuple[str, str, str], name: str = "comparison",
                        bounded: bool = False) -> DataFrame:
    """Compare each row with the previous one in ``order`` (Q18).

    labels = (current is larger, current is smaller, no comparison / equal).
    """
    prev = "__previous"
    out = lag_over(df, value, order, prev, bounded=bounded)
    label = (F.when(F.col(value) > F.col(prev), F.lit(labels[0]))
             .when(F.col(value) < F.col(prev), F.lit(labels[1]))
             .otherwise(F.lit(labels[2])))
    return out.withColumn(name, label).drop(prev)
