"""Grouped measures and comparisons against a scalar (total, mean, max/min).

Scalars come from ``DataFrame.scalar()`` - an uncorrelated scalar subquery that Spark
evaluates once as its own job and substitutes into the plan - or, when the grouped rows
are provably few, from a window over them in the same pass. Never a cross join.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions.measures import money_sum, percent, ratio, revenue, round_half_up
from tillroll.operators.ordered import sort_exprs


def final_order(*order: tuple[str, bool]):
    """A question's rows come in this order: (column, ascending) pairs, the last ones making
    it unique. A range sort of the (grouped) result; NULLs first ascending, last descending."""
    def wrap(question):
        @functools.wraps(question)
        def run(*args, **options) -> DataFrame:
            return question(*args, **options).orderBy(*sort_exprs(order))
        return run
    return wrap


def _keys(keys) -> list:
    return [keys] if isinstance(keys, (str, Column)) else list(keys)


def revenue_by(df: DataFrame, keys, name: str = "revenue", measure: Column | None = None,
               collation: str | None = None) -> DataFrame:
    """``sum(unit * price)`` per group as decimal(38,2) (Q1, Q38a-e and most questions).

    ``collation`` (e.g. ``"UNICODE_CI_AI"``) groups string keys case- and accent-
    insensitively, like a case-insensitive SQL server collation; default is binary.
    """
    m = revenue() if measure is None else measure
    ks = _keys(keys)
    if collation is not None:
        ks = [F.collate(F.col(k), collation).alias(k) if isinstance(k, str) else k for k in ks]
    return df.groupBy(*ks).agg(money_sum(m).alias(name))


def top_k(df: DataFrame, by: str, k: int, ascending: bool = False,
          tie_break: Sequence[str] = ()) -> DataFrame:
    """First ``k`` rows by ``by`` with an explicit tie-break (TakeOrderedAndProject:
    each task keeps its own top k, only k rows per task are merged)."""
    first = F.col(by).asc_nulls_first() if ascending else F.col(by).desc_nulls_last()
    return df.orderBy(first, *[F.col(c).asc_nulls_first() for c in tie_break]).limit(k)


def scalar_of(df: DataFrame, agg: Column) -> Column:
    """An aggregate of ``df`` as a scalar-subquery Column."""
    return df.agg(agg.alias("value")).scalar()


def over_all(df: DataFrame, agg: Column, bounded: bool) -> Column:
    """An aggregate over all rows of an already grouped frame, as a column of it.

    bounded=True (row count proven small: calendar groups, or groups of a dimension that
    passed the counted size check): a window over the whole frame, computed in the same
    pass. Otherwise a scalar subquery, which Spark runs as its own (distributed) job.
    """
    return agg.over(Window.partitionBy()) if bounded else scalar_of(df, agg)


def exact_mean_of(df: DataFrame, col: str) -> Column:
    """Mean of a column as double from its exact sum and count."""
    return df.agg(ratio(F.sum(col), F.count(col)).alias("value")).scalar()


def versus_average(df: DataFrame, measure: str, side: str = "above",
                   round_digits: int | None = None, bounded: bool = False) -> DataFrame:
    """Rows whose ``measure`` is above / below the mean of ``measure`` (Q15, Q35)."""
    if bounded:
        mean = ratio(F.sum(measure).over(Window.partitionBy()), F.count(measure).over(Window.partitionBy()))
    else:
        mean = exact_mean_of(df, measure)
    if round_digits is not None:
        mean = round_half_up(mean, round_digits)
    value = F.col(measure).cast("double")
    with_mean = df.withColumn("__mean", mean)
    keep = value > F.col("__mean") if side == "above" else value < F.col("__mean")
    return with_mean.filter(keep).drop("__mean")


def spread(df: DataFrame, measure: str, name: str = "spread") -> DataFrame:
    """``max - min`` of a grouped measure as one row (Q17)."""
    return df.agg((F.max(measure) - F.min(measure)).alias(name))


def share_of_total(df: DataFrame, measure: str, name: str = "share_percent",
                   digits: int | None = 2, bounded: bool = False) -> DataFrame:
    """Each row's percentage of the column total (Q34)."""
    total = over_all(df, F.sum(measure), bounded)
    return df.withColumn(name, percent(F.col(measure), total, digits))


def share_by_bucket(df: DataFrame, bucket: Column, bucket_name: str, measure: Column,
                    total_name: str = "total_revenue", share_name: str = "percentage_of_total",
                    digits: int = 2) -> DataFrame:
    """Measure and share of total per band (Q6). The total is a scalar over the banded
    rows' sum (the same scan, evaluated as a subquery)."""
    grouped = df.groupBy(bucket.alias(bucket_name)).agg(money_sum(measure).alias(total_name))
    total = over_all(grouped, F.sum(total_name), bounded=True)  # one row per band
    return grouped.withColumn(share_name, percent(F.col(total_name), total, digits))


def mean_by(df: DataFrame, keys, col: str, name: str, digits: int | None = 2) -> DataFrame:
    """Exact mean per group as double (Q12): sum / count, then half-up rounding."""
    m = ratio(F.sum(col), F.count(col))
    return df.groupBy(*_keys(keys)).agg((round_half_up(m, digits) if digits is not None else m)
                                        .alias(name))


avg_by = mean_by  # the name used for the category price question


def revenue_by_bucket(df: DataFrame, col: str, edges, labels, right_closed: bool = False,
                      bucket_name: str = "bucket", name: str = "revenue") -> DataFrame:
    """Revenue per band of ``col`` (Q38d, Q38e): ``bucketize`` then ``revenue_by``."""
    from tillroll.functions.rules import bucketize
    return revenue_by(df, bucketize(col, edges, labels, right_closed).alias(bucket_name), name)


def avg_per_group(df: DataFrame, keys, measure: Column, name: str) -> DataFrame:
    """Mean of a per-row measure within each group (Q5)."""
    return df.groupBy(*_keys(keys)).agg(ratio(F.sum(measure), F.count(F.lit(1))).alias(name))
