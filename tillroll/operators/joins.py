"""Join helpers that keep the fact table out of many-to-many expansions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def many_to_many_sums(left: DataFrame, right: DataFrame, keys: Sequence[str],
                      left_sums: Sequence[str], right_sums: Sequence[str],
                      how: str = "inner", left_weight: str | None = None) -> DataFrame:
    """Per key, the sums a many-to-many join ``left JOIN right USING (keys)`` would give,
    without producing the joined rows.

    Over the joined rows of one key, ``sum(l)`` is ``sum_left(l) * rows_right`` and
    ``sum(r)`` is ``sum_right(r) * rows_left``. Each side is aggregated once and the two
    aggregates (one row per key) are joined, so the cost is linear in the inputs even
    when one key holds a third of both sides.
    Output: keys, one column per summed input (same names), ``left_rows``, ``right_rows``.
    ``left_weight`` names a column holding how many original rows each left row stands
    for (a pre-aggregated left side).
    """
    keys = list(keys)
    left_rows = F.sum(left_weight) if left_weight else F.count(F.lit(1))
    la = left.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in left_sums],
                                 left_rows.alias("left_rows"))
    ra = right.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in right_sums],
                                  F.count(F.lit(1)).alias("right_rows"))
    joined = la.join(ra, keys, how)
    return joined.select(
        *keys,
        *[(F.col(c) * F.col("right_rows")).alias(c) for c in left_sums],
        *[(F.col(c) * F.col("left_rows")).alias(c) for c in right_sums],
        "left_rows", "right_rows")


def pre_aggregated_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_aggs: Sequence,
                        right_aggs: Sequence, how: str = "inner") -> DataFrame:
    """Aggregate each side on ``keys`` first, then join the aggregates (one row per key)."""
    keys = list(keys)
    return left.groupBy(*keys).agg(*left_aggs).join(right.groupBy(*keys).agg(*right_aggs), keys, how)
