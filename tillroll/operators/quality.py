"""Data-quality audits: null keys, duplicate keys, key constraints, value ranges.

Spark enforces no primary key, so a key constraint is an audit: the violations are
computed with one aggregation and only a one-row summary ever reaches the driver.
"""

from __future__ import annotations

import operator as _op
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _cols(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def null_keys(df: DataFrame, cols) -> DataFrame:
    """Rows where any of ``cols`` is NULL (A1, A2)."""
    cond = None
    for c in _cols(cols):
        cond = F.col(c).isNull() if cond is None else (cond | F.col(c).isNull())
    return df.filter(cond)


def duplicate_keys(df: DataFrame, keys) -> DataFrame:
    """Key values that occur more than once, with their row count (A3-A5)."""
    keys = _cols(keys)
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
            .filter(F.col("n_rows") > 1))


def key_violations(df: DataFrame, keys, check: str = "key") -> DataFrame:
    """One-row summary of a (unique, not null) key constraint (A6-A8).

    Columns: check, total_rows, null_key_rows, duplicated_keys, duplicate_rows.
    One groupBy on the key; null keys form their own group, counted separately.
    """
    keys = _cols(keys)
    any_null = None
    for c in keys:
        any_null = F.col(c).isNull() if any_null is None else (any_null | F.col(c).isNull())
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    per_key = per_key.withColumn("is_null", any_null)
    return per_key.agg(
        F.lit(check).alias("check"),
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("total_rows"),
        F.coalesce(F.sum(F.when(F.col("is_null"), F.col("n"))), F.lit(0)).cast("bigint")
        .alias("null_key_rows"),
        F.count(F.when(~F.col("is_null") & (F.col("n") > 1), F.lit(1))).cast("bigint")
        .alias("duplicated_keys"),
        F.coalesce(F.sum(F.when(~F.col("is_null") & (F.col("n") > 1), F.col("n"))), F.lit(0))
        .cast("bigint").alias("duplicate_rows"),
    )


class KeyViolation(ValueError):
    pass


def assert_key(df: DataFrame, keys, check: str = "key") -> DataFrame:
    """Raise ``KeyViolation`` when the key is null or not unique; else return the summary."""
    summary = key_violations(df, keys, check)
    row = summary.first()  # a single aggregated row
    if row["null_key_rows"] or row["duplicated_keys"]:
        raise KeyViolation(f"{check}: {row['null_key_rows']} null-key rows, "
                           f"{row['duplicated_keys']} duplicated keys")
    return summary


_OPS = {"==": _op.eq, "!=": _op.ne, "<": _op.lt, "<=": _op.le, ">": _op.gt, ">=": _op.ge}


def value_check(df: DataFrame, col: str, op: str, bound) -> DataFrame:
    """Rows where ``col <op> bound`` holds (A9-A11: zero / negative price, negative units)."""
    return df.filter(_OPS[op](F.col(col), F.lit(bound)))


def violation_summary(df: DataFrame, check: str) -> DataFrame:
    """One row (check, violations) for an audit result; never an empty frame."""
    return df.agg(F.lit(check).alias("check"), F.count(F.lit(1)).cast("bigint").alias("violations"))


def distinct_values(df: DataFrame, cols) -> DataFrame:
    """Distinct values of one or more columns (A12)."""
    return df.select(*_cols(cols)).distinct()


def audit_all(df: DataFrame, checks: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """Stack several one-row summaries into one frame."""
    out = None
    for name, violations in checks:
        row = violation_summary(violations, name)
        out = row if out is None else out.unionByName(row)
    return out
