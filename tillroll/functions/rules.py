"""Ordered first-match rules: the ``CASE WHEN`` chains of the business questions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def classify(rules: Sequence[tuple[Column, str]], default: str | None = None) -> Column:
    """First rule whose condition holds wins; ``default`` when none does (NULL if None)."""
    if not rules:
        return F.lit(default)
    expr = None
    for cond, label in rules:
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(default))


def bucketize(col, edges: Sequence, labels: Sequence[str], right_closed: bool = True) -> Column:
    """Map a value to a band. ``len(labels) == len(edges) + 1``.

    right_closed=True  -> value <= edge[i] gets labels[i]
    right_closed=False -> value <  edge[i] gets labels[i]
    The last label catches everything else (including NULL, like SQL's ELSE).
    """
    if len(labels) != len(edges) + 1:
        raise ValueError("bucketize needs exactly one more label than edges")
    c = F.col(col) if isinstance(col, str) else col
    rules = [((c <= F.lit(e)) if right_closed else (c < F.lit(e)), lab)
             for e, lab in zip(edges, labels)]
    return classify(rules, labels[-1])
