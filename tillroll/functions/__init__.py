"""Column-level building blocks (all JVM-side ``pyspark.sql.functions``)."""

from tillroll.functions.measures import (
    LINES, MONEY, line_count, money, money_sum, per_line_sum, percent, profit, ratio, revenue,
    round_half_up, unit_margin,
)
from tillroll.functions.rules import bucketize, classify
from tillroll.functions.dates import (
    day_name, month_label, month_name, month_start, parse_us_date, short_month_label,
)

__all__ = [
    "LINES", "MONEY", "line_count", "money", "money_sum", "per_line_sum", "percent", "profit", "ratio",
    "revenue", "round_half_up", "unit_margin",
    "bucketize", "classify", "day_name", "month_label", "month_name", "month_start",
    "parse_us_date", "short_month_label",
]
