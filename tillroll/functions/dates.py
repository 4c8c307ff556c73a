"""Calendar helpers. Patterns follow Spark's datetime pattern letters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed text format of the raw sales dates: month/day/year, 1- or 2-digit month and day.
US_DATE_PATTERN = "M/d/yyyy"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_us_date(c) -> Column:
    """Text ``m/d/Y`` to DATE; NULL (not an error) for text that does not parse."""
    return F.try_to_date(_col(c), US_DATE_PATTERN)


def month_name(c) -> Column:
    return F.date_format(_col(c), "MMMM")


def day_name(c) -> Column:
    return F.date_format(_col(c), "EEEE")


def month_label(c) -> Column:
    """``yyyy-MM``; sorts correctly as text."""
    return F.date_format(_col(c), "yyyy-MM")


def short_month_label(c) -> Column:
    """``yy-MM`` label. Never sort on it (breaks at a century change); sort on month_start."""
    return F.date_format(_col(c), "yy-MM")


def month_start(c) -> Column:
    return F.trunc(_col(c), "month")


def month_name_of(month_number) -> Column:
    """Name of a calendar month number (1-12). Grouping on the number and naming the
    groups afterwards formats once per group instead of once per row."""
    return month_name(F.make_date(F.lit(2000), _col(month_number), F.lit(1)))


def day_name_of(day_of_week) -> Column:
    """Name of a ``dayofweek`` number (1 = Sunday ... 7 = Saturday).
    2000-01-01 was a Saturday, so day ``d`` after it has ``dayofweek`` ``d``."""
    return day_name(F.date_add(F.lit("2000-01-01").cast("date"), _col(day_of_week)))
