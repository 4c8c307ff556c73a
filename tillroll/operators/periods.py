"""Calendar operators: trailing windows, period change, trends, seasons, medians.

The latest date enters a plan as a literal or a scalar subquery, so the trailing filter is
one distributed filter; the grouped inputs of the windows below are bounded by the
calendar (years x 12 months, 7 weekdays) or partitioned by item with a few months each.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions.dates import month_label, month_name, month_start
from tillroll.functions.measures import line_count, money_sum, ratio, revenue, round_half_up
from tillroll.operators import ordered
from tillroll.operators.ranking import rank_groups
from tillroll.sources.latest import latest_in
from tillroll.sources.schemas import PARTITION_COLUMN


EAGER_CONF = "tillroll.windows.eagerLatest"


def _eager(df: DataFrame) -> bool:
    return df.sparkSession.conf.get(EAGER_CONF, "true").lower() == "true"


def latest_date(df: DataFrame, date_col: str = "sales_date", eager: bool | None = None,
                months: Iterable[dt.date] | None = None) -> Column:
    """The latest date of ``df``.

    Eager (default, ``tillroll.windows.eagerLatest``): the single value enters the plan as a
    literal, so a window filter on it is pushed into the parquet scan (row groups and files
    outside the window are skipped) and partition filters are pruned statically. With
    ``months`` (those that may hold rows, the latest first: ``RetailModel.months()``) only the
    last month's rows are read for it, and earlier ones only where none of them is in ``df``.
    Lazy: a scalar subquery evaluated when the plan runs.
    """
    if eager if eager is not None else _eager(df):
        if months is not None:
            return F.lit(latest_in(df, iter(months), date_col)).cast("date")
        return F.lit(df.agg(F.max(date_col).alias("latest")).first()["latest"]).cast("date")
    if PARTITION_COLUMN in df.columns:
        last_month = df.agg(F.max(PARTITION_COLUMN).alias("m")).scalar()
        df = df.filter(F.col(PARTITION_COLUMN) == last_month)
    return df.agg(F.max(date_col).alias("latest")).scalar()


def _prune_months(df: DataFrame, start: Column) -> DataFrame:
    """Redundant filter on the month partition column: it skips every month directory
    before the window (statically for a literal bound, at runtime for a subquery)."""
    if PARTITION_COLUMN in df.columns:
        return df.filter(F.col(PARTITION_COLUMN) >= F.date_format(start, "yyyy-MM"))
    return df


def window_start(latest: Column, n: int, unit: str) -> Column:
    if unit == "day":
        return F.date_sub(latest, n)
    if unit == "month":
        return F.add_months(latest, -n)  # clamps to month end, like SQL INTERVAL n MONTH
    raise ValueError(f"unknown unit {unit!r}")


def trailing_window(df: DataFrame, n: int, unit: str = "day", inclusive: bool = True,
                    date_col: str = "sales_date", anchor: DataFrame | None = None,
                    complete_months_only: bool = False, eager: bool | None = None,
                    months: Iterable[dt.date] | None = None) -> DataFrame:
    """Rows dated within ``n`` days/months before the latest date of ``anchor`` (default: df).

    inclusive=True keeps ``date >= latest - n`` and False keeps ``date > latest - n``.
    ``eager`` and ``months`` choose how the latest date enters the plan (see ``latest_date``).
    complete_months_only=True keeps the ``n`` whole calendar months before the month of
    the latest date instead (no partial first or last month).
    """
    latest = latest_date(df if anchor is None else anchor, date_col, eager, months)
    d = F.col(date_col)
    if complete_months_only:
        end = month_start(latest)
        start = F.add_months(end, -n)
        return _prune_months(df, start).filter((d >= start) & (d < end))
    start = window_start(latest, n, unit)
    return _prune_months(df, start).filter(d >= start if inclusive else d > start)


def month_spine(df: DataFrame, date_col: str = "sales_date") -> DataFrame:
    """Every calendar month between the first and last date (for zero filling)."""
    bounds = df.agg(month_start(F.min(date_col)).alias("lo"), month_start(F.max(date_col)).alias("hi"))
    months = bounds.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 month"))).alias("m"))
    return months.select(F.year("m").cast("int").alias("year"), F.month("m").cast("int").alias("month"))


def monthly(df: DataFrame, measure: Column, name: str, date_col: str = "sales_date",
            zero_fill: bool = False) -> DataFrame:
    out = df.groupBy(F.year(date_col).cast("int").alias("year"),
                     F.month(date_col).cast("int").alias("month")).agg(money_sum(measure).alias(name))
    if zero_fill:
        out = (month_spine(df, date_col).join(out, ["year", "month"], "left")
               .withColumn(name, F.coalesce(F.col(name), F.lit(0).cast("decimal(38,2)"))))
    return out


def period_change(df: DataFrame, name: str = "revenue_per_month", change: str = "monthly_change",
                  zero_fill: bool = False) -> DataFrame:
    """Monthly revenue and change on the previous month present (Q2)."""
    m = monthly(df, revenue(), name, zero_fill=zero_fill)
    w = Window.orderBy("year", "month")
    return m.withColumn(change, (F.col(name) - F.lag(name).over(w)).cast("decimal(38,2)"))


def declining(df: DataFrame, key: str, months: int = 3, count_name: str = "sales",
              previous_name: str = "previous_month_sales", zero_fill: bool = False,
              complete_months_only: bool = False, stored_months: Iterable[dt.date] | None = None) -> DataFrame:
    """Items whose monthly sale count fell versus their previous month, last ``months`` (Q10).

    By default the previous month is the previous month *present* (gaps are skipped).
    ``zero_fill=True`` compares with the calendar month before, counting an absent month
    as zero (so a fall to zero is reported too). It needs no item x month grid: every
    present month also emits a zero row for the month after it, and summing per
    (item, month) yields exactly the months that matter.
    """
    recent = trailing_window(df, months, "month", inclusive=True,
                             complete_months_only=complete_months_only, months=stored_months)
    per_month = recent.groupBy(key, month_start("sales_date").alias("m")).agg(
        line_count(recent).alias(count_name))
    if zero_fill:
        last = recent.agg(month_start(F.max("sales_date")).alias("v")).scalar()
        shifted = (per_month.select(key, F.add_months("m", 1).alias("m"), F.lit(0).cast("bigint").alias(count_name))
                   .filter(F.col("m") <= last))
        per_month = per_month.unionByName(shifted).groupBy(key, "m").agg(
            F.sum(count_name).cast("bigint").alias(count_name))
        prev = per_month.select(key, F.add_months("m", 1).alias("m"), F.col(count_name).alias(previous_name))
        out = per_month.join(prev, [key, "m"], "left").withColumn(
            previous_name, F.coalesce(F.col(previous_name), F.lit(0).cast("bigint")))
    else:
        w = Window.partitionBy(key).orderBy("m")
        out = per_month.withColumn(previous_name, F.lag(count_name).over(w))
    return (out.filter(F.col(count_name) < F.col(previous_name))
            .select(key, month_label("m").alias("month_year"), count_name, previous_name))


def trend(df: DataFrame, months: int = 12, flat_label: str | None = None,
          complete_months_only: bool = False, stored_months: Iterable[dt.date] | None = None) -> DataFrame:
    """Latest vs earliest month revenue in the last ``months`` months, one row (Q22).

    One aggregation with max_by/min_by instead of repeated ordered subqueries. The
    trailing window covers a partial first and last month (13 calendar months for 12)
    unless ``complete_months_only``. ``flat_label`` names the equal case (else decreasing).
    """
    recent = trailing_window(df, months, "month", inclusive=True,
                             complete_months_only=complete_months_only, months=stored_months)
    # months as their first day: ordered like the 'yyyy-MM' label, no text per row
    per_month = recent.groupBy(month_start("sales_date").alias("month")).agg(
        money_sum(revenue()).alias("revenue"))
    out = per_month.agg(F.max_by("revenue", "month").alias("latest_revenue"),
                        F.min_by("revenue", "month").alias("earliest_revenue"))
    label = F.when(F.col("latest_revenue") > F.col("earliest_revenue"), F.lit("increasing"))
    if flat_label is not None:
        label = label.when(F.col("latest_revenue") == F.col("earliest_revenue"), F.lit(flat_label))
    return out.withColumn("trend", label.otherwise(F.lit("decreasing")))


def peak_season(df: DataFrame, key: str, units: str = "unit") -> DataFrame:
    """Month(s) of highest units per item, if above the item's monthly mean (Q23).

    Months are pooled across years (calendar month). Per item at most 12 rows.
    """
    # Group on the month number (an int); the month name is formatted after aggregation.
    per_month = df.groupBy(key, F.month("sales_date").alias("month_num")).agg(
        F.sum(units).cast("bigint").alias("sales"))
    item = Window.partitionBy(key)
    avg = ratio(F.sum("sales").over(item), F.count(F.lit(1)).over(item))
    above = per_month.withColumn("average", avg).filter(F.col("sales") > F.col("average"))
    ranked = above.withColumn("ranking", F.rank().over(item.orderBy(F.col("sales").desc())))
    return ranked.filter(F.col("ranking") == 1).select(
        key, month_name(F.make_date(F.lit(2000), F.col("month_num"), F.lit(1))).alias("peak_season"),
        F.col("sales").alias("sales_in_peak"),
        round_half_up(F.col("average"), 2).alias("avg_sales"))


def consistent_top_periods(df: DataFrame, k: int = 3, min_years: int | None = None,
                           name: str = "years_in_top_k") -> DataFrame:
    """Calendar months ranked in the top ``k`` of at least ``min_years`` years
    (default: of every year present) (Q20)."""
    per = monthly(df, revenue(), "sales")
    ranked = per.withColumn("ranking", F.rank().over(
        Window.partitionBy("year").orderBy(F.col("sales").desc())))
    counts = ranked.filter(F.col("ranking") <= k).groupBy("month").agg(
        F.count(F.lit(1)).alias(name))
    if min_years is None:
        need = per.agg(F.countDistinct("year").alias("n")).scalar()  # a few years: one tiny job
        return counts.filter(F.col(name) == need)
    return counts.filter(F.col(name) >= F.lit(min_years))


# Fixed labels of the promotion-time question.
PROMOTION_LABELS = ("Run promotion to ATTRACT customers", "Run promotion to BOOST sales")


def promotion_months(df: DataFrame, as_written: bool = False,
                     labels: tuple[str, str] = PROMOTION_LABELS) -> DataFrame:
    """Lowest and highest revenue calendar month (Q24).

    Default keeps rank 1 and the highest rank present; ``as_written`` keeps ranks 1 and 12.
    """
    per = df.groupBy(F.month("sales_date").cast("int").alias("month")).agg(
        money_sum(revenue()).alias("revenue"))
    ranked = rank_groups(per, [("revenue", True)], "ranking", bounded=True)
    # at most 12 rows: the highest rank present is a window over all of them
    top = F.lit(12) if as_written else F.max("ranking").over(Window.partitionBy())
    ranked = ranked.withColumn("__top", top)
    top = F.col("__top")
    labelled = ranked.withColumn(
        "promotion_strategy",
        F.when(F.col("ranking") == 1, F.lit(labels[0])).when(F.col("ranking") == top, F.lit(labels[1])))
    return labelled.filter((F.col("ranking") == 1) | (F.col("ranking") == top)).select(
        "month", "revenue", "promotion_strategy")


def last_vs_previous(df: DataFrame, flat_label: str | None = None,
                     stored_months: Iterable[dt.date] | None = None) -> DataFrame:
    """Revenue of the last month vs the month before it, one row (Q33).

    Months are sorted on their first day (a two-digit year label would break at a
    century change); the two most recent months inside the 2-month trailing window.
    """
    recent = trailing_window(df, 2, "month", inclusive=True, months=stored_months)
    per_month = recent.groupBy(month_start("sales_date").alias("month")).agg(
        money_sum(revenue()).alias("revenue"))
    last_two = per_month.orderBy(F.col("month").desc()).limit(2)
    out = last_two.agg(F.max_by("revenue", "month").alias("last_month"),
                       F.min_by("revenue", "month").alias("previous_month"))
    trend_col = F.when(F.col("last_month") > F.col("previous_month"), F.lit("Increasing"))
    if flat_label is not None:
        trend_col = trend_col.when(F.col("last_month") == F.col("previous_month"), F.lit(flat_label))
    trend_col = trend_col.otherwise(F.lit("Decreasing"))
    return out.select(trend_col.alias("trend"), "last_month", "previous_month")


def median_by(df: DataFrame, part: str, period: str = "sales_date", measure: str = "count",
              as_written: bool = False, name: str = "median", approximate: bool = False,
              selection: bool = False) -> DataFrame:
    """Median of the per-(period, part) measure within each part (Q36).

    measure: 'count' (rows per period) or 'revenue'. The exact median aggregates a
    value->count map per group (partial aggregation, no group collected into a list).
    as_written reproduces the original query's running-count selection; approximate
    uses percentile_approx (bounded memory per group whatever the number of values);
    selection finds the exact median over ranges of the values, without that map.
    """
    value = line_count(df) if measure == "count" else money_sum(revenue())
    per = df.groupBy(period, part).agg(value.alias("number"))
    if approximate:  # fixed-size sketch per group, for very many distinct values
        return per.groupBy(part).agg(F.percentile_approx("number", 0.5).cast("double").alias(name))
    if not as_written:
        if selection:
            return ordered.median(per, [part], "number", name)
        return per.groupBy(part).agg(F.median("number").cast("double").alias(name))
    w = Window.partitionBy(part).orderBy(F.col("number").asc())
    ranked = (per.withColumn("numbering", F.row_number().over(w))
              .withColumn("cnt", F.count(F.lit(1)).over(w)))
    lower = F.floor((F.col("cnt") + 1) / 2)
    slipped = F.floor(F.col("cnt") + F.lit(2) / 2)  # the original's parenthesis slip: cnt + 1
    chosen = ranked.filter((F.col("numbering") == lower) | (F.col("numbering") == slipped))
    return chosen.groupBy(part).agg(ratio(F.sum("number"), F.count(F.lit(1))).alias(name))


def factor_compare(df: DataFrame, factors: dict, measure: Column, k: int = 3,
                   one_scan: bool = True) -> DataFrame:
    """Top ``k`` values of several factors by ``measure``, stacked (Q38f).

    One scan (default): GROUPING SETS over the factor expressions; ``grouping_id`` says
    which factor a row belongs to, so a NULL factor value cannot be mistaken for another
    set. ``one_scan=False`` is the plain form: one aggregation per factor, stacked with
    ``unionByName`` (one scan of ``df`` per factor).
    A factor is a Column, or a (key Column, label function) pair: the rows are grouped
    on the key and the label is computed once per group.
    """
    names = list(factors)
    keys = {n: (f[0] if isinstance(f, tuple) else f) for n, f in factors.items()}
    labellers = {n: f[1] for n, f in factors.items() if isinstance(f, tuple)}
    if not one_scan:
        stacked = None
        for nm in names:
            per = df.groupBy(keys[nm].alias("__key")).agg(money_sum(measure).alias("revenue"))
            label = labellers[nm](F.col("__key")) if nm in labellers else F.col("__key")
            part = per.select(F.lit(nm).alias("factor"), label.cast("string").alias("top_value"), "revenue")
            stacked = part if stacked is None else stacked.unionByName(part)
        w = Window.partitionBy("factor").orderBy(F.col("revenue").desc())
        return stacked.withColumn("rank_in_factor", F.rank().over(w)).filter(F.col("rank_in_factor") <= k)
    cols = [keys[n].alias(f"__f{i}") for i, n in enumerate(names)]
    keyed = df.select(*cols, measure.alias("__m"))
    sets = [[F.col(f"__f{i}")] for i in range(len(names))]
    grouped = (keyed.groupingSets(sets, *[F.col(f"__f{i}") for i in range(len(names))])
               .agg(F.grouping_id().alias("__gid"), money_sum("__m").alias("revenue")))
    n = len(names)
    factor = None
    value = None
    for i, nm in enumerate(names):
        gid = (1 << n) - 1 - (1 << (n - 1 - i))  # all bits set except this column's
        hit = F.col("__gid") == gid
        factor = F.when(hit, F.lit(nm)) if factor is None else factor.when(hit, F.lit(nm))
        v = (labellers[nm](F.col(f"__f{i}")) if nm in labellers else F.col(f"__f{i}")).cast("string")
        value = F.when(hit, v) if value is None else value.when(hit, v)
    stacked = grouped.select(factor.alias("factor"), value.alias("top_value"), "revenue")
    w = Window.partitionBy("factor").orderBy(F.col("revenue").desc())
    ranked = stacked.withColumn("rank_in_factor", F.rank().over(w))
    return ranked.filter(F.col("rank_in_factor") <= k)

