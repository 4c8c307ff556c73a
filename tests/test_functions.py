"""Column builders: bands, ordered rules, rounding, ratios, date parsing."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillroll.functions import bucketize, classify, parse_us_date, ratio, round_half_up


def values(spark, col, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(col.alias("v")).collect()]


def test_bucketize_edges_and_null(spark):
    data = [(Decimal("10.00"),), (Decimal("10.01"),), (Decimal("30.00"),), (Decimal("99"),), (None,)]
    closed = values(spark, bucketize("p", (10, 30), ("L", "M", "H"), right_closed=True), data, "p decimal(10,2)")
    assert closed == ["L", "M", "M", "H", "H"]  # NULL falls to ELSE, as in SQL
    open_ = values(spark, bucketize("p", (10, 30), ("L", "M", "H"), right_closed=False), data, "p decimal(10,2)")
    assert open_ == ["M", "M", "H", "H", "H"]
    with pytest.raises(ValueError):
        bucketize("p", (10,), ("only",))


def test_classify_first_match_wins(spark):
    x = F.col("x")
    rule = classify([(x > 5, "big"), (x > 1, "mid")], "small")
    assert values(spark, rule, [(9,), (3,), (0,), (None,)], "x int") == ["big", "mid", "small", "small"]
    assert values(spark, classify([(x > 5, "big")]), [(1,)], "x int") == [None]


def test_round_half_up_is_plain_arithmetic(spark):
    import math
    xs = [1.005, 2.675, 0.125, -0.125, 12.345, 1e-9]
    got = values(spark, round_half_up("x", 2), [(x,) for x in xs] + [(None,)], "x double")
    # the same IEEE operations in any engine (here: Python) give the same bits
    assert got == [math.floor(x * 100.0 + 0.5) / 100.0 for x in xs] + [None]
    assert got[0] == 1.0  # 1.005 is stored just below the tie: half-up of the stored value
    assert values(spark, round_half_up("x", 0), [(2.5,), (3.49,)], "x double") == [3, 3]


def test_ratio_null_on_zero(spark):
    got = values(spark, ratio("a", "b"), [(1, 4), (1, 0), (None, 2)], "a int, b int")
    assert got == [0.25, None, None]


def test_parse_us_date(spark):
    import datetime as dt
    data = [("1/5/2023",), ("01/20/2023",), ("13/45/2023",), ("2023-01-05",), (None,)]
    assert values(spark, parse_us_date("t"), data, "t string") == [
        dt.date(2023, 1, 5), dt.date(2023, 1, 20), None, None, None]


def test_names_from_numbers_match_dates(spark):
    import datetime as dt
    from tillroll.functions.dates import day_name, day_name_of, month_name, month_name_of
    days = [(dt.date(2023, 1, 1) + dt.timedelta(days=i),) for i in range(400)]
    df = spark.createDataFrame(days, "d date")
    bad = df.filter((month_name_of(F.month("d")) != month_name("d"))
                    | (day_name_of(F.dayofweek("d")) != day_name("d")))
    assert bad.count() == 0
