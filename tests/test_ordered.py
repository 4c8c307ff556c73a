"""Range-partitioned rank / cumulative sum / lag equal the single-partition windows."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tillroll.operators import ordered


@pytest.fixture(scope="module")
def data(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        grp = "hot" if i % 3 == 0 else f"g{rnd.randint(0, 40)}"   # one group holds a third
        val = 5 if i % 7 == 0 else rnd.randint(0, 200)           # heavy ties
        if i % 97 == 0:
            val = None
        rows.append((i, grp, val))
    return spark.createDataFrame(rows, "id int, grp string, val int").repartition(5)


def collect(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_rank_global(data):
    want = data.withColumn("r", F.rank().over(Window.orderBy(F.col("val").desc_nulls_last())))
    got = ordered.rank(data, [("val", False)], "r")
    assert collect(got, ["id", "r"]) == collect(want, ["id", "r"])


def test_rank_within_hot_group(data):
    w = Window.partitionBy("grp").orderBy(F.col("val").asc_nulls_first())
    want = data.withColumn("r", F.rank().over(w))
    got = ordered.rank(data, [("val", True)], "r", partition=["grp"])
    assert collect(got, ["id", "r"]) == collect(want, ["id", "r"])


def test_cumulative_sum_range_frame(data):
    d = data.fillna(0, ["val"])
    want = d.withColumn("c", F.sum("val").over(Window.orderBy(F.col("val").desc())))
    got = ordered.cumulative_sum(d, "val", [("val", False)], "c")
    assert collect(got, ["id", "c"]) == collect(want, ["id", "c"])


def test_lag_total_order(data):
    want = data.withColumn("p", F.lag("val").over(Window.orderBy("id")))
    got = ordered.lag(data, "val", [("id", True)], "p")
    assert collect(got, ["id", "p"]) == collect(want, ["id", "p"])
    want_d = data.withColumn("p", F.lag("val").over(Window.orderBy(F.col("id").desc())))
    got_d = ordered.lag(data, "val", [("id", False)], "p")
    assert collect(got_d, ["id", "p"]) == collect(want_d, ["id", "p"])


# ---- property tests: random data with ties, NULL values and NULL groups --------------
from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

ROWS = st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]),
                          st.one_of(st.none(), st.integers(min_value=0, max_value=6))),
                min_size=0, max_size=60)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=ROWS, parts=st.integers(min_value=1, max_value=7))
def test_rank_and_running_sum_properties(spark, rows, parts):
    df = spark.createDataFrame([(i, g, v) for i, (g, v) in enumerate(rows)], "id int, grp string, val int")
    df = df.repartition(parts)
    want = df.withColumn("r", F.rank().over(
        Window.partitionBy("grp").orderBy(F.col("val").desc_nulls_last())))
    got = ordered.rank(df, [("val", False)], "r", partition=["grp"])
    assert collect(got, ["id", "r"]) == collect(want, ["id", "r"])
    filled = df.fillna(0, ["val"])
    want_c = filled.withColumn("c", F.sum("val").over(Window.orderBy(F.col("val").asc())))
    got_c = ordered.cumulative_sum(filled, "val", [("val", True)], "c")
    assert collect(got_c, ["id", "c"]) == collect(want_c, ["id", "c"])


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(vals=st.lists(st.one_of(st.none(), st.integers(-5, 5)), min_size=0, max_size=50),
       parts=st.integers(min_value=1, max_value=7), asc=st.booleans())
def test_lag_property(spark, vals, parts, asc):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id int, val int").repartition(parts)
    order = F.col("id").asc() if asc else F.col("id").desc()
    want = df.withColumn("p", F.lag("val").over(Window.orderBy(order)))
    got = ordered.lag(df, "val", [("id", asc)], "p")
    assert collect(got, ["id", "p"]) == collect(want, ["id", "p"])


# ---- split points, exact medians ------------------------------------------------------
def test_ranges_follow_the_order(spark):
    """Many ranges, equal keys in one of them, none holds many times its share."""
    df = spark.range(200_000).select((F.col("id") * 7919 % 200_003).alias("k"), F.concat(F.lit("s"), F.col("id") % 5000).alias("s"))
    for order in ([("k", True)], [("k", False)], [("s", True), ("k", True)], [("s", False), ("k", True)]):
        ranged = ordered.with_range(df, order)
        per = ranged.groupBy(ordered.RANGE).agg(
            F.count(F.lit(1)).alias("n"),
            *[f(F.struct(*[c for c, _ in order[:1 if order[0][1] != order[-1][1] else None]])).alias(n)
              for f, n in ((F.min, "low"), (F.max, "high"))]).orderBy(ordered.RANGE).collect()
        assert len(per) > 700 and max(r.n for r in per) < 12 * 200_000 / ordered.RANGES
        down = not order[0][1]
        for a, b in zip(per, per[1:]):
            assert tuple(a.low) > tuple(b.high) if down else tuple(a.high) < tuple(b.low)


@pytest.mark.parametrize("nulls", [False, True])
def test_median_of_many_values(spark, nulls):
    """A group of a million distinct values, a group of ties, an empty and a NULL group."""
    big = spark.range(1_000_000).select(F.lit("big").alias("g"), (F.col("id") * 48271 % 2147483647).alias("v"))
    few = spark.createDataFrame([("few", 3), ("few", 3), ("few", 9), ("few", 10), ("one", 5), ("none", None),
                                 (None, 1), (None, 2)], "g string, v long")
    df = big.unionByName(few)
    if nulls:
        df = df.withColumn("v", F.when(F.col("v") % 3 != 0, F.col("v")))
    want = {r.g: r.m for r in df.groupBy("g").agg(F.median("v").alias("m")).collect()}
    assert {r.g: r["median"] for r in ordered.median(df, ["g"], "v").collect()} == want
    assert ordered.median(df, [], "v").first()[0] == df.agg(F.median("v")).first()[0]
