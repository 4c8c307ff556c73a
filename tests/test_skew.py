"""A store holding a third of all sales (derived from the driver's tables): the
shuffle-join path and the range-partitioned operators give the same results as the
broadcast path."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_ORACLE
from tillroll.model import RetailModel
from tillroll.plans.registry import QUESTIONS
from tillroll.sources import testdata as td


def skewed_tables(spark):
    tables = td.testdata_tables(spark, SF_ORACLE)
    hot = F.when(F.col("sale_id") % 3 == 0, F.lit(1).cast("bigint")).otherwise(F.col("store_id"))
    tables["sales"] = tables["sales"].withColumn("store_id", hot)
    return tables


@pytest.fixture(scope="module")
def models(spark):
    small = RetailModel.from_tables(spark, skewed_tables(spark))
    large = RetailModel.from_tables(spark, skewed_tables(spark))
    large.broadcast_max_rows = 10
    return small, large


def rows(df):
    return sorted(tuple(r) for r in df.collect())


NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


@pytest.mark.parametrize("key", ["q13", "q14", "q18", "q32", "q38a", "q40", "q41", "q0_corrected"])
def test_hot_store_same_results_both_paths(spark, models, key):
    small, large = models
    want = rows(QUESTIONS[key](small))
    old = {k: spark.conf.get(k, None) for k in NO_BROADCAST}
    for k, v in NO_BROADCAST.items():
        spark.conf.set(k, v)
    try:
        got = rows(QUESTIONS[key](large))
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert got == want



def test_hot_store_join_is_split(spark):
    """With the fact read by several tasks (as any large input is), AQE splits the hot
    store's join partition into several tasks."""
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1024",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1024",
            "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
            **NO_BROADCAST}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        tables = skewed_tables(spark)
        tables["sales"] = tables["sales"].repartition(8)  # several input splits
        model = RetailModel.from_tables(spark, tables)
        model.broadcast_max_rows = 10
        df = model.sales.join(model.dim("stores"), "store_id")
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
