"""Sales and products in the same buckets: no shuffle of the fact on the way to a dimension
that is too large to broadcast, hot products apart, the same results."""

import re

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_ORACLE
from tests.oracle_compare import compare
from tests.test_large_path import NO_BROADCAST
from tillroll.model import RetailModel
from tillroll.plans.registry import QUESTIONS
from tillroll.sources import testdata as td
from tillroll.sources.bucketed import HOT_BUCKETS

BUCKETS = 8


def rows(df):
    return sorted(repr(tuple(r)) for r in df.collect())


def with_hot_product(model):
    """Half of all sales are of one product, some of none, some of one that does not exist."""
    n = F.col("sale_id") % 6
    product = (F.when(n < 3, F.lit(7)).when(F.col("sale_id") % 101 == 0, F.lit(None))
               .when(F.col("sale_id") % 103 == 0, F.lit(-5)).otherwise(F.col("product_id")))
    return RetailModel(model.sales.withColumn("product_id", product.cast("int")), model.products, model.stores,
                       model.inventory)


@pytest.fixture(scope="module")
def large(spark):
    """Only the hot products may be broadcast, and the stores where ``stores`` says so."""
    old = {k: spark.conf.get(k, None) for k in NO_BROADCAST}
    for k, v in NO_BROADCAST.items():
        spark.conf.set(k, v)

    def opened(path, stores=True):
        model = RetailModel.from_bucketed(spark, path)
        model.broadcast_max_rows = max(model._size("stores")[0], 1) if stores else 2
        assert not model.is_small("products") and model.is_small("stores") == stores
        return model

    yield opened
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture(scope="module")
def even(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("even"))
    assert RetailModel.from_tables(spark, td.testdata_tables(spark, SF_ORACLE)).write_bucketed(out, BUCKETS) == BUCKETS
    return out


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    model = with_hot_product(RetailModel.from_tables(spark, td.testdata_tables(spark, SF_ORACLE)))
    out = str(tmp_path_factory.mktemp("skewed"))
    model.write_bucketed(out, BUCKETS)
    return model, out


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def above_scan(plan, table):
    """The operators above the scan of a table: its ancestors in the printed tree."""
    lines = plan.split("\n")
    (at,) = [i for i, line in enumerate(lines) if "FileScan" in line and f"/{table}" in line]
    depth = lambda line: re.search(r"[A-Za-z*(]", line).start()
    found, least = [], depth(lines[at])
    for line in reversed(lines[:at]):
        if depth(line) < least:
            least = depth(line)
            found.append(line)
    return found


@pytest.mark.parametrize("pre_aggregate", [True, False])
def test_fact_meets_products_without_exchange(large, even, pre_aggregate):
    model = large(even)
    model.pre_aggregate = pre_aggregate
    above = above_scan(final_plan(QUESTIONS["q38c"](model)), "sales_bucketed")
    join = next(i for i, line in enumerate(above) if "product_id" in line and "Join" in line)
    assert "SortMergeJoin" in above[join] or "ShuffledHashJoin" in above[join]
    assert not any("Exchange" in line for line in above[:join]), above


def test_products_are_not_exchanged(large, even):
    above = above_scan(final_plan(large(even).line_view().groupBy("product_name").count()), "products]")
    join = next(i for i, line in enumerate(above) if "SortMergeJoin" in line or "ShuffledHashJoin" in line)
    assert not any("Exchange" in line for line in above[:join]), above


@pytest.mark.parametrize("stores", [True, False])
@pytest.mark.parametrize("key", ["s5", "q3", "q4", "q7", "q10", "q22", "q30", "q32", "q38c", "q38f", "q39", "q41"])
def test_bucketed_matches_oracle(spark, large, even, key, stores):
    res = compare(spark, SF_ORACLE, [key], verbose=False, model=large(even, stores))[key]
    assert res["ok"], res["problems"]


def test_hot_product_is_kept_apart(spark, large, skewed):
    source, path = skewed
    model = large(path)
    hot = model.dealt.hot
    assert rows(hot.select("product_id").distinct()) == rows(spark.sql("select 7 union all select null"))
    assert model.dealt.hot_products.count() == 1
    largest = model.dealt.cold.groupBy("product_id").count().agg(F.max("count")).first()[0]
    assert largest * BUCKETS <= model.sales.count() * HOT_BUCKETS
    assert rows(model.sales.select("sale_id", "product_id", "unit")) == \
        rows(source.sales.select("sale_id", "product_id", "unit"))
    for key in ("s5", "q2", "q3", "q10", "q30", "q32", "q38c", "q41"):
        assert rows(QUESTIONS[key](model)) == rows(QUESTIONS[key](source)), key


def test_no_sales_and_no_layout(spark, tmp_path):
    model = RetailModel.from_tables(spark, td.testdata_tables(spark, SF_ORACLE))
    with pytest.raises(FileNotFoundError):
        RetailModel.from_bucketed(spark, str(tmp_path / "none"))
    RetailModel(model.sales.limit(0), model.products, model.stores, model.inventory).write_bucketed(
        str(tmp_path / "empty"), 4)
    empty = RetailModel.from_bucketed(spark, str(tmp_path / "empty"))
    empty.broadcast_max_rows = 2
    assert empty.line_view().count() == 0 and QUESTIONS["q38c"](empty).count() == 0


def test_small_products_are_broadcast(spark, even):
    model = RetailModel.from_bucketed(spark, even)
    plain = RetailModel.from_tables(spark, td.testdata_tables(spark, SF_ORACLE))
    assert "SortMergeJoin" not in final_plan(QUESTIONS["q38c"](model))
    assert rows(QUESTIONS["q38c"](model)) == rows(QUESTIONS["q38c"](plain))


def test_catalog_stays_clean(spark, even):
    RetailModel.from_bucketed(spark, even)
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("tillroll_")]
