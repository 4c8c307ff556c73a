"""Invariants across questions on the driver's sf0.01 tables."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_ORACLE
from tillroll.operators.periods import trailing_window
from tillroll.plans.registry import QUESTIONS, model_for


@pytest.fixture(scope="module")
def model(spark):
    return model_for(spark, SF_ORACLE)


@pytest.fixture(scope="module")
def total(model):
    return model.sales_view().agg(F.sum(F.col("unit") * F.col("product_price"))).first()[0]


def col_sum(df, col):
    return df.agg(F.sum(col)).first()[0]


def test_breakdowns_add_up_to_view_total(model, total):
    for key in ("q38a", "q38b", "q38c", "q38d", "q38e"):
        assert col_sum(QUESTIONS[key](model), "revenue") == total, key
    assert col_sum(QUESTIONS["q6"](model), "total_revenue") == total
    assert col_sum(QUESTIONS["q2"](model), "revenue_per_month") == total


def test_last_running_total_is_total(model, total):
    last = QUESTIONS["q37"](model).orderBy(F.col("year").desc(), F.col("month").desc()).first()
    assert last.running_total == total


def test_shares_sum_to_100(model):
    shares = QUESTIONS["q34"](model)
    n = shares.count()
    assert abs(col_sum(shares, "market_share_percent") - 100.0) <= 0.005 * n + 1e-9
    bands = QUESTIONS["q6"](model)
    assert abs(col_sum(bands, "percentage_of_total") - 100.0) <= 0.005 * bands.count() + 1e-9


def test_every_category_has_rank_one(model):
    ranked = QUESTIONS["q31"](model)
    cats = ranked.select("product_category").distinct().count()
    assert ranked.filter(F.col("rank_product_category") == 1).select("product_category").distinct().count() == cats


def test_reorder_subset_of_stock_risk(model):
    q28 = {r.product_name for r in QUESTIONS["q28"](model).collect()}
    q25 = {r.product_name for r in QUESTIONS["q25"](model).collect()}
    assert q28 and q28 <= q25


def test_unsold_and_sold_partition_products(model):
    unsold = {r.product_id for r in QUESTIONS["q29"](model).collect()}
    sold = {r.product_id for r in trailing_window(model.sales, 90, "day").select("product_id").distinct().collect()}
    every = {r.product_id for r in model.products.select("product_id").collect()}
    assert unsold.isdisjoint(sold) and unsold | sold == every


def test_q0_as_written_equals_naive_join(model):
    recent = trailing_window(model.sales_view(), 90, "day", inclusive=False)
    naive = (recent.join(model.inventory, "store_id").groupBy("store_name")
             .agg(F.sum("unit").alias("u"), F.sum("stock_on_hand").alias("s")))
    want = sorted((r.store_name, r.u, r.s) for r in naive.collect())
    got = sorted((r.store_name, r.total_sales_90d, r.current_stock) for r in QUESTIONS["q0_as_written"](model).collect())
    assert got == want


def test_pareto_cutoff(model):
    kept = QUESTIONS["q4"](model)
    assert kept.agg(F.max("cumulative_percent")).first()[0] <= 80.0
    per = QUESTIONS["q38c"](model)
    kept_revenue = col_sum(kept, "revenue_per_product")
    smallest_kept = kept.agg(F.min("revenue_per_product")).first()[0]
    # every product with more revenue than the smallest kept one is kept as well
    assert per.filter(F.col("revenue") > smallest_kept).count() <= kept.count()
    assert kept_revenue <= col_sum(per, "revenue") * Decimal("0.8") + Decimal("0.01")
