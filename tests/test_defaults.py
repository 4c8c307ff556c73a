"""Operator defaults and options that the driver keys do not exercise."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_ORACLE
from tillroll.plans import inventory, products, sales, seasons
from tillroll.plans.registry import model_for


@pytest.fixture(scope="module")
def model(spark):
    return model_for(spark, SF_ORACLE)


def test_strong_months_reference_default(model):
    # k=3 in every one of the years present: none of the test months qualifies
    assert seasons.strong_months(model).count() == 0
    # k=12: every month present in every year; the data ends in November of its last
    # year, so December is missing there
    assert seasons.strong_months(model, k=12).count() == 11


def test_promotion_timing_modes(model):
    default = seasons.promotion_timing(model).collect()
    assert {r.promotion_strategy for r in default} == {"Run promotion to ATTRACT customers",
                                                      "Run promotion to BOOST sales"}
    literal = seasons.promotion_timing(model, as_written=True).collect()
    assert len(literal) == 2  # 12 distinct calendar months: rank 12 exists


def test_median_by_revenue_and_approximate(model):
    by_rev = products.median_daily_sales(model, measure="revenue").collect()
    assert len(by_rev) == 6 and all(r["median"] > 0 for r in by_rev)
    exact = {r.product_category: r["median"] for r in products.median_daily_sales(model).collect()}
    approx = {r.product_category: r["median"] for r in products.median_daily_sales(model, approximate=True).collect()}
    assert exact.keys() == approx.keys()
    assert all(abs(exact[k] - approx[k]) <= 1 for k in exact)


def test_stock_consistency_inclusive_window(model):
    strict = {r.store_id: r.total_sales_90d for r in inventory.stock_consistency(model, 90).collect()}
    incl = {r.store_id: r.total_sales_90d for r in inventory.stock_consistency(model, 90, inclusive=True).collect()}
    assert all(incl[k] >= strict[k] for k in strict) and sum(incl.values()) >= sum(strict.values())


def test_pareto_crossing_adds_one_group(model):
    kept = sales.pareto_products(model, 80)
    crossing = sales.pareto_products(model, 80, include_crossing=True)
    extra = crossing.subtract(kept)
    assert extra.count() >= 1
    assert extra.agg(F.min("cumulative_percent")).first()[0] > 80.0
    assert extra.select("cumulative_revenue").distinct().count() == 1


def test_unsold_methods_agree_without_nulls(model):
    a = {r.product_id for r in inventory.unsold_products(model, 90).collect()}
    b = {r.product_id for r in inventory.unsold_products(model, 90, method="left_anti").collect()}
    assert a == b and len(a) == 683


def test_inclusive_windows_on_stock_questions(model):
    incl = inventory.overstock(model, 90, 5).count()
    strict = inventory.overstock(model, 90, 5, inclusive=False).count()
    assert strict >= incl  # fewer sales counted -> at least as many overstocked products
    a = inventory.dead_stock_cost(model, 90).agg(F.sum("total_unsold_units")).first()[0]
    b = inventory.dead_stock_cost(model, 90, inclusive=False).agg(F.sum("total_unsold_units")).first()[0]
    assert b >= a


def test_factor_compare_union_form_equals_one_scan(model):
    from tillroll.plans import drivers
    a = sorted(tuple(r) for r in drivers.compare_factors(model).collect())
    b = sorted(tuple(r) for r in drivers.compare_factors(model, one_scan=False).collect())
    assert a == b and len(a) == 9
