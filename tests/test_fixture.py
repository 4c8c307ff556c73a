"""Expected results on the micro fixture (read through the CSV path, CRLF line ends)."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.fixture_data import write_fixture
from tillroll.model import RetailModel
from tillroll.operators import quality
from tillroll.operators.periods import trailing_window
from tillroll.plans import inventory, products, sales, seasons, stores


@pytest.fixture(scope="module")
def model(spark):
    p = write_fixture()
    return RetailModel.from_csv(spark, p["sales"], p["products"], p["stores"], p["inventory"])


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_clean_types_and_view(model):
    view = model.sales_view()
    assert view.count() == 8
    assert view.agg(F.max("sales_date")).first()[0] == dt.date(2023, 3, 31)
    types = dict(model.products.dtypes)
    assert types["product_price"] == "decimal(10,2)" and types["product_cost"] == "decimal(10,2)"
    assert dict(model.stores.dtypes)["store_open_date"] == "date"
    prices = rows(model.products, "product_id", "product_price")
    assert prices[0] == (1, Decimal("10.00"))
    dates = dict(rows(model.sales, "sale_id", "sales_date"))
    assert dates[1] == dt.date(2023, 1, 5) and dates[2] == dt.date(2023, 1, 20)


def test_zero_price_audit(model):
    zero = quality.value_check(model.products, "product_price", "==", 0)
    assert [r.product_id for r in zero.collect()] == [4]


def test_trailing_window_strict_and_inclusive(model):
    view = model.sales_view()
    assert trailing_window(view, 90, "day", inclusive=False).count() == 7
    assert trailing_window(view, 90, "day", inclusive=True).count() == 8


def test_q0_both_modes(model):
    aw = rows(inventory.stock_consistency(model, 90, as_written=True),
              "store_name", "total_sales_90d", "current_stock", "stock_consistency_status")
    assert aw == [("North 1", 16, 30, "LOW STOCK - Risk of stockout"),
                  ("South 1", 45, 2440, "OVERSTOCK - Too much inventory")]
    cor = rows(inventory.stock_consistency(model, 90, as_written=False),
               "store_id", "total_sales_90d", "current_stock", "stock_consistency_status")
    assert cor == [(1, 8, 10, "CONSISTENT - Good match"), (2, 15, 610, "OVERSTOCK - Too much inventory")]


def test_q0_rewrite_equals_naive_join(model):
    """The as-written rewrite equals the original many-to-many join, computed naively."""
    view = trailing_window(model.sales_view(), 90, "day", inclusive=False)
    naive = (view.join(model.inventory, "store_id").groupBy("store_name")
             .agg(F.sum("unit").alias("u"), F.sum("stock_on_hand").alias("s")))
    fast = inventory.stock_consistency(model, 90, as_written=True)
    assert rows(naive, "store_name", "u", "s") == rows(fast, "store_name", "total_sales_90d", "current_stock")


def test_q1_q2_q3(model):
    assert rows(sales.revenue_per_year(model), "year", "total") == [(2022, Decimal("30.00")),
                                                                    (2023, Decimal("170.00"))]
    q2 = rows(sales.month_over_month(model), "year", "month", "revenue_per_month", "monthly_change")
    assert q2 == [(2022, 12, Decimal("30.00"), None), (2023, 1, Decimal("40.00"), Decimal("10.00")),
                  (2023, 2, Decimal("50.00"), Decimal("10.00")), (2023, 3, Decimal("40.00"), Decimal("-10.00"))]
    top2 = [(r.product_name, r.revenue) for r in sales.top_products(model, 2).collect()]
    assert top2 == [("Kite", Decimal("80.00")), ("Puzzle", Decimal("60.00"))]


def test_q4_pareto_peers_share(model):
    out = rows(sales.pareto_products(model, 80), "product_name", "cumulative_revenue", "cumulative_percent")
    assert out == [("Puzzle", Decimal("120.00"), 75.0), ("Yo-Yo", Decimal("120.00"), 75.0)]
    crossing = sales.pareto_products(model, 80, include_crossing=True)
    assert crossing.count() == 4  # Kite and Drum share the crossing cumulative value


def test_q10_no_decline(model):
    assert products.declining_products(model, 3).count() == 0


def test_q11_nullif_zero_price(model):
    best = products.best_margin(model, 4).collect()
    assert [(r.product_name, r.profit_margin_percent) for r in best] == [
        ("Yo-Yo", 75), ("Puzzle", 70), ("Kite", 60), ("Drum", None)]


def test_q12_category_price(model):
    assert rows(products.category_price(model), "product_category", "average_per_category") == [
        ("Games", 30.0), ("Outdoor", 10.0), ("Toys", 2.0)]


def test_q14_q17_q18_ties(model):
    assert rows(stores.store_ranking(model), "store_name", "rank_store") == [("North 1", 1), ("South 1", 1)]
    assert stores.store_gap(model).first()[0] == Decimal("0.00")
    assert {r.comparison for r in stores.store_age(model).collect()} == {"Comparison not available"}


def test_q22_trend(model):
    r = seasons.twelve_month_trend(model).first()
    assert (r.latest_revenue, r.earliest_revenue, r.trend) == (Decimal("40.00"), Decimal("30.00"), "increasing")


def test_q25_q26(model):
    assert rows(inventory.stock_status(model, max_stock=500), "product_name", "total_stock") == [
        ("Drum", 7), ("Kite", 13), ("Yo-Yo", 0)]
    assert rows(inventory.overstock(model, 90, 5), "product_name", "total_stock", "units_sold_90d") == [
        ("Puzzle", 600, 2)]


def test_q29_source(model):
    assert rows(inventory.unsold_products(model, 30, "sales"), "product_id") == [(3,)]
    assert rows(inventory.unsold_products(model, 30, "view"), "product_id") == [(1,), (3,)]
    assert rows(inventory.unsold_products(model, 30, "view", method="left_anti"), "product_id") == [(1,), (3,)]


def test_q31_q32_q37(model):
    assert rows(products.rank_in_category(model), "product_category", "product_name", "rank_product_category") == [
        ("Games", "Puzzle", 1), ("Outdoor", "Kite", 1), ("Toys", "Drum", 2), ("Toys", "Yo-Yo", 1)]
    assert rows(stores.top_products_per_store(model, 1), "store_id", "product_name", "revenue") == [
        (1, "Kite", Decimal("30.00")), (1, "Puzzle", Decimal("30.00")), (2, "Yo-Yo", Decimal("40.00"))]
    assert [r.running_total for r in sales.cumulative_months(model).orderBy("year", "month").collect()] == [
        Decimal("30.00"), Decimal("70.00"), Decimal("120.00"), Decimal("160.00")]


def test_quarantine_and_audits(spark):
    p = write_fixture(extra_sales=["10,13/45/2023,1,1,1", "10,3/2/2023,1,2,-1", "11,3/3/2023,,2,1"],
                      extra_products=["5,Bad,Toys,$1.00 ,-$2.00 "])
    from tillroll.operators.cleaning import clean_raw_tables
    from tillroll.sources import delimited
    raw = {"sales": delimited.read_sales(spark, p["sales"]),
           "products": delimited.read_products(spark, p["products"]),
           "stores": delimited.read_stores(spark, p["stores"]),
           "inventory": delimited.read_inventory(spark, p["inventory"])}
    clean, quarantine = clean_raw_tables(raw)
    assert [r.sale_id for r in quarantine["sales"].collect()] == [10]
    assert clean["sales"].count() == 11
    assert rows(quality.duplicate_keys(clean["sales"], "sale_id"), "sale_id", "n_rows") == []
    assert quality.null_keys(clean["sales"], "store_id").count() == 1
    assert quality.value_check(clean["sales"], "unit", "<", 0).count() == 1
    assert rows(quality.value_check(clean["products"], "product_price", "<", 0), "product_id") == [(5,)]
    summary = quality.key_violations(raw["sales"].toDF(*[c.lower() for c in raw["sales"].columns]),
                                     "sale_id", "sales").first()
    assert summary.duplicated_keys == 1 and summary.duplicate_rows == 2
    with pytest.raises(quality.KeyViolation):
        quality.assert_key(raw["sales"].withColumnRenamed("Sale_ID", "sale_id"), "sale_id")


def test_not_in_with_null_is_empty(spark):
    from tillroll.operators.stock import not_in
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    right_null = spark.createDataFrame([(1,), (None,)], "k int")
    right = spark.createDataFrame([(1,)], "k int")
    empty = spark.createDataFrame([], "k int")
    assert not_in(left, right_null, "k").count() == 0
    assert rows(not_in(left, right, "k"), "k") == [(2,)]
    assert not_in(left, empty, "k").count() == 3


def test_q10_zero_fill_reports_falls_to_zero(model):
    got = rows(products.declining_products(model, 3, zero_fill=True),
               "product_name", "month_year", "sales", "previous_month_sales")
    assert got == [("Kite", "2023-03", 0, 2), ("Puzzle", "2023-01", 0, 1), ("Puzzle", "2023-03", 0, 1),
                   ("Yo-Yo", "2023-02", 0, 1)]


def test_q27_zero_fill_and_names(model):
    plain = {r.product_name: r for r in inventory.turnover(model).collect()}
    filled = {r.product_name: r for r in inventory.turnover(model, zero_fill=True).collect()}
    assert plain["Kite"].avg_monthly_sales == 2.0 and filled["Kite"].avg_monthly_sales == 1.0
    assert filled["Kite"].turnover_status == "Slow-moving inventory"
    aw = {r.product_name for r in inventory.turnover(model, as_written=True).collect()}
    assert aw == {"Kite", "Yo-Yo", "Puzzle", "Drum"}


def test_q33_and_q22_flat_label_and_complete_months(model):
    r = seasons.last_month_trend(model).first()
    assert (r.trend, r.last_month, r.previous_month) == ("Decreasing", Decimal("40.00"), Decimal("50.00"))
    full = seasons.twelve_month_trend(model, 12, complete_months_only=True).first()
    assert (full.latest_revenue, full.earliest_revenue) == (Decimal("50.00"), Decimal("30.00"))


def test_many_to_many_sums_equals_join(spark):
    from tillroll.operators.joins import many_to_many_sums
    left = spark.createDataFrame([(1, 2), (1, 3), (2, 5), (3, 1)], "k int, a int")
    right = spark.createDataFrame([(1, 10), (1, 20), (1, 30), (2, 7)], "k int, b int")
    naive = left.join(right, "k").groupBy("k").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    fast = many_to_many_sums(left, right, ["k"], ["a"], ["b"])
    assert rows(fast, "k", "a", "b") == rows(naive, "k", "a", "b")


def test_collation_and_aliases(spark):
    from tillroll.operators.cleaning import replace_values
    from tillroll.operators.grouping import revenue_by
    df = spark.createDataFrame([("Toys", 1, Decimal("2.00")), ("toys", 2, Decimal("2.00"))],
                               "cat string, unit int, product_price decimal(10,2)")
    assert revenue_by(df, "cat").count() == 2
    assert revenue_by(df, "cat", collation="UNICODE_CI_AI").count() == 1
    cities = spark.createDataFrame([("Cuidad de Mexico",), ("Monterrey",)], "store_city string")
    fixed = replace_values(cities, "store_city", {"Cuidad de Mexico": "Ciudad de Mexico"})
    assert rows(fixed, "store_city") == [("Ciudad de Mexico",), ("Monterrey",)]


def test_approximate_variants_run(model):
    med = rows(products.median_daily_sales(model, approximate=True), "product_category", "median")
    exact = rows(products.median_daily_sales(model), "product_category", "median")
    assert [c for c, _ in med] == [c for c, _ in exact]
    from tillroll.plans import stores as st
    approx = rows(st.city_expansion(model, min_profit=None, approximate=True), "store_city", "number_of_stores")
    assert approx == [("North", 1), ("South", 1)]


def test_every_question_runs_on_the_csv_model(model):
    """All registered questions also run on a model built from raw CSV (int keys)."""
    from tillroll.plans.registry import QUESTIONS
    for key, question in QUESTIONS.items():
        question(model).collect()


def test_csv_model_keeps_quarantine(spark):
    p = write_fixture(extra_sales=["30,2/30/2023,1,1,1"])
    m = RetailModel.from_csv(spark, p["sales"], p["products"], p["stores"], p["inventory"])
    assert [r.sale_id for r in m.quarantine["sales"].collect()] == [30]
    assert m.sales.filter(F.col("sale_id") == 30).count() == 0


def test_not_in_non_nullable_right(spark):
    from tillroll.operators.stock import not_in
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    right = spark.createDataFrame([(1,)], "k int")
    empty = spark.createDataFrame([], "k int")
    assert rows(not_in(left, right, "k", right_nullable=False), "k") == [(2,)]
    assert not_in(left, empty, "k", right_nullable=False).count() == 3
