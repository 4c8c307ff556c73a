"""Every question as a callable ``(spark, sf_dir) -> DataFrame`` on the driver's tables.

Thresholds are the original constants where they fit the test tables. Where the test
tables' money scale differs (their prices are ~100x larger), the arguments below keep the
questions selective; every operator keeps the original constants as its defaults.
"""

from __future__ import annotations

import weakref
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillroll.model import RetailModel
from tillroll.plans import audits, drivers, ingest, inventory, products, sales, seasons, stores

_MODELS: "weakref.WeakKeyDictionary[SparkSession, dict[str, tuple]]" = weakref.WeakKeyDictionary()

#: The tables that products and stores are made from.
DIMENSION_TABLES = ("part", "supplier", "nation", "region")


def _listing(spark: SparkSession, sf_dir: str) -> tuple:
    """Name, length and modification time of the files of the dimension tables."""
    found = []
    for table in DIMENSION_TABLES:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{table}.parquet")
        fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if fs.exists(path):
            found += [(f.getPath().toString(), f.getLen(), f.getModificationTime())
                      for f in fs.listStatus(path)]
    return tuple(sorted(found))


def model_for(spark: SparkSession, sf_dir: str) -> RetailModel:
    """One model per (session, folder): dimension size checks and small-dimension caches
    are shared by all questions of a session, until a file of a dimension changes."""
    per_session = _MODELS.setdefault(spark, {})
    key = str(sf_dir).rstrip("/")
    listing = _listing(spark, key)
    model, seen = per_session.get(key, (None, None))
    if model is None or model.sales.sparkSession is not spark or listing != seen:
        if model is not None and model.sales.sparkSession is spark:
            model.release()
        model = RetailModel.from_testdata(spark, key)
        per_session[key] = (model, listing)
    return model


def _without_some_sales(model: RetailModel) -> RetailModel:
    """The model without the sales of every 50th product, so that dead stock is found."""
    return RetailModel(model.sales.filter("product_id % 50 <> 0"), model.products, model.stores, model.inventory)


# key -> (question over a model)
QUESTIONS: dict[str, Callable[[RetailModel], DataFrame]] = {
    "s2": ingest.sales_round_trip,
    "s3": ingest.dimensions_round_trip,
    "s6": ingest.clean_round_trip,
    "s6_bucketed": ingest.bucketed_round_trip,
    "a_damaged": audits.violations,
    "a_keys_damaged": audits.key_constraints,
    "s5": audits.star_view,
    "a1": audits.null_store_keys,
    "a2": audits.null_product_keys,
    "a3": audits.duplicate_store_keys,
    "a4": audits.duplicate_product_keys,
    "a5": audits.duplicate_sale_keys,
    "a6": audits.product_key_check,
    "a7": audits.store_key_check,
    "a8": audits.sale_key_check,
    "a8_appended": ingest.appended_key_audit,
    "a9": audits.zero_prices,
    "a10": audits.negative_prices,
    "a11": audits.negative_units,
    "a12": audits.distinct_units,
    "c1": audits.date_column_added,
    "c2": audits.date_parse_check,
    "c3": audits.date_text_dropped,
    "c4": audits.open_date_cast,
    "c5": audits.cost_text_stripped,
    "c6": audits.price_text_stripped,
    "c7": audits.money_cast,
    "q0_corrected": lambda m: inventory.stock_consistency(m, 90, as_written=False),
    "q0_as_written": lambda m: inventory.stock_consistency(m, 90, as_written=True),
    "q1": sales.revenue_per_year,
    "q2": sales.month_over_month,
    "q3": lambda m: sales.top_products(m, 5),
    "q4": lambda m: sales.pareto_products(m, 80),
    "q5": sales.average_per_order,
    "q6": lambda m: sales.price_band_share(m, (930, 970)),
    "q7": lambda m: products.high_volume_low_profit(m, 900, 250000),
    "q8": lambda m: products.least_sold(m, 10),
    "q9": products.most_profitable_category,
    "q10": lambda m: products.declining_products(m, 3),
    "q11": products.best_margin,
    "q12": products.category_price,
    "q13": stores.best_store,
    "q14": stores.store_ranking,
    "q15": stores.stores_below_average,
    "q16": stores.best_city,
    "q17": stores.store_gap,
    "q18": stores.store_age,
    "q19": sales.month_rank,
    "q20": lambda m: seasons.strong_months(m, k=6, min_years=4),
    "q20_every_year": lambda m: seasons.strong_months(m, k=9),
    "q21": seasons.weekday_rank,
    "q22": lambda m: seasons.twelve_month_trend(m, 12),
    "q23": seasons.peak_seasons,
    "q24": seasons.promotion_timing,
    "q25": lambda m: inventory.stock_status(m, max_stock=500),
    "q25_all": lambda m: inventory.stock_status(m, max_stock=None),
    "q26": lambda m: inventory.overstock(m, 90, 5),
    "q27": lambda m: inventory.turnover(m, 3, 6),
    "q27_dead": lambda m: inventory.turnover(_without_some_sales(m), 3, 6),
    "q28": lambda m: inventory.urgent_reorder(m, 200),
    "q29": lambda m: inventory.unsold_products(m, 90, source="sales"),
    "q30": lambda m: inventory.dead_stock_cost(m, 90, source="view"),
    "q31": products.rank_in_category,
    "q32": lambda m: stores.top_products_per_store(m, 3),
    "q33": seasons.last_month_trend,
    "q34": products.market_share,
    "q35": products.above_average_products,
    "q36": products.median_daily_sales,
    "q36_as_written": lambda m: products.median_daily_sales(m, as_written=True),
    "q37": sales.cumulative_months,
    "q38a": drivers.revenue_by_store_city,
    "q38b": drivers.revenue_by_month_name,
    "q38c": drivers.revenue_by_product,
    "q38d": lambda m: drivers.revenue_by_price_bracket(m, (930, 970, 990)),
    "q38e": lambda m: drivers.revenue_by_cost_bracket(m, (400, 600)),
    "q38f": lambda m: drivers.compare_factors(m, 3),
    "q39": lambda m: products.discontinue_candidates(m, (500000, 1500000), (250, 650)),
    "q39_all": lambda m: products.discontinue_candidates(m, (500000, 1500000), (250, 650), keep_all=True),
    "q40": lambda m: stores.store_review(m, (13500000, 20250000), max_revenue=13500000),
    "q40_all": lambda m: stores.store_review(m, (13500000, 20250000), max_revenue=None),
    "q41": lambda m: stores.city_expansion(m, high=20000000, mid=15000000, low=7500000,
                                           min_profit=15000000),
    "q41_all": lambda m: stores.city_expansion(m, high=20000000, mid=15000000, low=7500000,
                                               min_profit=None),
    "q42": lambda m: products.promotion_candidates(m, 600000, 50),
    "q42_all": lambda m: products.promotion_candidates(m, 600000, 50, keep_all=True),
}


def _bind(question: Callable[[RetailModel], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return question(model_for(spark, sf_dir))
    run.__doc__ = question.__doc__
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {key: _bind(q) for key, q in QUESTIONS.items()}


DESCRIPTIONS: dict[str, str] = {
    "s2": "ingest: raw sales files with broken lines read back, per year and quarantined",
    "s3": "ingest: raw dimension files with broken lines read back",
    "s6": "sink: cleaned tables and rollup written, months rewritten, read back at both grains",
    "s6_bucketed": "sink: sales and products in the same buckets, revenue per product from there",
    "a_damaged": "audits A1-A4, A9-A11 over tables with violations",
    "a_keys_damaged": "key constraints over tables with violations",
    "q27_dead": "inventory turnover where some products have no sale",
    "q39_all": "revenue and profit class of every product",
    "s5": "star view: sales with their store and product",
    "a1": "audit: stores with a NULL key",
    "a2": "audit: products with a NULL key",
    "a3": "audit: duplicated store keys",
    "a4": "audit: duplicated product keys",
    "a5": "audit: duplicated sale keys with their row counts",
    "a6": "key constraint summary: products",
    "a7": "key constraint summary: stores",
    "a8": "key constraint summary: sales",
    "a8_appended": "key constraint summary: sales that come in three appends",
    "a9": "audit: zero prices",
    "a10": "audit: negative prices",
    "a11": "audit: negative quantities",
    "a12": "distinct quantity values",
    "c1": "cleaning: text date parsed next to its text",
    "c2": "cleaning: idempotent date fill, parsed and quarantined counts",
    "c3": "cleaning: sales without the text date",
    "c4": "cleaning: ISO text open dates to dates",
    "c5": "cleaning: currency symbol stripped from cost",
    "c6": "cleaning: currency symbol stripped from price",
    "c7": "cleaning: money text to decimal(10,2)",
    "q0_corrected": "stock vs last-90-day units per store (each side aggregated once)",
    "q0_as_written": "stock vs units per store with the original store-only join (inflated sums)",
    "q1": "revenue per year",
    "q2": "revenue per month and change on the previous month",
    "q3": "top 5 products by revenue",
    "q4": "Pareto: products making up 80 % of revenue",
    "q5": "mean line revenue per order",
    "q6": "revenue and share per price band",
    "q7": "high-volume, low-profit products",
    "q8": "10 least sold products",
    "q9": "most profitable category",
    "q10": "products whose monthly sales fell (last 3 months)",
    "q11": "product with the best mean margin",
    "q12": "mean list price per category",
    "q13": "store with the most revenue",
    "q14": "stores ranked by revenue",
    "q15": "stores below the mean store revenue",
    "q16": "city with the most revenue",
    "q17": "gap between the best and the worst store",
    "q18": "each store vs the store opened before it",
    "q19": "calendar months ranked by revenue",
    "q20": "months in the top k of enough years",
    "q20_every_year": "months in the top k of every year",
    "q21": "weekdays ranked by revenue",
    "q22": "12-month trend: latest vs earliest month",
    "q23": "peak calendar month of each product",
    "q24": "weakest and strongest calendar month",
    "q25": "products at risk of running out of stock",
    "q25_all": "every product's stock risk",
    "q26": "products with stock far above recent sales",
    "q27": "inventory turnover per product",
    "q28": "products needing an urgent reorder",
    "q29": "products unsold in the last 90 days",
    "q30": "cost of unsold stock per store",
    "q31": "product rank by revenue within its category",
    "q32": "top 3 products in each store",
    "q33": "last month vs the month before",
    "q34": "market share of each product",
    "q35": "products above the mean product revenue",
    "q36": "median daily number of sales per category",
    "q36_as_written": "the original's running-count 'median' per category",
    "q37": "running total of monthly revenue",
    "q38a": "revenue per store and city",
    "q38b": "revenue per month name",
    "q38c": "revenue per product",
    "q38d": "revenue per price bracket",
    "q38e": "revenue per cost bracket",
    "q38f": "top 3 stores, months and categories, stacked",
    "q39": "discontinue candidates: low revenue and low unit profit",
    "q40": "store review: revenue, profit, margin, recommendation",
    "q40_all": "store review of every store",
    "q41": "city expansion: statistics, decision and priority",
    "q41_all": "city expansion: every city",
    "q42": "promotion candidates: good margin, slow sales",
    "q42_all": "promotion decision on every product",
}
