"""Inventory operators: stock status, overstock, turnover, unsold items, stock consistency.

Every join here is between pre-aggregated sides (per product or per store), never
between raw fact rows and raw snapshot rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.operators.grouping import final_order
from tillroll.functions.measures import MONEY, ratio
from tillroll.functions.rules import bucketize, classify
from tillroll.model import RetailModel
from tillroll.operators.joins import many_to_many_sums
from tillroll.operators.periods import month_spine, trailing_window


def stock_per_product(model: RetailModel) -> DataFrame:
    """Total stock per product id (one aggregation of the snapshot)."""
    return model.inventory.groupBy("product_id").agg(
        F.sum("stock_on_hand").cast("bigint").alias("total_stock"))


def stock_by_name(model: RetailModel) -> DataFrame:
    """Total stock per product name: aggregate per id first, join names, re-aggregate."""
    per_id = stock_per_product(model)
    named = per_id.join(model.dim("products").select("product_id", "product_name"), "product_id")
    return named.groupBy("product_name").agg(F.sum("total_stock").cast("bigint").alias("total_stock"))


# Fixed values of the stock-risk question.
STOCK_EDGES = (200, 500)
STOCK_LABELS = ("Immediate reorder", "Running out soon", "OK")
REORDER_ACTION = "Need immediate reorder"


def stock_status(model: RetailModel, edges: Sequence[int] = STOCK_EDGES,
                 labels: Sequence[str] = STOCK_LABELS, max_stock: int | None = 500) -> DataFrame:
    """Stock per product with a risk band; keep stock below ``max_stock`` (Q25)."""
    out = stock_by_name(model).withColumn(
        "status", bucketize("total_stock", edges, labels, right_closed=False))
    return out if max_stock is None else out.filter(F.col("total_stock") < max_stock)


def urgent_reorder(model: RetailModel, max_stock: int = 200,
                   action: str = REORDER_ACTION) -> DataFrame:
    """Products with stock below ``max_stock`` and a literal action column (Q28)."""
    return (stock_by_name(model).filter(F.col("total_stock") < max_stock)
            .withColumn("action_required", F.lit(action)))


def units_sold_recent(df: DataFrame, days: int, inclusive: bool = True,
                      key: str = "product_id", months: Iterable[dt.date] | None = None) -> DataFrame:
    recent = trailing_window(df, days, "day", inclusive=inclusive, months=months)
    return recent.groupBy(key).agg(F.sum("unit").cast("bigint").alias("total_sold"))


@final_order(("total_stock", False), ("product_name", True))
def overstock(model: RetailModel, days: int = 90, ratio_limit: int = 5, inclusive: bool = True) -> DataFrame:
    """Products whose stock exceeds ``ratio_limit`` x units sold in the last ``days`` (Q26).

    Sales come from the fact table (orphan stores included); unsold counts as zero.
    """
    sold = units_sold_recent(model.fact(), days, inclusive=inclusive, months=model.months())
    products = model.dim("products").select("product_id", "product_name")
    base = products.join(stock_per_product(model), "product_id", "inner")
    out = base.join(sold, "product_id", "left").withColumn(
        "units_sold_90d", F.coalesce(F.col("total_sold"), F.lit(0)).cast("bigint"))
    return (out.filter(F.col("total_stock") > F.col("units_sold_90d") * ratio_limit)
            .select("product_name", "total_stock", "units_sold_90d"))


# Fixed labels of the turnover question.
TURNOVER_LABELS = ("Fast-moving inventory", "Average turnover", "Slow-moving inventory",
                   "No sales - Dead stock")


def turnover(model: RetailModel, fast: float = 3, slow: float = 6,
             labels: Sequence[str] = TURNOVER_LABELS, as_written: bool = False,
             zero_fill: bool = False) -> DataFrame:
    """Stock / mean monthly units per product with a speed label (Q27).

    The mean ignores months without sales (as the original); ``zero_fill=True`` divides by
    every calendar month of the sales period instead. Corrected mode names dead stock from
    the products table; ``as_written`` leaves its name NULL.
    """
    view = model.view("month")
    # The name depends on the product id: group on the id (an integer) and attach the
    # name once per product afterwards.
    per_month = view.groupBy("product_id", F.year("sales_date").alias("year"),
                             F.month("sales_date").alias("month")).agg(
        F.sum("unit").alias("number_of_sales"))
    if zero_fill:
        months = month_spine(view).agg(F.count(F.lit(1)).alias("n")).scalar()
        per_month_count = months
    else:
        per_month_count = F.count(F.lit(1))
    avg = per_month.groupBy("product_id").agg(
        ratio(F.sum("number_of_sales"), per_month_count).alias("average"))
    stock = stock_per_product(model)
    names = model.dim("products").select("product_id", "product_name")
    joined = stock.join(avg, "product_id", "left").join(names, "product_id", "left")
    if as_written:  # the original takes the name from the sales side: NULL for dead stock
        joined = joined.withColumn("product_name",
                                   F.when(F.col("average").isNotNull(), F.col("product_name")))
    turns = ratio(F.col("total_stock"), F.col("average"))
    label = classify([(turns < fast, labels[0]), (turns.between(fast, slow), labels[1]),
                      (turns > slow, labels[2])], labels[3])
    return joined.select("product_name", "total_stock",
                         F.coalesce(F.col("average"), F.lit(0.0)).alias("avg_monthly_sales"),
                         label.alias("turnover_status"))


def not_in(left: DataFrame, right: DataFrame, key: str, right_nullable: bool = True) -> DataFrame:
    """SQL ``key NOT IN (SELECT key FROM right)``, NULL-aware, without a broadcast.

    A NULL on the right empties the result; a NULL on the left is kept only when the
    right side is empty. The anti join itself is an ordinary (shuffle-able) hash join.
    ``right_nullable=False`` (keys known non-NULL, e.g. inner-join keys) replaces the
    NULL count, a full aggregation of the right side, by an EXISTS that stops at the
    first row.
    """
    rkeys = right.select(F.col(key).alias("__k"))
    if right_nullable:
        # Both guards from one aggregation of the right side (one scalar subquery).
        stats = rkeys.agg(F.struct(F.count_if(F.col("__k").isNull()).alias("nulls"),
                                   F.count(F.lit(1)).alias("rows")).alias("s")).scalar()
        keep = ~(stats.getField("nulls") > 0) & (F.col(key).isNotNull() | (stats.getField("rows") == 0))
    else:
        keep = F.col(key).isNotNull() | ~rkeys.exists()
    anti = left.join(rkeys, left[key] == rkeys["__k"], "left_anti")
    return anti.filter(keep)


def unsold_products(model: RetailModel, days: int = 90, source: str = "sales",
                    method: str = "not_in", inclusive: bool = True) -> DataFrame:
    """Products with no sale in the last ``days`` days (Q29).

    source='sales' judges from the fact table, 'view' from the star view (orphans dropped).
    method='not_in' keeps SQL NOT IN semantics; 'left_anti' ignores NULL keys (null-safe).
    """
    facts = model.fact() if source == "sales" else model.view("day")
    sold = (trailing_window(facts, days, "day", inclusive=inclusive, months=model.months())
            .select("product_id").distinct())
    products = model.products.select("product_id", "product_name")
    if method == "left_anti":
        return products.join(sold, "product_id", "left_anti")
    # keys of the star view come from inner joins: never NULL
    return not_in(products, sold, "product_id", right_nullable=source != "view")


@final_order(("total_dead_stock_cost", False), ("store_id", True))
def dead_stock_cost(model: RetailModel, days: int = 90, source: str = "view",
                    inclusive: bool = True) -> DataFrame:
    """Value (stock x cost) and units of unsold products per store (Q30)."""
    unsold = unsold_products(model, days, source, inclusive=inclusive).select("product_id").distinct()
    cost = model.dim("products").select("product_id", "product_cost")
    inv = model.inventory.join(unsold, "product_id", "inner").join(cost, "product_id", "inner")
    per_store = inv.groupBy("store_id").agg(
        F.sum(F.col("stock_on_hand") * F.col("product_cost")).cast(MONEY).alias("total_dead_stock_cost"),
        F.sum("stock_on_hand").cast("bigint").alias("total_unsold_units"))
    stores = model.dim("stores").select("store_id", "store_name")
    return per_store.join(stores, "store_id", "inner").select(
        "store_name", "store_id", "total_dead_stock_cost", "total_unsold_units")


# Fixed labels of the stock-consistency question.
CONSISTENCY_LABELS = {
    "none": "NO ACTIVITY - Check store",
    "over": "OVERSTOCK - Too much inventory",
    "low": "LOW STOCK - Risk of stockout",
    "ok": "CONSISTENT - Good match",
    "review": "ANALYZE - Further review needed",
}


def _consistency_label(sold: Column, stock: Column, as_written: bool) -> Column:
    L = CONSISTENCY_LABELS
    none = ((sold == 0) | (stock == 0), L["none"])
    over = (stock > sold * 10, L["over"])
    low = (stock < sold * 2, L["low"])
    ok = (sold.between(stock * F.lit(Decimal("0.8")), stock * F.lit(Decimal("1.2"))), L["ok"])
    order = [none, over, low, ok] if as_written else [none, over, ok, low]
    return classify(order, L["review"])


def stock_consistency(model: RetailModel, days: int = 90, as_written: bool = False,
                      inclusive: bool = False) -> DataFrame:
    """Units sold in the last ``days`` days (strict) vs stock on hand, per store (Q0).

    as_written: the original joins sales to the snapshot on store only, so each store's
    sums are multiplied by the other side's row count. That many-to-many join is
    reproduced exactly without materialising it (``many_to_many_sums``): per store,
    sum(unit) x inventory rows and sum(stock) x sales rows. Corrected: each side
    aggregated once, every store kept. ``inclusive`` switches the window to ``>=``.
    """
    view = model.view("day")
    recent = trailing_window(view, days, "day", inclusive=inclusive, months=model.months())
    if as_written:
        names = model.dim("stores").select("store_id", "store_name")
        weight = "lines" if "lines" in recent.columns else None
        fanned = many_to_many_sums(recent.select("store_id", "unit", *([weight] if weight else [])),
                                   model.inventory.select("store_id", "stock_on_hand"),
                                   ["store_id"], ["unit"], ["stock_on_hand"], left_weight=weight)
        out = fanned.join(names, "store_id", "inner").groupBy("store_name").agg(
            F.sum("unit").cast("bigint").alias("total_sales_90d"),
            F.sum("stock_on_hand").cast("bigint").alias("current_stock"))
    else:
        sales = recent.groupBy("store_id").agg(F.sum("unit").cast("bigint").alias("units"))
        stock = model.inventory.groupBy("store_id").agg(F.sum("stock_on_hand").cast("bigint").alias("stock"))
        stores = model.dim("stores").select("store_id", "store_name")
        out = (stores.join(sales, "store_id", "left").join(stock, "store_id", "left")
               .select("store_id", "store_name",
                       F.coalesce("units", F.lit(0)).cast("bigint").alias("total_sales_90d"),
                       F.coalesce("stock", F.lit(0)).cast("bigint").alias("current_stock")))
    return out.withColumn("stock_consistency_status",
                          _consistency_label(F.col("total_sales_90d"), F.col("current_stock"),
                                             as_written))
