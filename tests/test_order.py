"""The questions whose rows come in a stated order."""

import pytest

from tests.conftest import SF_SMALL
from tillroll.plans.registry import queries

ORDER = {
    "q6": [("total_revenue", False)], "q7": [("total_units_sold", False)], "q12": [("average_per_category", False)],
    "q20": [("years_in_top_k", False), ("month", True)], "q20_every_year": [("years_in_top_k", False), ("month", True)],
    "q24": [("revenue", False)], "q26": [("total_stock", False), ("product_name", True)],
    "q30": [("total_dead_stock_cost", False), ("store_id", True)], "q34": [("revenue", False), ("product_name", True)],
    "q38a": [("revenue", False)], "q38b": [("revenue", False)], "q38c": [("revenue", False), ("product_name", True)],
    "q38d": [("revenue", False)], "q38e": [("revenue", False)], "q40": [("total_revenue", True)],
    "q41": [("total_profit", False)], "q42": [("margin_profit", False), ("revenue", True), ("product_name", True)],
}


@pytest.mark.parametrize("key", ORDER)
def test_rows_come_in_order(spark, key):
    rows = queries()[key](spark, SF_SMALL).collect()
    want = rows
    for name, ascending in reversed(ORDER[key]):  # stable sorts, least important first
        want = sorted(want, key=lambda r: r[name], reverse=not ascending)
    got = [[r[name] for name, _ in ORDER[key]] for r in rows]
    assert got == [[r[name] for name, _ in ORDER[key]] for r in want]
