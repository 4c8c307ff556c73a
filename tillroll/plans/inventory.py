"""Inventory questions (Q0, Q25-Q30) - thin calls of tillroll.operators.stock."""

from tillroll.operators.stock import (  # noqa: F401
    dead_stock_cost, overstock, stock_consistency, stock_status, turnover, unsold_products,
    urgent_reorder,
)
