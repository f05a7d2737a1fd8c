"""Business codes and rates used by the Gold tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluicebox.contracts import AT_RISK_STATUSES, REVENUE_STATUSES
from sluicebox.functions.numbers import safe_ratio


def counts_as_revenue() -> Column:
    return F.col("order_status").isin(*REVENUE_STATUSES)


def at_risk() -> Column:
    return F.col("inventory_status").isin(*AT_RISK_STATUSES)


def inventory_status() -> Column:
    return F.expr(
        "CASE WHEN stock_quantity <= 0 THEN 'out_of_stock' "
        "WHEN stock_quantity <= reorder_level THEN 'low_stock' ELSE 'healthy' END"
    )


def status_urgency() -> Column:
    """0 for out of stock, 1 for low stock, 2 for the rest."""
    return F.expr("CASE inventory_status WHEN 'out_of_stock' THEN 0 WHEN 'low_stock' THEN 1 ELSE 2 END")


def payment_failure_rate() -> Column:
    failed = F.col("payment_failures")
    return safe_ratio(failed, F.col("orders_per_window") + failed, 4, 0.0)


def cart_abandonment_rate() -> Column:
    """1 - orders / carts; negative when a window holds more orders than carts."""
    carts = F.col("add_to_cart_events")
    return safe_ratio(carts - F.col("orders_per_window"), carts, 4, 0.0)
