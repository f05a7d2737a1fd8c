"""Sliding-window business metrics.

Work is split in two: sums per (window, customer), then sums per window. Distinct customers fall out as a
count of rows, so no task or state entry ever holds the customers of a window, and a window holding a third
of all events is spread over its customers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicebox.contracts import SLIDE, WINDOW, serving_table
from sluicebox.functions.business import cart_abandonment_rate, payment_failure_rate
from sluicebox.functions.numbers import from_parts, money, resum_parts, sum_parts

# Output column -> event type it counts.
COUNTED = {
    "orders_per_window": "purchase_completed",
    "product_views": "product_view",
    "payment_failures": "payment_failed",
    "add_to_cart_events": "add_to_cart",
    "checkout_events": "checkout_started",
}
# What the measures read of an event.
MEASURED = ("event_timestamp", "customer_id", "event_type", "price", "quantity")


def _count_of(event_type: str) -> Column:
    return F.count_if(F.col("event_type") == event_type)


def event_measures() -> list[Column]:
    sold = money("price").times(F.col("quantity")).where(F.col("event_type") == "purchase_completed")
    counts = [_count_of(event_type).alias(name) for name, event_type in COUNTED.items()]
    return [*sum_parts(sold, "revenue"), *counts]


def customer_windows(events: DataFrame, window: str = WINDOW, slide: str = SLIDE) -> DataFrame:
    """Measures per (window, customer)."""
    return events.groupBy(F.window("event_timestamp", window, slide), "customer_id").agg(*event_measures())


def _window_sums() -> list[Column]:
    counts = [F.sum(name).alias(name) for name in COUNTED]
    return [*resum_parts("revenue"), *counts, F.count("customer_id").alias("active_users")]


def _finish(sums: DataFrame) -> DataFrame:
    return sums.withColumns(
        {
            "revenue_per_window": F.coalesce(from_parts("revenue").double(), F.lit(0.0)),
            "payment_failure_rate": payment_failure_rate(),
            "cart_abandonment_rate": cart_abandonment_rate(),
        }
    ).select(*serving_table("realtime_metrics").columns)


def window_metrics(parts: DataFrame) -> DataFrame:
    """Metrics per window from rows of ``customer_windows``."""
    sums = parts.groupBy("window").agg(*_window_sums())
    return _finish(sums.withColumns({"window_start": F.col("window.start"), "window_end": F.col("window.end")}))


def realtime_metrics(events: DataFrame, window: str = WINDOW, slide: str = SLIDE) -> DataFrame:
    """Seven measures and two rates per window. On a stream: append mode, one row per closed window."""
    return window_metrics(customer_windows(events, window, slide))


def customer_sums(parts: DataFrame) -> DataFrame:
    """One row per (window, customer) from stored parts of several batches."""
    counts = [F.sum(name).alias(name) for name in COUNTED]
    return parts.groupBy("window_start", "window_end", "customer_id").agg(*resum_parts("revenue"), *counts)


def stored_window_metrics(parts: DataFrame) -> DataFrame:
    """Metrics per window from stored parts, which hold flat window bounds."""
    return _finish(parts.groupBy("window_start", "window_end").agg(*_window_sums()))
