"""The ten dashboard result sets over Gold, and the dashboard's own filters."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicebox.contracts import serving_table
from sluicebox.functions.business import at_risk, status_urgency
from sluicebox.functions.dates import month_start
from sluicebox.functions.numbers import count_of, money, total

MAX_LIMIT = 500
DEFAULT_LIMIT = 25


def _money_total(name: str) -> Column:
    return total(money(name)).double()


def _money_mean(name: str) -> Column:
    """Mean from an exact total; NULL without rows."""
    return F.try_divide(_money_total(name), count_of(name))


def _columns(table: str) -> list[str]:
    return serving_table(table).columns


def overview(daily: DataFrame) -> DataFrame:
    """Totals over all days. Customers are daily uniques added up; order value is the mean of daily means."""
    totals = {
        "total_revenue": _money_total("total_revenue"),
        "total_orders": F.sum("total_orders"),
        "units_sold": F.sum("total_items_sold"),
        "average_order_value": _money_mean("average_order_value"),
        "unique_customers": F.sum("unique_customers"),
    }
    return daily.agg(*[F.coalesce(total, F.lit(0)).alias(name) for name, total in totals.items()])


def daily_sales(daily: DataFrame) -> DataFrame:
    return daily.select(*_columns("daily_sales_summary")).orderBy("sales_date")


def monthly_sales(daily: DataFrame) -> DataFrame:
    return (
        daily.groupBy(month_start("sales_date").alias("sales_month"))
        .agg(
            F.sum("total_orders").alias("total_orders"),
            _money_total("total_revenue").alias("total_revenue"),
            F.sum("total_items_sold").alias("total_items_sold"),
            _money_mean("average_order_value").alias("average_order_value"),
        )
        .orderBy("sales_month")
    )


def top_products(products: DataFrame, limit: int = DEFAULT_LIMIT) -> DataFrame:
    best = [F.desc("net_revenue"), F.asc("product_id")]
    return products.select(*_columns("product_performance")).orderBy(*best).limit(limit)


def category_ranking(categories: DataFrame) -> DataFrame:
    return categories.select(*_columns("category_performance")).orderBy(F.desc("revenue"), "category_id")


def top_customers(customers: DataFrame, limit: int = DEFAULT_LIMIT) -> DataFrame:
    best = [F.desc("lifetime_value"), F.asc("customer_id")]
    return customers.select(*_columns("customer_360")).orderBy(*best).limit(limit)


def customer_segments(customers: DataFrame) -> DataFrame:
    return (
        customers.groupBy("customer_segment")
        .agg(
            F.count("*").alias("customer_count"),
            _money_mean("average_order_value").alias("average_order_value"),
            _money_total("lifetime_value").alias("lifetime_value"),
        )
        .orderBy(F.desc("lifetime_value"), "customer_segment")
    )


def inventory_priority(inventory: DataFrame, limit: int = DEFAULT_LIMIT) -> DataFrame:
    order = [status_urgency().asc(), F.asc_nulls_last("estimated_days_remaining"), F.asc("product_id")]
    return inventory.select(*_columns("inventory_health")).orderBy(*order).limit(limit)


def inventory_status_counts(inventory: DataFrame) -> DataFrame:
    return (
        inventory.groupBy("inventory_status")
        .agg(F.count("*").alias("product_count"))
        .orderBy(F.desc("product_count"), "inventory_status")
    )


def latest_windows(metrics: DataFrame, limit: int = DEFAULT_LIMIT) -> DataFrame:
    return metrics.select(*_columns("realtime_metrics")).orderBy(F.desc("window_start")).limit(limit)


def latest_window(metrics: DataFrame) -> DataFrame:
    return latest_windows(metrics, 1)


def dashboard(gold: Mapping[str, DataFrame], limit: int = DEFAULT_LIMIT) -> dict[str, DataFrame]:
    """All ten result sets by name, lazily."""
    if not 1 <= limit <= MAX_LIMIT:
        raise ValueError(f"limit must be between 1 and {MAX_LIMIT}")
    daily, customers, stock = gold["daily_sales_summary"], gold["customer_360"], gold["inventory_health"]
    return {
        "overview_kpis": overview(daily),
        "daily_sales": daily_sales(daily),
        "monthly_sales": monthly_sales(daily),
        "product_performance": top_products(gold["product_performance"], limit),
        "category_performance": category_ranking(gold["category_performance"]),
        "customer_360": top_customers(customers, limit),
        "customer_segments": customer_segments(customers),
        "inventory_health": inventory_priority(stock, limit),
        "inventory_status": inventory_status_counts(stock),
        "realtime_metrics": latest_windows(gold["realtime_metrics"], limit),
    }


def in_date_range(df: DataFrame, name: str, start: date | str | None, end: date | str | None) -> DataFrame:
    """Inclusive range; no filter unless both ends are given."""
    if start is None or end is None:
        return df
    return df.filter(F.col(name).between(F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date")))


def date_bounds(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.min(name).alias("first_date"), F.max(name).alias("last_date"))


def products_at_risk(inventory: DataFrame) -> DataFrame:
    return inventory.filter(at_risk())
