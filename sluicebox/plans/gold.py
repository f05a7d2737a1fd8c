"""Gold: five business aggregates over Silver.

Builders return unordered rows; ``present`` sorts a result for reading. Every builder shrinks the item and
order tables on the map side, by product, day or customer, before dimensions are joined.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicebox.contracts import BATCH_GOLD, RECENT_DAYS
from sluicebox.functions.business import counts_as_revenue, inventory_status, status_urgency
from sluicebox.functions.dates import today_or
from sluicebox.functions.numbers import (
    Money,
    count_of,
    from_parts,
    money,
    resum_parts,
    safe_ratio,
    sum_of_parts,
    sum_parts,
    total,
)
from sluicebox.sources.snapshots import Snapshots, View
from sluicebox.sources.storage import DEFAULT_FORMAT, Staging, read_tables, staging, write_counted

# Products that a join may send through the driver to every executor: some 80 bytes each there, which a small compressed file hides.
BROADCAST_PRODUCTS = 1_000_000

SILVER_INPUTS = ("categories", "customers", "products", "orders", "order_items", "inventory")


def revenue_orders(orders: DataFrame) -> DataFrame:
    return orders.filter(counts_as_revenue())


def _order_count(unique_orders: bool) -> Column:
    """Silver holds one row per order, so a plain count saves a distinct; other inputs get the distinct."""
    return F.count("order_id") if unique_orders else F.countDistinct("order_id")


def items_per_order(items: DataFrame) -> DataFrame:
    return items.groupBy("order_id").agg(F.sum("quantity").alias("items_sold"))


def orders_with_items(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Revenue orders with their item count; items are summed first, so no order is repeated."""
    return revenue_orders(orders).join(items_per_order(items), "order_id", "left")


def daily_sales_summary(orders: DataFrame, items: DataFrame, unique_orders: bool = False) -> DataFrame:
    revenue = total(money("order_total"))
    return (
        orders_with_items(orders, items)
        .groupBy(F.col("order_date").alias("sales_date"))
        .agg(
            _order_count(unique_orders).alias("total_orders"),
            revenue.rounded().alias("total_revenue"),
            F.coalesce(F.sum("items_sold"), F.lit(0)).cast("bigint").alias("total_items_sold"),
            revenue.ratio(count_of("order_total"), 2).alias("average_order_value"),
            F.countDistinct("customer_id").alias("unique_customers"),
        )
    )


def items_of_revenue_orders(orders: DataFrame, items: DataFrame) -> DataFrame:
    kept = revenue_orders(orders).select("order_id", F.col("order_date").alias("sales_date"))
    return items.join(kept, "order_id")


def sold_sums(orders: DataFrame, items: DataFrame, *grain: str) -> DataFrame:
    """Items of revenue orders summed at a grain; money stays in parts, so sums can be summed again."""
    return (
        items_of_revenue_orders(orders, items)
        .groupBy(*grain)
        .agg(
            F.sum("quantity").alias("units"),
            *sum_parts(money("unit_price").times(F.col("quantity")), "gross"),
            *sum_parts(money("discount"), "discount"),
            *sum_parts(money("item_total"), "net"),
            F.count(F.lit(1)).alias("item_rows"),
        )
    )


def product_days(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Sums per product and day: the one big join that three outputs can share.

    It has at most products x days rows, and hot products are summed on the map side.
    """
    return sold_sums(orders, items, "product_id", "sales_date")


def product_dimension(products: DataFrame, categories: DataFrame) -> DataFrame:
    names = categories.select("category_id", "category_name")
    return products.join(names, "category_id", "left").select(
        "product_id", "product_name", "category_name", "rating"
    )


def product_performance(sums: DataFrame, products: DataFrame, categories: DataFrame) -> DataFrame:
    """Per product: units, gross, discount, net and the rating averaged over item rows.

    ``sums`` are ``sold_sums`` per product, or finer. Items collapse to one row per product before the dimension is joined;
    weighting by item rows keeps averages right even if a product appears twice in the dimension.
    """
    totals = sums.groupBy("product_id").agg(
        *[F.sum(name).alias(name) for name in ("units", "item_rows")],
        *[part for name in ("gross", "discount", "net") for part in resum_parts(name)],
    )
    rated = F.when(F.col("rating").isNotNull(), F.col("item_rows"))
    return (
        totals.join(product_dimension(products, categories), "product_id", "left")
        .groupBy("product_id", "product_name", "category_name")
        .agg(
            F.sum("units").cast("bigint").alias("units_sold"),
            sum_of_parts("gross").rounded().alias("gross_revenue"),
            sum_of_parts("discount").rounded().alias("discount_amount"),
            sum_of_parts("net").rounded().alias("net_revenue"),
            total(money("rating").times(rated)).ratio(F.sum(rated), 2).alias("average_rating"),
        )
    )


def product_categories(products: DataFrame, categories: DataFrame) -> DataFrame:
    names = categories.select("category_id", "category_name")
    return products.select("product_id", "category_id").join(names, "category_id", "left")


def _looked_up(products: DataFrame, many: bool) -> DataFrame:
    """Products as the side of a join that is looked up: many are never broadcast, whatever their files' size promises."""
    return products.hint("merge") if many else products


def category_performance(
    orders: DataFrame, items: DataFrame, products: DataFrame, categories: DataFrame, many_products: bool = False
) -> DataFrame:
    """Per category: orders, units, revenue, revenue per order.

    Rows first collapse to (order, category) on the partitioning the order join already needs; a category
    holding a third of all rows is therefore spread over its orders until only counts are left. Names are
    joined to the finished categories; a category listed twice under one name counts twice, as if joined first.
    """
    kept = revenue_orders(orders).select("order_id")
    per_order = (
        items.select("order_id", "product_id", "quantity", "item_total")
        .join(_looked_up(products.select("product_id", "category_id"), many_products), "product_id", "left")
        .join(kept, "order_id")
        .groupBy("order_id", "category_id")
        .agg(F.sum("quantity").alias("units"), *sum_parts(money("item_total"), "net"))
    )
    totals = per_order.groupBy("category_id").agg(
        F.count("order_id").alias("total_orders"), F.sum("units").alias("units"), *resum_parts("net")
    )
    names = categories.groupBy("category_id", "category_name").agg(F.count(F.lit(1)).alias("listed"))
    times = F.coalesce("listed", F.lit(1))
    net = from_parts("net")
    revenue = Money(F.round(net.exact * times, 2), net.other * times)
    return totals.join(names, "category_id", "left").select(
        "category_id",
        "category_name",
        "total_orders",
        (F.col("units") * times).cast("bigint").alias("units_sold"),
        revenue.rounded().alias("revenue"),
        revenue.ratio(F.col("total_orders"), 2).alias("average_order_value"),
    )


def customer_orders(orders: DataFrame, unique_orders: bool = False) -> DataFrame:
    spent = total(money("order_total"))
    return (
        revenue_orders(orders)
        .groupBy("customer_id")
        .agg(
            _order_count(unique_orders).alias("total_orders"),
            spent.rounded().alias("lifetime_value"),
            spent.ratio(count_of("order_total"), 2).alias("average_order_value"),
            F.max("order_date").alias("last_order_date"),
        )
    )


def customer_360(
    customers: DataFrame, orders: DataFrame, as_of: date | str | None = None, unique_orders: bool = False
) -> DataFrame:
    """Every customer with order totals (zero without orders), recency in days, and segment."""
    return (
        customers.select("customer_id", "customer_name", "customer_segment")
        .join(customer_orders(orders, unique_orders), "customer_id", "left")
        .withColumns({name: F.coalesce(name, F.lit(0)) for name in ("total_orders", "lifetime_value", "average_order_value")})
        .select(
            "customer_id",
            "customer_name",
            "total_orders",
            "lifetime_value",
            "average_order_value",
            "last_order_date",
            F.datediff(today_or(as_of), "last_order_date").alias("days_since_last_order"),
            "customer_segment",
        )
    )


def recent_days(days: DataFrame, as_of: date | str | None = None) -> DataFrame:
    return days.filter(F.col("sales_date") >= F.date_sub(today_or(as_of), RECENT_DAYS))


def recent_orders(orders: DataFrame, as_of: date | str | None = None) -> DataFrame:
    """Revenue orders of the last 30 days."""
    return revenue_orders(orders).filter(F.col("order_date") >= F.date_sub(today_or(as_of), RECENT_DAYS))


def demand_velocity(days: DataFrame, as_of: date | str | None = None) -> DataFrame:
    """Units per day with sales (not per calendar day) over the last 30 days, as exact parts of a ratio."""
    return (
        recent_days(days, as_of)
        .groupBy("product_id")
        .agg(F.sum("units").alias("recent_units"), F.count("units").alias("recent_days"))
    )


def inventory_health(
    inventory: DataFrame, products: DataFrame, days: DataFrame, as_of: date | str | None = None, many_products: bool = False
) -> DataFrame:
    """Stock status and days of stock left at the recent pace; NULL without recent sales."""
    cover = safe_ratio(F.col("stock_quantity") * F.col("recent_days"), F.col("recent_units"), 1)
    return (
        inventory.join(_looked_up(products.select("product_id", "product_name"), many_products), "product_id", "left")
        .join(demand_velocity(days, as_of), "product_id", "left")
        .select(
            "product_id",
            "product_name",
            "stock_quantity",
            "reorder_level",
            inventory_status().alias("inventory_status"),
            cover.alias("estimated_days_remaining"),
        )
    )


def ordering(table: str) -> list[Column]:
    """Reading order of each Gold table; the key comes last, so equal rows keep one order."""
    return {
        "daily_sales_summary": [F.asc("sales_date")],
        "product_performance": [F.desc("net_revenue"), F.desc("units_sold"), F.asc("product_id")],
        "category_performance": [F.desc("revenue"), F.asc("category_id")],
        "customer_360": [F.asc("customer_id")],
        "inventory_health": [
            status_urgency().asc(), F.asc_nulls_last("estimated_days_remaining"), F.asc("product_id"),
        ],
    }[table]


def present(table: str, df: DataFrame) -> DataFrame:
    return df.orderBy(*ordering(table))


def build(
    table: str,
    silver: Mapping[str, DataFrame],
    days: DataFrame | None = None,
    as_of: date | str | None = None,
    unique_orders: bool = False,
    many_products: bool = False,
) -> DataFrame:
    """One Gold table from Silver frames. ``days`` may be a stored ``product_days``."""
    s = silver
    if table == "daily_sales_summary":
        return daily_sales_summary(s["orders"], s["order_items"], unique_orders)
    if table == "category_performance":
        return category_performance(s["orders"], s["order_items"], s["products"], s["categories"], many_products)
    if table == "customer_360":
        return customer_360(s["customers"], s["orders"], as_of, unique_orders)
    if table == "product_performance":
        sums = sold_sums(s["orders"], s["order_items"], "product_id") if days is None else days
        return product_performance(sums, s["products"], s["categories"])
    if table == "inventory_health":
        days = product_days(recent_orders(s["orders"], as_of), s["order_items"]) if days is None else days
        return inventory_health(s["inventory"], s["products"], days, as_of, many_products)
    raise ValueError(f"Unknown Gold table {table!r}; known: {', '.join(BATCH_GOLD)}")


@dataclass(frozen=True)
class BuildCount:
    table: str
    written: int


def _chosen(tables: Iterable[str] | None) -> list[str]:
    chosen = list(tables or BATCH_GOLD)
    unknown = sorted(set(chosen) - set(BATCH_GOLD))
    if unknown:
        raise ValueError(f"Unknown Gold tables: {', '.join(unknown)}")
    return chosen


def _built(
    stage: Staging, silver: Mapping[str, DataFrame], chosen: list[str], as_of: date | str | None
) -> dict[str, DataFrame]:
    """The chosen tables; the item-order join behind two of them is stored once. Products are counted by their files' footers."""
    many = bool({"category_performance", "inventory_health"} & set(chosen)) and silver["products"].count() > BROADCAST_PRODUCTS
    days = None
    if {"product_performance", "inventory_health"} <= set(chosen):
        days = stage.store(product_days(silver["orders"], silver["order_items"]), "product-days")
    return {table: build(table, silver, days, as_of, unique_orders=True, many_products=many) for table in chosen}


def build_all(
    spark: SparkSession,
    silver_root: str,
    gold_root: str,
    tables: Iterable[str] | None = None,
    as_of: date | str | None = None,
    fmt: str = DEFAULT_FORMAT,
) -> list[BuildCount]:
    """Write the chosen Gold tables, each in its own folder."""
    chosen = _chosen(tables)
    silver = read_tables(spark, silver_root, SILVER_INPUTS, fmt)
    with staging(spark, "gold") as stage:
        return [
            BuildCount(table, write_counted(df, f"{gold_root}/{table}", "overwrite", fmt)["rows"])
            for table, df in _built(stage, silver, chosen, as_of).items()
        ]


def build_together(
    silver: View, store: Snapshots, tables: Iterable[str] | None = None, as_of: date | str | None = None
) -> list[BuildCount]:
    """Build the chosen Gold tables from one version of Silver and publish them in one step."""
    chosen = _chosen(tables)
    with staging(silver.spark, "gold") as stage:
        counts = store.commit(_built(stage, silver.read_all(SILVER_INPUTS), chosen, as_of))
    return [BuildCount(table, counts[table]) for table in chosen]
