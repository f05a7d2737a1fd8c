"""Gold, KPI, serving and governed SQL over the mapped tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import stacking
from checks.fixtures import AS_OF, Inputs
from checks.registry import VIEWS, check, half_up, money, money_ratio, view
from sluicebox.contracts import serving_table
from sluicebox.functions import business, dates, numbers
from sluicebox.operators.keys import with_parent
from sluicebox.operators.quality import contract_report
from sluicebox.plans import forecast, gold, governed, kpi, serving
from sluicebox.sources.snapshots import Snapshots
from sluicebox.sources.storage import Staging, fresh_folder, read_table
from sluicebox.streaming.metrics import customer_windows, realtime_metrics

# ---- DuckDB side ------------------------------------------------------------------------------------------

REVENUE = "order_status IN ('delivered', 'shipped', 'processing')"
view("revenue_m", f"SELECT * FROM orders_m WHERE {REVENUE}")
view("per_order_m", "SELECT order_id, CAST(SUM(quantity) AS BIGINT) AS items_sold FROM order_items_m GROUP BY order_id")


def daily_sql(orders: str, per_order: str) -> str:
    return (
        "SELECT order_date AS sales_date, COUNT(DISTINCT order_id) AS total_orders, "
        f"CAST(ROUND({money('order_total')}, 2) AS DOUBLE) AS total_revenue, "
        "CAST(COALESCE(SUM(items_sold), 0) AS BIGINT) AS total_items_sold, "
        f"{money_ratio(money('order_total'), 'COUNT(order_total)')} AS average_order_value, "
        "COUNT(DISTINCT customer_id) AS unique_customers "
        f"FROM {orders} LEFT JOIN {per_order} USING (order_id) GROUP BY order_date"
    )


view("g_daily", daily_sql("revenue_m", "per_order_m"))
view("sold_m", "SELECT i.*, o.order_date FROM order_items_m i JOIN revenue_m o USING (order_id)")
view(
    "g_product",
    "SELECT product_id, product_name, category_name, CAST(SUM(quantity) AS BIGINT) AS units_sold, "
    "CAST(ROUND(SUM(CAST(quantity AS DECIMAL(10,0)) * CAST(unit_price AS DECIMAL(18,4))), 2) AS DOUBLE) AS gross_revenue, "
    f"CAST(ROUND({money('discount')}, 2) AS DOUBLE) AS discount_amount, "
    f"CAST(ROUND({money('item_total')}, 2) AS DOUBLE) AS net_revenue, "
    f"{money_ratio(money('rating'), 'COUNT(rating)')} AS average_rating "
    "FROM sold_m LEFT JOIN products_m USING (product_id) LEFT JOIN categories_m USING (category_id) "
    "GROUP BY product_id, product_name, category_name",
)
view(
    "g_category",
    "SELECT category_id, category_name, total_orders, units_sold, CAST(r AS DOUBLE) AS revenue, "
    f"{money_ratio('r', 'total_orders')} AS average_order_value FROM ("
    "SELECT category_id, category_name, COUNT(DISTINCT order_id) AS total_orders, "
    f"CAST(SUM(quantity) AS BIGINT) AS units_sold, ROUND({money('item_total')}, 2) AS r "
    "FROM sold_m LEFT JOIN products_m USING (product_id) LEFT JOIN categories_m USING (category_id) GROUP BY ALL)",
)
view(
    "customer_orders_m",
    "SELECT customer_id, COUNT(DISTINCT order_id) AS total_orders, "
    f"CAST(ROUND({money('order_total')}, 2) AS DOUBLE) AS lifetime_value, "
    f"{money_ratio(money('order_total'), 'COUNT(order_total)')} AS average_order_value, "
    "MAX(order_date) AS last_order_date FROM revenue_m GROUP BY customer_id",
)
view(
    "g_customer",
    "SELECT customer_id, customer_name, COALESCE(total_orders, 0) AS total_orders, "
    "COALESCE(lifetime_value, 0.0) AS lifetime_value, COALESCE(average_order_value, 0.0) AS average_order_value, "
    f"last_order_date, CAST(DATE '{AS_OF}' - last_order_date AS INTEGER) AS days_since_last_order, customer_segment "
    "FROM customers_m LEFT JOIN customer_orders_m USING (customer_id)",
)
view(
    "daily_units_m",
    "SELECT product_id, order_date, CAST(SUM(quantity) AS BIGINT) AS daily_units FROM sold_m "
    f"WHERE order_date >= DATE '{AS_OF}' - 30 GROUP BY product_id, order_date",
)
view(
    "velocity_m",
    "SELECT product_id, CAST(SUM(daily_units) AS BIGINT) AS recent_units, COUNT(*) AS recent_days "
    "FROM daily_units_m GROUP BY product_id",
)
STATUS = (
    "CASE WHEN stock_quantity <= 0 THEN 'out_of_stock' WHEN stock_quantity <= reorder_level THEN 'low_stock' "
    "ELSE 'healthy' END"
)
view(
    "g_inventory",
    f"SELECT product_id, product_name, stock_quantity, reorder_level, {STATUS} AS inventory_status, "
    f"CASE WHEN recent_units > 0 THEN {half_up('stock_quantity * recent_days', 'recent_units', 1)} END AS estimated_days_remaining "
    "FROM inventory_m LEFT JOIN products_m USING (product_id) LEFT JOIN velocity_m USING (product_id)",
)
view(
    "windows_m",
    "SELECT *, unnest(generate_series(date_trunc('minute', event_timestamp) - INTERVAL 4 MINUTE, "
    "date_trunc('minute', event_timestamp), INTERVAL 1 MINUTE)) AS window_start FROM events_m",
)


def metrics_sql(source: str) -> str:
    """Window metrics over rows that already carry their window_start."""
    failed, orders, carts = "SUM(payment_failed)", "SUM(purchase)", "SUM(cart)"
    return (
        "SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, "
        "CAST(COALESCE(SUM(revenue), 0) AS DOUBLE) AS revenue_per_window, "
        f"CAST({orders} AS BIGINT) AS orders_per_window, COUNT(DISTINCT customer_id) AS active_users, "
        f"CAST(SUM(seen) AS BIGINT) AS product_views, CAST({failed} AS BIGINT) AS payment_failures, "
        f"CAST({carts} AS BIGINT) AS add_to_cart_events, CAST(SUM(checkout) AS BIGINT) AS checkout_events, "
        f"CASE WHEN {orders} + {failed} > 0 THEN {half_up(failed, f'({orders} + {failed})', 4)} ELSE 0.0 END AS payment_failure_rate, "
        f"CASE WHEN {carts} > 0 THEN {half_up(f'({carts} - {orders})', carts, 4)} ELSE 0.0 END AS cart_abandonment_rate "
        "FROM (SELECT window_start, customer_id, "
        "CASE WHEN event_type = 'purchase_completed' THEN CAST(price AS DECIMAL(18,4)) * CAST(quantity AS DECIMAL(10,0)) END AS revenue, "
        "coalesce(event_type = 'purchase_completed', false)::INT AS purchase, "
        "coalesce(event_type = 'product_view', false)::INT AS seen, "
        "coalesce(event_type = 'payment_failed', false)::INT AS payment_failed, "
        "coalesce(event_type = 'add_to_cart', false)::INT AS cart, "
        f"coalesce(event_type = 'checkout_started', false)::INT AS checkout FROM {source}) GROUP BY window_start"
    )


view("g_realtime", metrics_sql("windows_m"))

# ---- Spark side -------------------------------------------------------------------------------------------


def gold_tables(t: Inputs) -> dict[str, DataFrame]:
    silver = t.silver()
    built = {name: gold.build(name, silver, as_of=AS_OF) for name in gold.BATCH_GOLD}
    return built | {"realtime_metrics": realtime_metrics(t["events_m"])}


def _gold(t: Inputs, name: str) -> DataFrame:
    if name == "realtime_metrics":
        return realtime_metrics(t["events_m"])
    return gold.build(name, t.silver(), as_of=AS_OF)


for _key, _table, _view in (
    ("gold_daily_sales_summary", "daily_sales_summary", "g_daily"),
    ("gold_product_performance", "product_performance", "g_product"),
    ("gold_category_performance", "category_performance", "g_category"),
    ("gold_customer_360", "customer_360", "g_customer"),
    ("gold_inventory_health", "inventory_health", "g_inventory"),
):
    check(_key, f"SELECT * FROM {_view}")(lambda t, table=_table: gold.present(table, _gold(t, table)))

check("gold_realtime_metrics", "SELECT * FROM g_realtime")(lambda t: _gold(t, "realtime_metrics"))
check("sort_inventory_priority", "SELECT * FROM g_inventory")(
    lambda t: gold.present("inventory_health", _gold(t, "inventory_health"))
)


# ---- parts of the Gold builds -----------------------------------------------------------------------------


@check("src_table", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def src_table(t: Inputs) -> DataFrame:
    return read_table(t.spark, f"{t.folder}/orders.parquet").select("o_orderkey", "o_custkey", "o_totalprice")


check("revenue_orders", "SELECT order_id, order_status FROM revenue_m")(
    lambda t: gold.revenue_orders(t["orders_m"]).select("order_id", "order_status")
)
check("recent_orders_30d", f"SELECT order_id, order_date FROM revenue_m WHERE order_date >= DATE '{AS_OF}' - 30")(
    lambda t: gold.recent_orders(t["orders_m"], AS_OF).select("order_id", "order_date")
)
check("agg_items_per_order", "SELECT * FROM per_order_m")(lambda t: gold.items_per_order(t["order_items_m"]))


@check(
    "join_orders_item_totals",
    "SELECT order_id, order_total, items_sold FROM revenue_m LEFT JOIN per_order_m USING (order_id)",
)
def join_orders_item_totals(t: Inputs) -> DataFrame:
    return gold.orders_with_items(t["orders_m"], t["order_items_m"]).select("order_id", "order_total", "items_sold")


@check(
    "join_product_dim",
    "SELECT product_id, product_name, category_name, rating FROM products_m LEFT JOIN categories_m USING (category_id)",
)
def join_product_dim(t: Inputs) -> DataFrame:
    return gold.product_dimension(t["products_m"], t["categories_m"])


@check(
    "join_product_category",
    "SELECT product_id, category_id, category_name FROM products_m LEFT JOIN categories_m USING (category_id)",
)
def join_product_category(t: Inputs) -> DataFrame:
    return gold.product_categories(t["products_m"], t["categories_m"])


check("join_items_revenue_orders", "SELECT order_item_id, order_id, product_id, quantity, order_date AS sales_date FROM sold_m")(
    lambda t: gold.items_of_revenue_orders(t["orders_m"], t["order_items_m"]).select(
        "order_item_id", "order_id", "product_id", "quantity", "sales_date"
    )
)
check(
    "join_items_recent_orders",
    f"SELECT order_item_id, product_id, quantity, order_date AS sales_date FROM sold_m WHERE order_date >= DATE '{AS_OF}' - 30",
)(
    lambda t: gold.items_of_revenue_orders(gold.recent_orders(t["orders_m"], AS_OF), t["order_items_m"]).select(
        "order_item_id", "product_id", "quantity", "sales_date"
    )
)
check(
    "join_customer_metrics",
    "SELECT customer_id, COALESCE(total_orders, 0) AS total_orders, COALESCE(lifetime_value, 0.0) AS lifetime_value "
    "FROM customers_m LEFT JOIN customer_orders_m USING (customer_id)",
)(lambda t: _gold(t, "customer_360").select("customer_id", "total_orders", "lifetime_value"))


@check(
    "join_payment_order_total",
    "SELECT payment_id, payment_amount, order_total AS expected_total FROM payments_m LEFT JOIN orders_m USING (order_id)",
)
def join_payment_order_total(t: Inputs) -> DataFrame:
    rows = with_parent(
        t["payments_m"], t["orders_m"], "order_id", "order_id", "_missing", {"order_total": "expected_total"}, unique_parent=True
    )
    return rows.select("payment_id", "payment_amount", "expected_total")


@check("agg_daily_units", "SELECT product_id, order_date AS sales_date, daily_units AS units FROM daily_units_m")
def agg_daily_units(t: Inputs) -> DataFrame:
    days = gold.product_days(gold.recent_orders(t["orders_m"], AS_OF), t["order_items_m"])
    return days.select("product_id", "sales_date", "units")


@check("agg_velocity_30d", "SELECT * FROM velocity_m")
def agg_velocity_30d(t: Inputs) -> DataFrame:
    days = gold.product_days(gold.recent_orders(t["orders_m"], AS_OF), t["order_items_m"])
    return gold.demand_velocity(days, AS_OF)


check(
    "join_inventory_velocity",
    "SELECT product_id, product_name, stock_quantity, estimated_days_remaining FROM g_inventory",
)(
    lambda t: _gold(t, "inventory_health").select(
        "product_id", "product_name", "stock_quantity", "estimated_days_remaining"
    )
)


@check("agg_product_days", "SELECT product_id, order_date AS sales_date, CAST(SUM(quantity) AS BIGINT) AS units, "
       f"CAST({money('item_total')} AS DOUBLE) AS net, COUNT(*) AS item_rows FROM sold_m GROUP BY ALL")
def agg_product_days(t: Inputs) -> DataFrame:
    days = gold.product_days(t["orders_m"], t["order_items_m"])
    return days.select("product_id", "sales_date", "units", numbers.from_parts("net").double().alias("net"), "item_rows")


# ---- scalar functions -------------------------------------------------------------------------------------


@check(
    "fn_datediff",
    f"SELECT order_id, CAST(DATE '{AS_OF}' - order_date AS INTEGER) AS days FROM orders_m",
)
def fn_datediff(t: Inputs) -> DataFrame:
    return t["orders_m"].select("order_id", F.datediff(dates.today_or(AS_OF), "order_date").alias("days"))


check("fn_date_sub", "SELECT order_id, CAST(order_date - 30 AS DATE) AS cutoff FROM orders_m")(
    lambda t: t["orders_m"].select("order_id", F.date_sub("order_date", 30).alias("cutoff"))
)
check("fn_current_date", "SELECT order_id, order_date <= current_date AS past FROM orders_m")(
    lambda t: t["orders_m"].select("order_id", (F.col("order_date") <= dates.today_or(None)).alias("past"))
)
check("fn_date_trunc_month", "SELECT order_id, CAST(date_trunc('month', order_date) AS DATE) AS sales_month FROM orders_m")(
    lambda t: t["orders_m"].select("order_id", dates.month_start("order_date").alias("sales_month"))
)
check(
    "fn_calendar",
    "SELECT order_id, CAST(isodow(order_date) - 1 AS INTEGER) AS day_of_week, CAST(month(order_date) AS INTEGER) AS month, "
    "CAST(week(order_date) AS INTEGER) AS week_of_year FROM orders_m",
)(lambda t: t["orders_m"].select("order_id", *[c.alias(n) for n, c in dates.calendar("order_date").items()]))
check("fn_inventory_status", f"SELECT product_id, {STATUS} AS inventory_status FROM inventory_m")(
    lambda t: t["inventory_m"].select("product_id", business.inventory_status().alias("inventory_status"))
)
check(
    "fn_round",
    "SELECT order_id, CAST(ROUND(CAST(order_total AS DECIMAL(18,4)), 1) AS DOUBLE) AS rounded FROM orders_m",
)(lambda t: t["orders_m"].select("order_id", numbers.rounded(F.col("order_total").cast("decimal(18,4)"), 1).alias("rounded")))
check("fn_abs", "SELECT payment_id, abs(payment_amount - 100000) AS gap FROM payments_m")(
    lambda t: t["payments_m"].select("payment_id", F.abs(F.col("payment_amount") - 100000).alias("gap"))
)
check(
    "fn_safe_ratio",
    f"SELECT product_id, CASE WHEN stock_quantity > 0 THEN {half_up('reorder_level', 'stock_quantity', 4)} END AS ratio FROM inventory_m",
)(
    lambda t: t["inventory_m"].select(
        "product_id", numbers.safe_ratio(F.col("reorder_level"), F.col("stock_quantity"), 4).alias("ratio")
    )
)
check("fn_payment_failure_rate", "SELECT window_start, payment_failure_rate FROM g_realtime")(
    lambda t: _gold(t, "realtime_metrics").select("window_start", business.payment_failure_rate().alias("payment_failure_rate"))
)
check("fn_cart_abandonment", "SELECT window_start, cart_abandonment_rate FROM g_realtime")(
    lambda t: _gold(t, "realtime_metrics").select("window_start", business.cart_abandonment_rate().alias("cart_abandonment_rate"))
)
check("agg_conditional_counts", "SELECT window_start, orders_per_window, product_views, payment_failures, "
      "add_to_cart_events, checkout_events, revenue_per_window FROM g_realtime")(
    lambda t: _gold(t, "realtime_metrics").select(
        "window_start", "orders_per_window", "product_views", "payment_failures", "add_to_cart_events",
        "checkout_events", "revenue_per_window",
    )
)


@check(
    "stream_sliding_window",
    "SELECT window_start, customer_id, COUNT(*) FILTER (event_type = 'product_view') AS product_views "
    "FROM windows_m GROUP BY window_start, customer_id",
)
def stream_sliding_window(t: Inputs) -> DataFrame:
    return customer_windows(t["events_m"]).select(F.col("window.start").alias("window_start"), "customer_id", "product_views")


# ---- KPI --------------------------------------------------------------------------------------------------


def mean(name: str) -> str:
    return f"CAST({money(name)} AS DOUBLE) / COUNT({name})"


def total(name: str) -> str:
    return f"CAST(SUM({name}) AS BIGINT)"


KPI_SQL = {
    "kpi_overview": f"SELECT COALESCE(CAST({money('total_revenue')} AS DOUBLE), 0) AS total_revenue, "
    f"COALESCE({total('total_orders')}, 0) AS total_orders, COALESCE({total('total_items_sold')}, 0) AS units_sold, "
    f"COALESCE({mean('average_order_value')}, 0) AS average_order_value, "
    f"COALESCE({total('unique_customers')}, 0) AS unique_customers FROM g_daily",
    "kpi_daily_sales": "SELECT * FROM g_daily",
    "kpi_monthly_sales": "SELECT CAST(date_trunc('month', sales_date) AS DATE) AS sales_month, "
    f"{total('total_orders')} AS total_orders, CAST({money('total_revenue')} AS DOUBLE) AS total_revenue, "
    f"{total('total_items_sold')} AS total_items_sold, {mean('average_order_value')} AS average_order_value "
    "FROM g_daily GROUP BY 1",
    "kpi_top_products": "SELECT * FROM g_product ORDER BY net_revenue DESC, product_id LIMIT 25",
    "kpi_category_performance": "SELECT * FROM g_category",
    "kpi_top_customers": "SELECT * FROM g_customer ORDER BY lifetime_value DESC, customer_id LIMIT 25",
    "kpi_customer_segments": "SELECT customer_segment, COUNT(*) AS customer_count, "
    f"{mean('average_order_value')} AS average_order_value, CAST({money('lifetime_value')} AS DOUBLE) AS lifetime_value "
    "FROM g_customer GROUP BY customer_segment",
    "kpi_inventory_health": "SELECT * FROM g_inventory ORDER BY CASE inventory_status WHEN 'out_of_stock' THEN 0 "
    "WHEN 'low_stock' THEN 1 ELSE 2 END, estimated_days_remaining NULLS LAST, product_id LIMIT 25",
    "kpi_inventory_status": "SELECT inventory_status, COUNT(*) AS product_count FROM g_inventory GROUP BY inventory_status",
    "kpi_realtime_latest": "SELECT * FROM g_realtime ORDER BY window_start DESC LIMIT 25",
    "latest_metric_window": "SELECT * FROM g_realtime ORDER BY window_start DESC LIMIT 1",
    "top_products_15": "SELECT * FROM g_product ORDER BY net_revenue DESC, product_id LIMIT 15",
    "inventory_at_risk": "SELECT * FROM g_inventory WHERE inventory_status IN ('out_of_stock', 'low_stock')",
    "date_range_filter": "SELECT * FROM g_daily WHERE sales_date BETWEEN DATE '1997-02-01' AND DATE '1998-03-31'",
    "date_bounds": "SELECT MIN(sales_date) AS first_date, MAX(sales_date) AS last_date FROM g_daily",
}
KPI_SPARK = {
    "kpi_overview": lambda t: kpi.overview(_gold(t, "daily_sales_summary")),
    "kpi_daily_sales": lambda t: kpi.daily_sales(_gold(t, "daily_sales_summary")),
    "kpi_monthly_sales": lambda t: kpi.monthly_sales(_gold(t, "daily_sales_summary")),
    "kpi_top_products": lambda t: kpi.top_products(_gold(t, "product_performance")),
    "kpi_category_performance": lambda t: kpi.category_ranking(_gold(t, "category_performance")),
    "kpi_top_customers": lambda t: kpi.top_customers(_gold(t, "customer_360")),
    "kpi_customer_segments": lambda t: kpi.customer_segments(_gold(t, "customer_360")),
    "kpi_inventory_health": lambda t: kpi.inventory_priority(_gold(t, "inventory_health")),
    "kpi_inventory_status": lambda t: kpi.inventory_status_counts(_gold(t, "inventory_health")),
    "kpi_realtime_latest": lambda t: kpi.latest_windows(_gold(t, "realtime_metrics")),
    "latest_metric_window": lambda t: kpi.latest_window(_gold(t, "realtime_metrics")),
    "top_products_15": lambda t: kpi.top_products(_gold(t, "product_performance"), 15),
    "inventory_at_risk": lambda t: kpi.products_at_risk(_gold(t, "inventory_health")),
    "date_range_filter": lambda t: kpi.in_date_range(
        _gold(t, "daily_sales_summary"), "sales_date", "1997-02-01", "1998-03-31"
    ),
    "date_bounds": lambda t: kpi.date_bounds(_gold(t, "daily_sales_summary"), "sales_date"),
}
for _key, _sql in KPI_SQL.items():
    check(_key, _sql)(KPI_SPARK[_key])

_BUNDLE = {
    "overview_kpis": "kpi_overview", "daily_sales": "kpi_daily_sales", "monthly_sales": "kpi_monthly_sales",
    "product_performance": "kpi_top_products", "category_performance": "kpi_category_performance",
    "customer_360": "kpi_top_customers", "customer_segments": "kpi_customer_segments",
    "inventory_health": "kpi_inventory_health", "inventory_status": "kpi_inventory_status",
    "realtime_metrics": "kpi_realtime_latest",
}


@check(
    "kpi_bundle",
    " UNION ALL ".join(
        f"SELECT '{name}' AS dataset, COUNT(*) AS row_count FROM ({KPI_SQL[key]})" for name, key in _BUNDLE.items()
    ),
)
def kpi_bundle(t: Inputs) -> DataFrame:
    counts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("dataset"), "row_count")
        for name, df in kpi.dashboard(gold_tables(t)).items()
    ]
    out = counts[0]
    for part in counts[1:]:
        out = out.unionByName(part)
    return out


# ---- serving, contracts, governed SQL ---------------------------------------------------------------------

_SERVED = {
    "daily_sales_summary": "g_daily", "product_performance": "g_product", "category_performance": "g_category",
    "customer_360": "g_customer", "inventory_health": "g_inventory", "realtime_metrics": "g_realtime",
}


@check("serving_projection", stacking.serving_sql(_SERVED))
def serving_projection(t: Inputs) -> DataFrame:
    return stacking.serving({name: serving.serving_rows(df, serving_table(name)) for name, df in gold_tables(t).items()})


@check(
    "null_clean_nan",
    "SELECT p_partkey, CASE WHEN p_partkey % 7 <> 0 THEN p_retailprice END AS price, "
    "CASE WHEN p_partkey % 5 <> 0 THEN p_retailprice / 2 END AS half FROM part",
)
def null_clean_nan(t: Inputs) -> DataFrame:
    nan = F.lit(float("nan"))
    rows = t.given("part").select(
        "p_partkey",
        F.when(F.col("p_partkey") % 7 == 0, nan).otherwise(F.col("p_retailprice")).alias("price"),
        F.when(F.col("p_partkey") % 5 != 0, F.col("p_retailprice") / 2).alias("half"),
    )
    return numbers.nan_to_null(rows)


@check("sink_serving_replace", stacking.serving_sql(_SERVED))
def sink_serving_replace(t: Inputs) -> DataFrame:
    """All six tables in plain folders, each replaced once."""
    target = serving.FileTarget(fresh_folder(t.spark, "serving"))
    stage = Staging(t.spark, fresh_folder(t.spark, "gold"))
    for name, df in gold_tables(t).items():
        df = stage.store(df, name)  # built once for both loads
        serving.replace_serving_table(df.limit(3), name, target)
        serving.replace_serving_table(df, name, target)
    return stacking.serving({name: read_table(t.spark, f"{target.root}/{name}") for name in _SERVED})


@check("sink_serving_many", stacking.serving_sql(_SERVED))
def sink_serving_many(t: Inputs) -> DataFrame:
    """All six tables in one commit; a later load whose third table breaks is not seen in any of them."""
    target = serving.SnapshotTarget(Snapshots(t.spark, fresh_folder(t.spark, "served")))
    frames = gold_tables(t)
    serving.replace_serving_tables(frames, target)
    broken = {name: df.limit(1) for name, df in frames.items()}
    broken["category_performance"] = broken["category_performance"].withColumn("category_name", F.raise_error(F.lit("broken")))
    try:
        serving.replace_serving_tables(broken, target)
    except Exception:  # noqa: BLE001  (the engine's error is what is being provoked)
        return stacking.serving(target.view().read_all())
    raise AssertionError("The broken load was published")


def _spoiled(name: str) -> list[dict[str, str]]:
    """Columns to replace in three copies of a table: required ones by NULL, texts by long ones, the key by NULL."""
    table = serving_table(name)
    return [
        {c: "NULL" for c in table.required if c not in table.key},
        {c: f"repeat('x', {n + 1})" for c, n in table.max_length.items()},
        {c: "NULL" for c in table.key},
    ]


def _spoiled_sql(name: str) -> str:
    columns = serving_table(name).columns
    parts = [{}, *_spoiled(name)]
    return " UNION ALL ".join(f"SELECT {', '.join(f'{p.get(c, c)} AS {c}' for c in columns)} FROM {_SERVED[name]}" for p in parts)


def _violations_sql(name: str) -> str:
    table, source = serving_table(name), f"spoiled_{name}"
    rules = {f"not_null:{c}": f"SELECT COUNT(*) FILTER ({c} IS NULL) FROM {source}" for c in table.required}
    rules |= {f"max_length:{c}": f"SELECT COUNT(*) FILTER (length({c}) > {n}) FROM {source}" for c, n in table.max_length.items()}
    key = ", ".join(table.key)
    rules[f"unique:{key}"] = f"SELECT CAST(SUM(n - 1) AS BIGINT) FROM (SELECT COUNT(*) AS n FROM {source} GROUP BY {key})"
    return " UNION ALL ".join(f"SELECT '{name}' AS table_name, '{rule}' AS rule, ({sql}) AS violations" for rule, sql in rules.items())


for _name in _SERVED:
    view(f"spoiled_{_name}", _spoiled_sql(_name))


@check("contract_check", f"SELECT * FROM ({' UNION ALL '.join(map(_violations_sql, _SERVED))}) WHERE violations > 0")
def contract_check(t: Inputs) -> DataFrame:
    """Every rule of all six tables is broken by copies of their rows."""
    stage, frames = Staging(t.spark, fresh_folder(t.spark, "contracts")), {}
    for name, df in gold_tables(t).items():
        df = stage.store(serving.serving_rows(df, serving_table(name)), name)
        kinds = dict(df.dtypes)
        spoiled = [df.selectExpr(*[f"CAST({p[c]} AS {kinds[c]}) AS {c}" if c in p else c for c in df.columns]) for p in _spoiled(name)]
        frames[name] = reduce(DataFrame.unionByName, [df, *spoiled])
    return contract_report(frames, stage)


@check(
    "guarded_query",
    "SELECT category_name, COUNT(*) AS products, CAST(SUM(units_sold) AS BIGINT) AS units FROM g_product "
    "WHERE net_revenue > (SELECT MIN(net_revenue) FROM g_product) GROUP BY category_name",
)
def guarded_query(t: Inputs) -> DataFrame:
    sql = (
        "SELECT category_name, COUNT(*) AS products, SUM(units_sold) AS units FROM product_performance "
        "WHERE net_revenue > (SELECT MIN(net_revenue) FROM product_performance) GROUP BY category_name"
    )
    return governed.run_approved(t.spark, sql, {"product_performance": _gold(t, "product_performance")})


# Each reads the column `internal_note`, which no contract lists; {t} is the table and {k} its key.
_PROBES = (
    "SELECT * FROM {t}", "SELECT a.n FROM (SELECT internal_note AS n FROM {t}) a", "SELECT {k} FROM {t} WHERE internal_note > 0",
    "SELECT max({k}) AS k FROM {t} GROUP BY internal_note", "SELECT a.{k} FROM {t} a JOIN {t} b USING (internal_note)",
    "WITH q AS (TABLE {t}) SELECT {k} FROM q", "SELECT (SELECT max(internal_note) FROM {t}) AS n FROM {t}",
)


@check(
    "guarded_columns",
    " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, COUNT(*) AS rows_read, COUNT(DISTINCT {serving_table(name).key[0]}) AS keys_read, "
        f"{len(_PROBES)} AS refused FROM {sql_view}"
        for name, sql_view in _SERVED.items()
    ),
)
def guarded_columns(t: Inputs) -> DataFrame:
    """All six tables carry one column more than their contract: approved columns are read, the others refused."""
    frames = {name: df.withColumn("internal_note", F.lit(1)) for name, df in gold_tables(t).items()}
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
    parts = []
    for name in frames:
        key = serving_table(name).key[0]
        refused = sum(not governed.check_sql(t.spark, probe.format(t=name, k=key)).ok for probe in _PROBES)
        read = governed.run_approved(t.spark, f"SELECT '{name}' AS table_name, COUNT(*) AS rows_read, COUNT(DISTINCT {key}) AS keys_read FROM {name}")
        parts.append(read.withColumn("refused", F.lit(refused)))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


# ---- forecast ---------------------------------------------------------------------------------------------

view(
    "sales_m",
    "SELECT order_date AS sales_date, product_id, category_id, CAST(SUM(quantity) AS DOUBLE) AS units_sold, "
    f"CAST(ROUND({money('item_total')}, 2) AS DOUBLE) AS revenue FROM sold_m LEFT JOIN products_m USING (product_id) "
    "GROUP BY order_date, product_id, category_id",
)
_W = "PARTITION BY product_id ORDER BY sales_date, category_id"
view(
    "series_m",
    "SELECT sales_date, product_id, category_id, units_sold, revenue, "
    f"LAG(units_sold, 1) OVER ({_W}) AS l1, LAG(units_sold, 7) OVER ({_W}) AS l7, "
    f"AVG(units_sold) OVER ({_W} ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS r7, "
    f"AVG(units_sold) OVER ({_W} ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING) AS r30, "
    "AVG(units_sold) OVER (PARTITION BY product_id) AS m FROM sales_m",
)
view(
    "features_m",
    "SELECT sales_date, product_id, category_id, units_sold, revenue, "
    "CAST(isodow(sales_date) - 1 AS INTEGER) AS day_of_week, CAST(month(sales_date) AS INTEGER) AS month, "
    "CAST(week(sales_date) AS INTEGER) AS week_of_year, coalesce(l1, m, 0) AS lag_1, coalesce(l7, m, 0) AS lag_7, "
    "coalesce(r7, m, 0) AS rolling_mean_7, coalesce(r30, m, 0) AS rolling_mean_30 FROM series_m",
)
view(
    "tail_m",
    "SELECT product_id, max_by(category_id, sales_date) AS category_id, "
    "list(units_sold ORDER BY sales_date) AS units, list(revenue ORDER BY sales_date)[-7:] AS revenues FROM ("
    "SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY sales_date DESC) AS rn FROM features_m) "
    "WHERE rn <= 30 GROUP BY product_id",
)
_PATH = "revenues"
for _day in range(1, 8):
    view(
        f"path_{_day}",
        "SELECT *, list_append(p, list_avg(p[-7:])) AS q FROM (SELECT product_id, "
        + ("revenues AS p FROM tail_m)" if _day == 1 else f"q AS p FROM path_{_day - 1})"),
    )
view(
    "future_m",
    "SELECT CAST((SELECT MAX(sales_date) FROM features_m) + day AS DATE) AS sales_date, product_id, category_id, "
    "q[len(revenues) + day] AS revenue, s[-1] AS lag_1, CASE WHEN len(s) >= 7 THEN s[-7] ELSE list_avg(s) END AS lag_7, "
    "list_avg(s[-7:]) AS rolling_mean_7, list_avg(s[-30:]) AS rolling_mean_30 FROM ("
    "SELECT product_id, category_id, revenues, q, CAST(day AS INTEGER) AS day, "
    "list_concat(units, list_transform(range(day - 1), lambda x: 0.0)) AS s "
    "FROM tail_m JOIN path_7 USING (product_id), range(1, 8) AS r(day))",
)


def daily_sales_of(t: Inputs) -> DataFrame:
    return forecast.daily_product_sales(t["orders_m"], t["order_items_m"], t["products_m"])


def features_of(t: Inputs) -> DataFrame:
    return forecast.add_features(daily_sales_of(t))


_SERIES_KEY = ["sales_date", "product_id"]
check("agg_daily_product_sales", "SELECT * FROM sales_m")(daily_sales_of)
check("join_ml_sales", "SELECT sales_date, product_id, category_id FROM sales_m")(
    lambda t: daily_sales_of(t).select("sales_date", "product_id", "category_id")
)
check("ts_features", "SELECT * FROM features_m")(features_of)
# Every product with an even number is sold under number 0, which then has half of all rows.
view(
    "hot_sales_m",
    "SELECT sales_date, CASE WHEN product_id % 2 = 0 THEN 0 ELSE product_id END AS product_id, category_id, "
    "SUM(units_sold) AS units_sold, SUM(revenue) AS revenue FROM sales_m GROUP BY ALL",
)
view("hot_series_m", VIEWS["series_m"].replace("sales_m", "hot_sales_m"))


@check(
    "ts_features_hot",
    "SELECT sales_date, product_id, category_id, units_sold, coalesce(l1, m, 0) AS lag_1, coalesce(l7, m, 0) AS lag_7, "
    "round(coalesce(r7, m, 0), 6) AS rolling_mean_7, round(coalesce(r30, m, 0), 6) AS rolling_mean_30 FROM hot_series_m",
)
def ts_features_hot(t: Inputs) -> DataFrame:
    """Features of series in blocks, each with the rows before it."""
    product = F.when(F.col("product_id") % 2 == 0, 0).otherwise(F.col("product_id")).cast("bigint")
    daily = daily_sales_of(t).withColumn("product_id", product)
    daily = daily.groupBy("sales_date", "product_id", "category_id").agg(F.sum("units_sold").alias("units_sold"), F.sum("revenue").alias("revenue"))
    rows = forecast.add_features(daily, block_rows=1000)
    means = [F.round(name, 6).alias(name) for name in ("rolling_mean_7", "rolling_mean_30")]
    return rows.select("sales_date", "product_id", "category_id", "units_sold", "lag_1", "lag_7", *means)


check("ts_lag_1", "SELECT sales_date, product_id, l1 AS result FROM series_m")(
    lambda t: daily_sales_of(t).select(*_SERIES_KEY, forecast.lag_of("units_sold", 1).alias("result"))
)
check("ts_lag_7", "SELECT sales_date, product_id, l7 AS result FROM series_m")(
    lambda t: daily_sales_of(t).select(*_SERIES_KEY, forecast.lag_of("units_sold", 7).alias("result"))
)
check("ts_rolling_mean_7", "SELECT sales_date, product_id, r7 AS result FROM series_m")(
    lambda t: daily_sales_of(t).select(*_SERIES_KEY, forecast.rolling_mean("units_sold", 7).alias("result"))
)
check("ts_rolling_mean_30", "SELECT sales_date, product_id, r30 AS result FROM series_m")(
    lambda t: daily_sales_of(t).select(*_SERIES_KEY, forecast.rolling_mean("units_sold", 30).alias("result"))
)
check("ts_fallback_mean", "SELECT sales_date, product_id, coalesce(l7, m, 0) AS result FROM series_m")(
    lambda t: daily_sales_of(t).select(
        *_SERIES_KEY,
        forecast.or_series_mean(forecast.lag_of("units_sold", 7), "units_sold").alias("result"),
    )
)
check("latest_category_per_product", "SELECT product_id, category_id FROM tail_m")(
    lambda t: forecast.latest_category(features_of(t))
)
check(
    "history_tail",
    "SELECT product_id, category_id, array_to_string(list_transform(units, lambda x: CAST(x AS BIGINT)), ',') AS units, "
    "array_to_string(list_transform(revenues, lambda x: CAST(round(x * 100) AS BIGINT)), ',') AS revenues FROM tail_m",
)(
    lambda t: forecast.history_tail(features_of(t)).select(
        "product_id", "category_id",
        F.array_join(F.transform("units", lambda x: x.cast("bigint")), ",").alias("units"),
        F.array_join(F.transform("revenues", lambda x: F.round(x * 100).cast("bigint")), ",").alias("revenues"),
    )
)
_FUTURE = "sales_date, product_id, category_id, lag_1, lag_7, rolling_mean_7, rolling_mean_30"
check("ml_future_features", f"SELECT {_FUTURE}, round(revenue, 4) AS revenue FROM future_m")(
    lambda t: forecast.future_features(features_of(t)).select(
        *_FUTURE.split(", "), F.round("revenue", 4).alias("revenue")
    )
)
check(
    "concat_history_forecast",
    "SELECT sales_date, product_id, units_sold FROM features_m UNION ALL SELECT sales_date, product_id, 0.0 FROM future_m",
)(
    lambda t: forecast.with_forecast(
        features_of(t), forecast.future_features(features_of(t))
    ).select("sales_date", "product_id", "units_sold")
)
check(
    "ml_time_split",
    "SELECT sales_date, product_id, CASE WHEN sales_date <= (SELECT MAX(sales_date) FROM sales_m) - 14 "
    "THEN 'train' ELSE 'test' END AS part FROM sales_m",
)(
    lambda t: (lambda train, test: train.select(*_SERIES_KEY, F.lit("train").alias("part")).union(
        test.select(*_SERIES_KEY, F.lit("test"))
    ))(*forecast.time_split(features_of(t)))
)
check(
    "ml_evaluate",
    "SELECT round(AVG(abs(units_sold - lag_1)), 6) AS mae, round(sqrt(AVG((units_sold - lag_1) * (units_sold - lag_1))), 6) AS rmse, "
    "round(1 - AVG((units_sold - lag_1) * (units_sold - lag_1)) / VAR_POP(units_sold), 6) AS r2 FROM features_m",
)(
    lambda t: forecast.evaluate(features_of(t), "units_sold", "lag_1").select(
        *[F.round(name, 6).alias(name) for name in ("mae", "rmse", "r2")]
    )
)


def _vector_columns(df: DataFrame, name: str) -> DataFrame:
    from pyspark.ml.functions import vector_to_array

    values = vector_to_array(F.col(name))
    return df.select(*_SERIES_KEY, *[values[i].alias(f"f_{f}") for i, f in enumerate(forecast.FEATURES)])


check(
    "ml_feature_vector",
    "SELECT sales_date, product_id, "
    + ", ".join(f"CAST({name} AS DOUBLE) AS f_{name}" for name in forecast.FEATURES) + " FROM features_m",
)(lambda t: _vector_columns(forecast.feature_vector(features_of(t)), "raw_features"))


@check(
    "ml_scale",
    "SELECT sales_date, product_id, "
    + ", ".join(
        f"round((CAST({name} AS DOUBLE) - AVG({name}) OVER ()) / STDDEV_SAMP({name}) OVER (), 4) + 0.0 AS f_{name}"
        for name in forecast.FEATURES
    ) + " FROM features_m",
)
def ml_scale(t: Inputs) -> DataFrame:
    rows = forecast.feature_vector(features_of(t))
    scaled = _vector_columns(forecast.scaler().fit(rows).transform(rows), "features")
    return scaled.select(*_SERIES_KEY, *[(F.round(f"f_{f}", 4) + 0.0).alias(f"f_{f}") for f in forecast.FEATURES])


def stored_features(t: Inputs) -> DataFrame:
    return Staging(t.spark, fresh_folder(t.spark, "features")).store(features_of(t), "features")


def in_range(predicted: DataFrame, training: DataFrame, name: str) -> DataFrame:
    """Whether each prediction lies between the smallest and the largest label the forest was trained on."""
    bounds = training.agg(F.min("units_sold").alias("lo"), F.max("units_sold").alias("hi")).first()
    return predicted.withColumn("in_range", F.coalesce(F.col(name).between(bounds["lo"] - 1e-9, bounds["hi"] + 1e-9), F.lit(False)))


_FORECAST = "sales_date, product_id, category_id, lag_1, rolling_mean_7, rolling_mean_30, TRUE AS in_range"
_FORECAST_COLUMNS = "sales_date product_id category_id lag_1 rolling_mean_7 rolling_mean_30 in_range".split()


@check(
    "ml_train_rf",
    "SELECT sales_date, product_id, units_sold, TRUE AS in_range FROM features_m "
    "WHERE sales_date > (SELECT MAX(sales_date) FROM sales_m) - 14",
)
def ml_train_rf(t: Inputs) -> DataFrame:
    train, test = forecast.time_split(stored_features(t))
    scored = in_range(forecast.fit(train).transform(test), train, "prediction")
    return scored.select(*_SERIES_KEY, "units_sold", "in_range")


def predictions_of(t: Inputs) -> DataFrame:
    features = stored_features(t)
    predicted = forecast.predict(forecast.fit(features), features)
    return in_range(predicted, features, "predicted_units_sold").select(*_FORECAST_COLUMNS)


def stored_predictions(t: Inputs) -> DataFrame:
    """Stored, since a sort asks for its rows twice."""
    return Staging(t.spark, fresh_folder(t.spark, "forecast")).store(predictions_of(t), "predictions")


check("ml_predict", f"SELECT {_FORECAST} FROM future_m")(lambda t: forecast.present_predictions(stored_predictions(t)))


@check("forecast_for_product", f"SELECT {_FORECAST}, (SELECT COUNT(DISTINCT product_id) FROM future_m) AS products FROM future_m WHERE product_id = 7")
def forecast_for_product(t: Inputs) -> DataFrame:
    """One product's forecast, beside the number of products that can be chosen."""
    predicted = stored_predictions(t)
    products = F.lit(forecast.forecast_products(predicted).count()).cast("bigint")
    return forecast.forecast_for_product(predicted, 7).withColumn("products", products)


_LATE = "sales_date > (SELECT MAX(sales_date) FROM sales_m) - 14"


@check(
    "pipe_ml",
    f"SELECT {_FORECAST}, (SELECT COUNT(*) FROM features_m WHERE NOT {_LATE}) AS train_rows, (SELECT COUNT(*) FROM features_m WHERE {_LATE}) AS test_rows, "
    f"(SELECT round(AVG(abs(units_sold - lag_1)), 6) FROM features_m WHERE {_LATE}) AS lag_1_mae, TRUE AS beats_lag_1, TRUE AS beats_mean FROM future_m",
)
def pipe_ml(t: Inputs) -> DataFrame:
    """Train, evaluate, store, load again, predict, save and read the saved forecast; errors beside those of two plain guesses."""
    features = stored_features(t)
    model, metrics = forecast.train_and_evaluate(features)
    train, test = forecast.time_split(features)
    mean = train.agg(F.avg("units_sold")).first()[0]
    lag = forecast.evaluate(test, "units_sold", "lag_1").first()
    guess = forecast.evaluate(test.withColumn("mean", F.lit(mean)), "units_sold", "mean").first()
    store = forecast.ModelStore(t.spark, fresh_folder(t.spark, "models"))
    store.save_model(model, metrics)
    store.save_table(forecast.predict(store.load_model(), features), "predictions", fmt="parquet")
    saved = t.spark.read.parquet(f"{store.root}/predictions/{store.latest('predictions')}")
    rows = in_range(saved, train, "predicted_units_sold").select(*_FORECAST_COLUMNS)
    kept = store.metrics()
    return rows.withColumns({
        "train_rows": F.lit(kept["train_rows"]).cast("bigint"),
        "test_rows": F.lit(kept["test_rows"]).cast("bigint"),
        "lag_1_mae": F.round(F.lit(lag.mae), 6),
        "beats_lag_1": F.lit(kept["mae"] < lag.mae),
        "beats_mean": F.lit(kept["mae"] < guess.mae),
    })


@check(
    "sink_features_csv",
    "SELECT CAST(sales_date AS VARCHAR) AS sales_date, product_id, category_id, units_sold, round(revenue, 4) AS revenue, lag_1, lag_7 FROM features_m",
)
def sink_features_csv(t: Inputs) -> DataFrame:
    """Features saved as CSV with a header, and read back."""
    store = forecast.ModelStore(t.spark, fresh_folder(t.spark, "features"))
    store.save_table(stored_features(t), "features", fmt="csv")
    saved = t.spark.read.csv(f"{store.root}/features/{store.latest('features')}", header=True)
    return saved.selectExpr(
        "sales_date", "CAST(product_id AS BIGINT) AS product_id", "CAST(category_id AS BIGINT) AS category_id", "CAST(units_sold AS DOUBLE) AS units_sold",
        "round(CAST(revenue AS DOUBLE), 4) AS revenue", "CAST(lag_1 AS DOUBLE) AS lag_1", "CAST(lag_7 AS DOUBLE) AS lag_7",
    )
