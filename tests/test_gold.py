from datetime import date

import pytest
from pyspark.sql import functions as F

from sluicebox import contracts
from sluicebox.functions import business, dates, numbers
from sluicebox.operators.quality import contract_report, contract_violations
from sluicebox.plans import gold, kpi, serving
from sluicebox.sources.storage import read_table, staging

DAY = date(2026, 7, 20)


@pytest.fixture
def orders(spark):
    return spark.createDataFrame(
        [
            (1, 101, DAY, "delivered", 100.0),
            (2, 102, DAY, "cancelled", 50.0),
            (3, 101, DAY, "processing", 25.0),
            (4, 103, date(2026, 7, 21), "returned", 90.0),
            (5, 104, date(2026, 7, 21), None, 70.0),
        ],
        "order_id bigint, customer_id bigint, order_date date, order_status string, order_total double",
    )


@pytest.fixture
def items(spark):
    return spark.createDataFrame(
        [
            (1, 1, 11, 2, 10.0, 1.0, 19.0),
            (2, 2, 11, 1, 10.0, 0.0, 10.0),
            (3, 3, 12, 4, 2.5, 0.5, 9.5),
            (4, 4, 12, 1, 2.5, 0.0, 2.5),
            (5, 1, 99, 1, 1.0, 0.0, 1.0),
        ],
        "order_item_id bigint, order_id bigint, product_id bigint, quantity bigint, unit_price double, discount double, item_total double",
    )


@pytest.fixture
def products(spark):
    return spark.createDataFrame(
        [(11, "ring", 1, 4.0), (12, "bolt", 2, None)],
        "product_id bigint, product_name string, category_id bigint, rating double",
    )


@pytest.fixture
def categories(spark):
    return spark.createDataFrame([(1, "Jewels")], "category_id bigint, category_name string")


@pytest.mark.parametrize("unique", [False, True])
def test_daily_sales_counts_revenue_orders_only(orders, items, unique):
    (row,) = gold.daily_sales_summary(orders, items.drop("product_id"), unique).collect()
    assert row.asDict() == {
        "sales_date": DAY, "total_orders": 2, "total_revenue": 125.0, "total_items_sold": 7,
        "average_order_value": 62.5, "unique_customers": 1,
    }


def test_order_without_items_counts_zero_items(spark, orders, items):
    (row,) = gold.daily_sales_summary(orders, items.limit(0)).collect()
    assert (row.total_orders, row.total_items_sold) == (2, 0)


def test_product_performance(orders, items, products, categories):
    days = gold.product_days(orders, items)
    rows = {r.product_id: r for r in gold.product_performance(days, products, categories).collect()}
    assert set(rows) == {11, 12, 99}
    assert tuple(rows[11])[1:] == ("ring", "Jewels", 2, 20.0, 1.0, 19.0, 4.0)
    assert tuple(rows[12])[1:] == ("bolt", None, 4, 10.0, 0.5, 9.5, None)
    assert tuple(rows[99])[1:] == (None, None, 1, 1.0, 0.0, 1.0, None)


def test_product_listed_twice_counts_as_if_joined_first(spark, orders, items, categories):
    twice = spark.createDataFrame(
        [(11, "ring", 1, 4.0), (11, "ring", 1, 1.0)],
        "product_id bigint, product_name string, category_id bigint, rating double",
    )
    sums = gold.sold_sums(orders, items, "product_id")
    row = gold.product_performance(sums, twice, categories).filter("product_id = 11").first()
    assert (row.units_sold, row.net_revenue, row.average_rating) == (4, 38.0, 2.5)


def test_category_performance_keeps_unknown_categories(orders, items, products, categories):
    rows = {r.category_id: tuple(r)[1:] for r in gold.category_performance(orders, items, products, categories).collect()}
    assert rows == {1: ("Jewels", 1, 2, 19.0, 19.0), 2: (None, 1, 4, 9.5, 9.5), None: (None, 1, 1, 1.0, 1.0)}


def test_customer_360_keeps_customers_without_orders(spark, orders):
    customers = spark.createDataFrame(
        [(101, "A", "gold"), (102, "B", "unknown")], "customer_id bigint, customer_name string, customer_segment string"
    )
    rows = {r.customer_id: tuple(r)[2:] for r in gold.customer_360(customers, orders, "2026-07-30").collect()}
    assert rows == {101: (2, 125.0, 62.5, DAY, 10, "gold"), 102: (0, 0.0, 0.0, None, None, "unknown")}


def test_current_date_is_the_default(spark):
    row = spark.range(1).select(dates.today_or(None) == F.current_date(), dates.today_or("2020-02-03")).first()
    assert tuple(row) == (True, date(2020, 2, 3))


def test_velocity_averages_days_with_sales(spark, orders, items, products):
    stock = spark.createDataFrame(
        [(11, "W", 10, 5), (12, "W", 3, 5), (99, "W", 0, 5)],
        "product_id bigint, warehouse_id string, stock_quantity bigint, reorder_level bigint",
    )
    days = gold.product_days(orders, items)
    rows = {r.product_id: tuple(r)[4:] for r in gold.inventory_health(stock, products, days, "2026-07-30").collect()}
    assert rows == {11: ("healthy", 5.0), 12: ("low_stock", 0.8), 99: ("out_of_stock", 0.0)}
    later = gold.inventory_health(stock, products, days, "2026-12-30")
    assert {r.estimated_days_remaining for r in later.collect()} == {None}


def test_money_is_exact_and_halves_round_up(spark):
    rows = spark.createDataFrame([(0.01,), (0.02,), (None,)], "v double")
    value = numbers.total(numbers.money("v"))
    total, mean = rows.select(value.double(), value.ratio(numbers.count_of("v"), 2)).first()
    assert total == 0.03 and mean == 0.02  # 0.015 rounds up; NULL stays out
    big = spark.range(100).select(F.lit(9.0e10).alias("v"), F.lit(-123.4567).alias("w"))
    assert big.select(numbers.total(numbers.money("v")).double()).first()[0] == 9.0e12
    assert float(big.select(numbers.total(numbers.money("w")).exact).first()[0]) == -12345.67


def test_money_of_any_size_reaches_totals(spark):
    nan, inf = float("nan"), float("inf")

    def sums(*values):
        rows = spark.createDataFrame([(v,) for v in values], "v double")
        value = numbers.total(numbers.money("v"))
        return tuple(rows.select(value.rounded(), value.ratio(numbers.count_of("v"), 2)).first())

    assert sums(1e15, 10.0) == (1e15 + 10, round((1e15 + 10) / 2, 2))
    assert sums(1e300, 5.0, None)[0] == 1e300
    assert sums(inf, 1.0) == (inf, inf) and all(x != x for x in sums(nan, 1e15, 10.0))
    assert sums(None) == (None, None)
    item = spark.createDataFrame([(10**15, 5.0), (2, 3.25), (10**15, nan), (None, 1.0)], "q bigint, p double")
    product = numbers.total(numbers.money("p").times(F.col("q")))
    assert item.where("not isnan(p)").select(product.rounded()).first()[0] == 5e15 + 6.5
    assert item.select(product.rounded()).first()[0] != item.select(product.rounded()).first()[0]


def test_gold_keeps_large_and_odd_amounts(spark):
    orders = spark.createDataFrame(
        [(1, 7, "2026-01-01", "delivered", "paid", 1e15), (2, 7, "2026-01-01", "delivered", "paid", 10.0), (3, 8, "2026-01-02", "delivered", "paid", float("nan"))],
        "order_id bigint, customer_id bigint, order_date string, order_status string, payment_status string, order_total double",
    ).withColumn("order_date", F.to_date("order_date"))
    items = spark.createDataFrame(
        [(1, 5, 10**15, 5.0, 0.0, 5e15), (2, 5, 1, 2.5, 0.5, 2.0)],
        "order_id bigint, product_id bigint, quantity bigint, unit_price double, discount double, item_total double",
    )
    days = {str(r.sales_date): r for r in gold.daily_sales_summary(orders, items).collect()}
    assert days["2026-01-01"].total_revenue == 1e15 + 10 and days["2026-01-01"].total_orders == 2
    assert days["2026-01-02"].total_revenue != days["2026-01-02"].total_revenue
    products = spark.createDataFrame([(5, 1, "p", 4.5)], "product_id bigint, category_id bigint, product_name string, rating double")
    names = spark.createDataFrame([(1, "c")], "category_id bigint, category_name string")
    row = gold.product_performance(gold.sold_sums(orders, items, "product_id"), products, names).first()
    assert row.gross_revenue == 5e15 + 2.5 and row.net_revenue == 5e15 + 2 and row.discount_amount == 0.5
    assert gold.category_performance(orders, items, products, names).first().revenue == 5e15 + 2
    customers = spark.createDataFrame([(7, "a", "s"), (8, "b", "s"), (9, "c", "s")], "customer_id bigint, customer_name string, customer_segment string")
    value = {r.customer_id: r.lifetime_value for r in gold.customer_360(customers, orders, "2026-01-03").collect()}
    assert value[7] == 1e15 + 10 and value[8] != value[8] and value[9] == 0.0


def test_rates_guard_zero_and_may_be_negative(spark):
    rows = spark.createDataFrame(
        [(0, 0, 0), (3, 1, 2), (1, 2, 3)], "orders_per_window bigint, payment_failures bigint, add_to_cart_events bigint"
    )
    got = rows.select(business.payment_failure_rate(), business.cart_abandonment_rate()).collect()
    assert [tuple(r) for r in got] == [(0.0, 0.0), (0.25, -0.5), (0.6667, 0.6667)]


def test_hot_product_is_summed_before_the_shuffle(orders, items, products, categories):
    plan = gold.product_performance(gold.sold_sums(orders, items, "product_id"), products, categories)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    assert "partial_sum(quantity" in text


def test_unique_orders_need_no_expand(orders, items):
    plain = gold.daily_sales_summary(orders, items, True)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plain


def _silver(spark, orders, items, products, categories):
    return {
        "orders": orders, "order_items": items, "products": products, "categories": categories,
        "customers": spark.createDataFrame([(101, "A", "gold")], "customer_id bigint, customer_name string, customer_segment string"),
        "inventory": spark.createDataFrame(
            [(11, "W", 10, 5)], "product_id bigint, warehouse_id string, stock_quantity bigint, reorder_level bigint"
        ),
    }


def test_gold_pipeline_serving_and_kpis(spark, folder, orders, items, products, categories):
    for name, df in _silver(spark, orders, items, products, categories).items():
        df.write.parquet(f"{folder}/silver/{name}")
    built = gold.build_all(spark, f"{folder}/silver", f"{folder}/gold", as_of="2026-07-30")
    assert {b.table: b.written for b in built} == {
        "daily_sales_summary": 1, "product_performance": 3, "category_performance": 3, "customer_360": 1, "inventory_health": 1,
    }
    target = serving.FileTarget(f"{folder}/serving")
    for _ in range(2):
        loads = serving.load_serving(spark, f"{folder}/gold", target)
    assert [(x.table, x.rows) for x in loads] == [(b.table, b.written) for b in built]
    served = read_table(spark, f"{folder}/serving/customer_360")
    assert served.dtypes == [(f.name, f.dataType.simpleString()) for f in contracts.serving_table("customer_360").schema]
    with pytest.raises(ValueError, match="users"):
        serving.load_serving(spark, f"{folder}/gold", target, ["users"])
    with pytest.raises(FileNotFoundError, match="realtime_metrics"):
        serving.load_serving(spark, f"{folder}/gold", target, ["realtime_metrics"])
    with pytest.raises(ValueError, match="users"):
        gold.build_all(spark, f"{folder}/silver", f"{folder}/gold", ["users"])

    frames = {b.table: read_table(spark, f"{folder}/gold/{b.table}") for b in built}
    frames["realtime_metrics"] = spark.createDataFrame([], contracts.serving_table("realtime_metrics").schema)
    board = kpi.dashboard(frames, limit=2)
    assert list(board) == [
        "overview_kpis", "daily_sales", "monthly_sales", "product_performance", "category_performance",
        "customer_360", "customer_segments", "inventory_health", "inventory_status", "realtime_metrics",
    ]
    assert [r.product_id for r in board["product_performance"].collect()] == [11, 12]
    assert board["monthly_sales"].first().sales_month == date(2026, 7, 1)
    for limit in (0, 501):
        with pytest.raises(ValueError):
            kpi.dashboard(frames, limit)


def test_many_products_are_not_broadcast(spark, folder, monkeypatch, orders, items, products, categories):
    """However small their files are: what a broadcast takes in the driver follows the rows."""
    silver = _silver(spark, orders, items, products, categories)
    for name in silver:
        silver[name].write.option("compression", "zstd").parquet(f"{folder}/{name}")
        silver[name] = spark.read.parquet(f"{folder}/{name}")
    chosen = ["category_performance", "inventory_health"]
    with staging(spark, "gold") as stage:
        few = {table: sorted(map(str, df.collect())) for table, df in gold._built(stage, silver, chosen, "2026-07-30").items()}
        monkeypatch.setattr(gold, "BROADCAST_PRODUCTS", products.count() - 1)
        for table, df in gold._built(stage, silver, chosen, "2026-07-30").items():
            joins = [line for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if "Join" in line]
            assert any("SortMergeJoin [product_id" in line for line in joins)
            assert sorted(map(str, df.collect())) == few[table] != []


def test_overview_of_nothing_is_zero(spark):
    empty = spark.createDataFrame([], contracts.serving_table("daily_sales_summary").schema)
    assert tuple(kpi.overview(empty).first()) == (0.0, 0, 0, 0.0, 0)


def test_date_range_is_inclusive_and_optional(spark):
    rows = spark.sql("SELECT DATE '2026-01-01' + CAST(id AS INT) AS d FROM range(5)")
    assert kpi.in_date_range(rows, "d", "2026-01-02", "2026-01-04").count() == 3
    assert kpi.in_date_range(rows, "d", None, "2026-01-04").count() == 5
    assert tuple(kpi.date_bounds(rows, "d").first()) == (date(2026, 1, 1), date(2026, 1, 5))


def test_serving_contracts():
    assert set(contracts.SERVING_TABLES) == {*contracts.BATCH_GOLD, "realtime_metrics"}
    assert contracts.serving_table("daily_sales_summary").columns[0] == "sales_date"
    with pytest.raises(ValueError, match="users"):
        contracts.serving_table("users")


def test_contract_violations_are_counted(spark):
    table = contracts.serving_table("inventory_health")
    rows = spark.createDataFrame(
        [(1, "a", 1, 1, "x" * 51, None), (1, None, 1, 1, "ok", None), (2, "b", None, 1, "ok", None)],
        "product_id bigint, product_name string, stock_quantity bigint, reorder_level bigint, inventory_status string, estimated_days_remaining double",
    )
    got = {r.rule: r.violations for r in contract_violations(rows, table).collect()}
    assert got == {
        "not_null:product_name": 1, "not_null:stock_quantity": 1, "max_length:inventory_status": 1, "unique:product_id": 1,
    }


def test_a_failed_overwrite_keeps_the_old_table(spark, folder):
    import os

    from sluicebox.sources.storage import read_table, write_counted

    path = f"{folder}/gold/table"
    assert write_counted(spark.range(10), path, "overwrite")["rows"] == 10
    broken = spark.range(0, 1000, 1, 8).select(F.when(F.col("id") > 900, F.raise_error(F.lit("half-way"))).otherwise(F.col("id")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="half-way"):
        write_counted(broken, path, "overwrite")
    assert sorted(r.id for r in read_table(spark, path).collect()) == list(range(10))
    assert write_counted(spark.range(3), path, "overwrite")["rows"] == 3
    assert read_table(spark, path).count() == 3 and os.listdir(f"{folder}/gold") == ["table"]


def test_contract_report_equals_the_checks_of_each_table(spark, folder):
    """Nulls, lengths and repeated keys of several tables from one stack; colliding hashes are told apart from repeats."""
    def frame(name, rows):
        schema = contracts.serving_table(name).schema
        loose = type(schema)([type(f)(f.name, f.dataType, True) for f in schema])
        return spark.createDataFrame(rows, loose)

    frames = {
        "inventory_health": frame("inventory_health", [(1, "a", 1, 1, "x" * 51, None), (1, "b" * 256, None, 1, "ok", 1.0), (None, None, 1, 1, "ok", None), (None, "c", 1, 1, None, None)] + [(7, "h", 1, 1, "ok", None)] * 50),
        "daily_sales_summary": frame("daily_sales_summary", [(date(2026, 1, d), 1, 1.0, 1, 1.0, 1) for d in range(1, 20)]),
        "category_performance": frame("category_performance", []),
    }
    expected = sorted(tuple(r) for name, df in frames.items() for r in contract_violations(df, contracts.serving_table(name)).collect())
    with staging(spark, "report") as stage:
        assert sorted(tuple(r) for r in contract_report(frames, stage).collect()) == expected
    assert ("inventory_health", "unique:product_id", 51) in expected and len(expected) == 7
    fine = {name: df.limit(0) for name, df in frames.items()}
    with staging(spark, "report") as stage:
        assert contract_report(fine, stage).collect() == []
