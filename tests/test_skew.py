"""One key holds a third of the rows or more: results stay whole and no task gets the whole group."""

import collections
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from sluicebox.operators import keys, series
from sluicebox.plans import forecast, gold, silver
from sluicebox.streaming import metrics

SMALL_PARTITIONS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.shuffle.partitions": "16",
}


@contextmanager
def settings(spark, values):
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.fixture
def child(spark):
    """60,000 rows from 8 tasks; key 7 and NULL hold a third each."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, None).otherwise(F.col("id") % 5000)
    return spark.range(0, 60000, 1, 8).select(
        key.alias("order_id"), F.col("id").alias("payment_id"), F.sha2(F.col("id").cast("string"), 256).alias("wide")
    )


def test_hot_keys_of_a_unique_parent_are_split(spark, child):
    parent = spark.range(0, 4000).select(F.col("id").alias("order_id"), (F.col("id") * 1.0).alias("order_total"))
    with settings(spark, SMALL_PARTITIONS):
        joined = keys.with_parent(
            child, parent, "order_id", "order_id", "missing", {"order_total": "total"}, unique_parent=True
        )
        assert "skew=true" in final_plan(joined)
        assert joined.count() == 60000
        assert joined.filter("order_id = 7 AND total = 7.0").count() == child.filter("order_id = 7").count() > 20000
        expected = keys.with_parent(child, parent, "order_id", "order_id", "missing", {"order_total": "total"})
        assert joined.exceptAll(expected).count() == 0


def test_many_orphans_are_joined_with_hot_keys_split(spark, child, folder):
    parent = spark.range(8, 4000).select(F.col("id").alias("order_id"))
    keys.orphan_keys(child, parent, "order_id", "order_id").write.parquet(f"{folder}/orphans")
    orphans = spark.read.parquet(f"{folder}/orphans")
    with settings(spark, SMALL_PARTITIONS):
        marked = keys.with_orphans(child, orphans.hint("broadcast"), "order_id", "missing")
        assert "BroadcastHashJoin" in final_plan(marked)
        split = keys.with_orphans(child, orphans, "order_id", "missing")
        assert "skew=true" in final_plan(split)
    assert split.exceptAll(marked).count() == 0
    assert marked.filter("missing").count() == child.filter("order_id < 8 OR order_id >= 4000").count()


def test_hot_product_and_hot_category(spark):
    items = spark.range(0, 60000, 1, 8).select(
        F.col("id").alias("order_item_id"),
        (F.col("id") % 9000).alias("order_id"),
        F.when(F.col("id") % 2 == 0, 3).otherwise(F.col("id") % 500).alias("product_id"),
        F.lit(2).cast("bigint").alias("quantity"),
        (F.col("id") % 97 + 0.25).alias("unit_price"),
        F.lit(0.0).alias("discount"),
        (F.col("id") % 89 + 0.5).alias("item_total"),
    )
    orders = spark.range(9000).select(
        F.col("id").alias("order_id"), F.lit("shipped").alias("order_status"), F.to_date(F.lit("2026-01-01")).alias("order_date")
    )
    products = spark.range(500).select(
        F.col("id").alias("product_id"), F.concat(F.lit("p"), F.col("id")).alias("product_name"),
        (F.col("id") % 2).alias("category_id"), F.lit(4.0).alias("rating"),
    )
    categories = spark.createDataFrame([(0, "a"), (1, "b")], "category_id bigint, category_name string")
    with settings(spark, SMALL_PARTITIONS):
        category = gold.category_performance(orders, items, products, categories)
        assert "skew=true" in final_plan(category)
        revenue = {r.category_id: r.revenue for r in category.collect()}
        sums = gold.sold_sums(orders, items, "product_id")
        product = gold.product_performance(sums, products, categories).filter("product_id = 3").first()
    plain = items.join(products, "product_id").groupBy("category_id").agg(F.sum("item_total").alias("t"))
    assert revenue == {r.category_id: r.t for r in plain.collect()}
    hot = items.filter("product_id = 3").agg(F.sum("item_total"), F.count("*") * 2).first()
    assert (product.net_revenue, product.units_sold) == tuple(hot)


def test_hot_window_is_counted_by_customer(spark):
    """Half of all events fall into one minute; distinct customers are still counted, not gathered."""
    events = spark.range(0, 40000, 1, 8).select(
        F.col("id").cast("string").alias("event_id"),
        (F.col("id") % 3000).alias("customer_id"),
        F.lit("purchase_completed").alias("event_type"),
        F.lit(1.25).alias("price"),
        F.lit(2).cast("bigint").alias("quantity"),
        F.timestamp_seconds(F.when(F.col("id") % 2 == 0, 1_800_000_000).otherwise(1_800_000_000 + F.col("id"))).alias("event_timestamp"),
    )
    busiest = metrics.realtime_metrics(events).orderBy(F.desc("orders_per_window")).first()
    inside = events.filter(
        (F.col("event_timestamp") >= F.lit(busiest.window_start)) & (F.col("event_timestamp") < F.lit(busiest.window_end))
    )
    expected = inside.agg(F.count("*"), F.countDistinct("customer_id"), F.sum(F.col("price") * 2)).first()
    assert (busiest.orders_per_window, busiest.active_users, busiest.revenue_per_window) == tuple(expected)


def test_hot_bronze_key_reaches_silver_once(spark, folder):
    """A category sent 20,000 times among others becomes one row; the file filter on dates is pushed down."""
    rows = spark.range(0, 30000, 1, 8).select(
        F.when(F.col("id") < 20000, 1).otherwise(F.col("id")).cast("string").alias("category_id"),
        F.lit("n").alias("category_name"), F.lit("d").alias("department"),
        F.timestamp_seconds(F.col("id")).alias("ingestion_timestamp"), F.lit("b").alias("batch_id"),
        F.md5(F.col("id").cast("string")).alias("record_hash"),
    )
    rows.write.parquet(f"{folder}/bronze/categories")
    (counts,) = silver.refine(spark, f"{folder}/bronze", f"{folder}/silver", f"{folder}/q", ["categories"])
    assert (counts.read, counts.written, counts.rejected) == (30000, 10001, 0)


# ---- long series ------------------------------------------------------------------------------------------


@pytest.fixture
def daily(spark):
    """Sales of 41 products; one of them has half of all rows, one has no number, many have one or two rows."""
    product = F.when(F.col("id") % 2 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(100 + F.col("id") % 39)
    days = F.expr("date_add(DATE'2020-01-01', CAST(id div 3 AS INT))")
    rows = spark.range(0, 12000, 1, 8).select(
        days.alias("sales_date"), product.alias("product_id"), (F.col("id") % 3).alias("category_id"),
        (F.col("id") * 37 % 11).cast("double").alias("units_sold"), (F.col("id") % 100).cast("double").alias("revenue"),
    )
    few = spark.range(200).selectExpr("DATE'2021-05-05' AS sales_date", "id + 1000 AS product_id", "id AS category_id", "2.0D AS units_sold", "NULL AS revenue")
    return rows.unionByName(few)


@pytest.mark.parametrize("block_rows", [30, 31, 500, 100_000])
def test_series_in_blocks_equal_whole_series(spark, daily, block_rows):
    plain, blocks = forecast.add_features(daily), forecast.add_features(daily, block_rows)
    assert blocks.columns == plain.columns
    assert blocks.count() == plain.count() == daily.count()
    assert blocks.exceptAll(plain).count() == 0


def test_a_product_with_half_of_all_rows_is_spread(spark, daily):
    with settings(spark, SMALL_PARTITIONS | {"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        features = forecast.add_features(daily, 250)
        plan = final_plan(features)
        assert "hashpartitioning(_block" in plan and "skew=true" in plan
        placed = features.withColumn("task", F.spark_partition_id()).collect()
        tasks = collections.Counter(r.task for r in placed if r.product_id == 7)
        assert sum(tasks.values()) == 6000 and len(tasks) >= 2 and max(tasks.values()) <= 4000
        # where the windows run, a task's rows of the product are whole blocks of 280 rows at most
        blocks = series.with_halo(daily, ["product_id"], ["sales_date", "category_id"], 250, 30)
        sizes = blocks.repartition(16, "_block", "product_id").groupBy(F.spark_partition_id().alias("task"), "_block", "product_id").count().collect()
        mine = [r for r in sizes if r.product_id == 7]
        assert max(r["count"] for r in mine) <= 280 and len({r.task for r in mine}) >= 8
        plain = forecast.add_features(daily).withColumn("task", F.spark_partition_id()).collect()
        assert len({r.task for r in plain if r.product_id == 7}) == 1


def test_stored_sales_choose_blocks_by_their_longest_series(spark, daily, monkeypatch):
    assert "_block" not in final_plan(forecast.features_of_stored(daily))
    monkeypatch.setattr(forecast, "SERIES_ROWS", 300)
    features = forecast.features_of_stored(daily)
    assert "_block" in final_plan(features)
    assert features.exceptAll(forecast.add_features(daily)).count() == 0
    assert forecast.features_of_stored(daily.limit(0)).count() == 0


def test_a_block_is_no_shorter_than_its_halo(daily):
    with pytest.raises(ValueError, match="halo"):
        forecast.add_features(daily, 29)
