"""Wall time of the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from checks import catalog

HEADLINE = (
    "gold_daily_sales_summary gold_product_performance gold_category_performance gold_customer_360 "
    "gold_inventory_health gold_realtime_metrics agg_product_days kpi_overview kpi_monthly_sales kpi_top_products "
    "kpi_top_customers kpi_customer_segments kpi_inventory_health kpi_realtime_latest dedup_latest fk_flag fk_orphans "
    "dq_report clean_customers clean_products clean_orders clean_order_items clean_payments clean_inventory "
    "bronze_metadata src_csv_permissive stream_silver stream_watermark sink_stream_upsert sink_serving_replace "
    "contract_check guarded_query agg_daily_product_sales ts_features history_tail ml_future_features ml_time_split "
    "ml_evaluate pipe_gold"
).split()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cpus)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog.queries()
    queries["revenue_orders"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        started = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_wall_time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
