"""Run one layer from ``spark-submit`` or ``python -m sluicebox``; all paths are below one root."""

from __future__ import annotations

import argparse
import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicebox.contracts import BATCH_GOLD, RAW_SOURCES, SERVING_TABLES, serving_table
from sluicebox.operators import quality
from sluicebox.plans import bronze, forecast, gold, governed, kpi, serving, silver
from sluicebox.sources.storage import path_exists, read_table, staging
from sluicebox.streaming import events, sinks


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="sluicebox")
    top.add_argument("--root", required=True, help="folder of all stored tables, as a URI")
    top.add_argument("--format", default="parquet", help="table format, such as parquet or delta")
    jobs = top.add_subparsers(dest="job", required=True)

    def job(name: str, tables: Sequence[str] = ()) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name)
        if tables:
            sub.add_argument("--tables", nargs="*", choices=sorted(tables))
        return sub

    load = job("bronze", RAW_SOURCES)
    load.add_argument("--raw", required=True, help="folder of the CSV files")
    load.add_argument("--batch-id")
    job("silver", RAW_SOURCES)
    job("gold", BATCH_GOLD).add_argument("--as-of", help="reporting date; today by default")
    job("serve", SERVING_TABLES)
    job("features")
    job("train").add_argument("--test-days", type=int, default=forecast.TEST_DAYS)
    job("predict").add_argument("--horizon-days", type=int, default=forecast.HORIZON_DAYS)
    job("kpi").add_argument("--limit", type=int, default=kpi.DEFAULT_LIMIT, help="rows of the limited result sets")
    job("check")
    job("query").add_argument("--sql", required=True, help="one SELECT over the serving tables")
    stream = job("stream")
    stream.add_argument("target", choices=("bronze", "silver", "metrics"))
    stream.add_argument("--servers", required=True, help="Kafka bootstrap servers")
    return top


def start_stream(spark: SparkSession, target: str, servers: str, root: str, fmt: str):
    messages = events.read_kafka_events(spark, servers)
    if target == "metrics":
        live = sinks.LiveMetrics(spark, f"{root}/live", serving.realtime_loader(serving.FileTarget(f"{root}/serving", fmt)))
        checkpoint = sinks.checkpoint_folder(f"{root}/checkpoints", "realtime_metrics")
        return sinks.start_live_metrics(events.metric_events(messages), live, checkpoint)
    rows = events.bronze_events(messages)
    if target == "silver":
        rows = events.clean_events(rows)
    checkpoint = sinks.checkpoint_folder(f"{root}/checkpoints", f"{target}_events")
    return sinks.start_append(rows, f"{root}/{target}/events", checkpoint, fmt)


def served_tables(spark: SparkSession, gold_root: str, serving_root: str, fmt: str) -> dict[str, DataFrame]:
    """The batch tables of Gold and the live metrics of serving; a table not stored yet is empty."""
    roots = {name: gold_root if name in BATCH_GOLD else serving_root for name in SERVING_TABLES}
    return {
        name: read_table(spark, f"{root}/{name}", fmt)
        if path_exists(spark, f"{root}/{name}")
        else spark.createDataFrame([], serving_table(name).schema)
        for name, root in roots.items()
    }


def quality_report(spark: SparkSession, gold_root: str, serving_root: str, quarantine: str, fmt: str) -> DataFrame:
    """(table_name, rule, violations): contract violations of the serving tables, and flags of the rows set aside by Silver."""
    with staging(spark, "contracts") as stage:
        parts = [quality.contract_report(served_tables(spark, gold_root, serving_root, fmt), stage)]
    aside = {name: f"{quarantine}/silver/{name}" for name in RAW_SOURCES}
    rejected = {name: read_table(spark, path, fmt) for name, path in aside.items() if path_exists(spark, path)}
    if rejected:
        flags = quality.flag_report(rejected)
        parts.append(flags.select("table_name", F.concat(F.lit("flag:"), "flag").alias("rule"), F.col("rejected_rows").alias("violations")))
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report


def run(spark: SparkSession, args: argparse.Namespace) -> list:
    """Run the chosen batch job and return its results; a stream runs until it is stopped."""
    root, fmt = args.root.rstrip("/"), args.format
    bronze_root, silver_root, gold_root = f"{root}/bronze", f"{root}/silver", f"{root}/gold"
    quarantine, models = f"{root}/quarantine", forecast.ModelStore(spark, f"{root}/models")
    if args.job == "bronze":
        return bronze.load_sources(spark, args.raw, bronze_root, quarantine, args.tables, args.batch_id, fmt)
    if args.job == "silver":
        return silver.refine(spark, bronze_root, silver_root, quarantine, args.tables, fmt)
    if args.job == "gold":
        return gold.build_all(spark, silver_root, gold_root, args.tables, args.as_of, fmt)
    if args.job == "serve":
        return serving.load_serving(spark, gold_root, serving.FileTarget(f"{root}/serving", fmt), args.tables, fmt)
    if args.job == "features":
        with staging(spark, "features") as stage:
            return [models.save_table(forecast.stored_features(spark, stage, silver_root, fmt), "features")]
    if args.job == "train":
        return [forecast.train_from_silver(spark, silver_root, models, args.test_days, fmt)]
    if args.job == "predict":
        return [forecast.predict_from_silver(spark, silver_root, models, args.horizon_days, fmt)]
    if args.job == "kpi":
        sets = kpi.dashboard(served_tables(spark, gold_root, f"{root}/serving", fmt), args.limit)
        return [{"result": name, **row.asDict()} for name, df in sets.items() for row in df.toLocalIterator()]
    if args.job == "check":
        return [row.asDict() for row in quality_report(spark, gold_root, f"{root}/serving", quarantine, fmt).toLocalIterator()]
    if args.job == "query":
        tables = served_tables(spark, gold_root, f"{root}/serving", fmt)
        return [row.asDict() for row in governed.run_approved(spark, args.sql, tables).toLocalIterator()]
    start_stream(spark, args.target, args.servers, root, fmt).awaitTermination()
    return []


def main() -> None:
    args = parser().parse_args()
    spark = SparkSession.builder.appName(f"sluicebox-{args.job}").getOrCreate()
    for result in run(spark, args):
        print(json.dumps(getattr(result, "__dict__", result), default=str))


if __name__ == "__main__":
    main()
