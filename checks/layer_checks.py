"""Whole layers run through stored tables: CSV to Bronze, Bronze to Silver, Silver to Gold."""

from __future__ import annotations

import re
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import gold_checks, stacking  # noqa: F401  (its views are needed)
from checks.fixtures import AS_OF, RAW, Inputs
from checks.registry import VIEWS, check, view
from checks.silver_checks import KEYS, TYPES
from sluicebox.contracts import FLAGS, raw_source
from sluicebox.plans import bronze, changes, gold, silver
from sluicebox.sources.run_log import RunLog
from sluicebox.sources.snapshots import Snapshots
from sluicebox.sources.storage import fresh_folder, read_table, writer_of

# The Gold views once more, over cleaned tables: every name ending in _m, and g_..., gets its twin.
_TWINS = {f"{name}_m": f"valid_{name}" for name in TYPES} | {
    name: name.removesuffix("_m") + "_v"
    for name in (
        "revenue_m", "per_order_m", "sold_m", "customer_orders_m", "daily_units_m", "velocity_m",
        "g_daily", "g_product", "g_category", "g_customer", "g_inventory",
    )
}
for _name, _twin in _TWINS.items():
    if not _twin.startswith("valid_"):
        view(_twin, re.sub(r"\b[a-z_]+\b", lambda m: _TWINS.get(m.group(), m.group()), VIEWS[_name]))
_GOLD = {
    "daily_sales_summary": "g_daily_v", "product_performance": "g_product_v", "category_performance": "g_category_v",
    "customer_360": "g_customer_v", "inventory_health": "g_inventory_v",
}
#: Lines that get a field too many in the files of ``load_csv``.
BAD_LINES = "record_hash < '4'"
CSV_ROWS = 500_000


def silver_kinds(table: str) -> dict[str, str]:
    def kind(sql: str) -> str:
        return next((k for k in ("bigint", "double", "date", "timestamp") if f"as {k})" in sql.lower()), "string")

    return {name: kind(sql) for name, sql in TYPES[table].items()} | {"batch_id": "string", "record_hash": "string"}


def silver_stack(tables: Mapping[str, DataFrame], rejected: Mapping[str, DataFrame]) -> DataFrame:
    """Valid and rejected rows of all tables."""
    parts = []
    for name in TYPES:
        kinds, key = silver_kinds(name), KEYS[name].split(",")[0]
        parts.append(stacking.rows(tables[name], name, key, kinds))
        flags = rejected[name].withColumnRenamed(FLAGS, "flags")
        parts.append(stacking.rows(flags, silver.rejected_name(name), key, kinds | {"flags": "array<string>"}))
    return reduce(DataFrame.unionByName, parts)


def _silver_stack_sql() -> str:
    parts = []
    for name in TYPES:
        kinds, key = silver_kinds(name), KEYS[name].split(",")[0]
        parts.append(stacking.rows_sql(f"valid_{name}", name, key, kinds))
        bad = f"(SELECT * FROM flagged_{name} WHERE len(flags) > 0)"
        parts.append(stacking.rows_sql(bad, silver.rejected_name(name), key, kinds | {"flags": "array<string>"}))
    return " UNION ALL ".join(parts)


def _write_csv(df: DataFrame, path: str) -> None:
    """CSV files under gzip, which a task reads as a whole, so none holds more than ``CSV_ROWS`` rows."""
    writer = df.write.mode("append").option("maxRecordsPerFile", CSV_ROWS)
    writer.csv(path, header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, compression="gzip")


def load_csv(t: Inputs, bad_lines: bool = False, log: RunLog | None = None, runs: int = 1) -> tuple[str, list]:
    """All seven raw tables written as CSV files and loaded into Bronze, ``runs`` times under one batch id."""
    root = fresh_folder(t.spark, "bronze")
    for name in RAW:
        source = raw_source(name.removeprefix("raw_"))
        _write_csv(t[name].select(*source.columns), f"{root}/raw/{source.file_name}")
        if bad_lines:
            _write_csv(t[name].where(BAD_LINES).select(*source.columns, F.lit("x").alias("extra")), f"{root}/raw/{source.file_name}")
    for _ in range(runs):
        counts = bronze.load_sources(t.spark, f"{root}/raw", f"{root}/bronze", f"{root}/quarantine", batch_id="run-1", log=log)
    return root, counts


def refined(t: Inputs) -> tuple[str, list]:
    """All seven raw tables stored as Bronze and refined into Silver."""
    root = fresh_folder(t.spark, "silver")
    for name in RAW:
        writer_of(t[name]).save(f"{root}/bronze/{name.removeprefix('raw_')}")
    return root, silver.refine(t.spark, f"{root}/bronze", f"{root}/silver", f"{root}/quarantine")


def _raw_hash(table: str) -> str:
    columns = ", ".join(f"coalesce({c}, '')" for c in raw_source(table).columns)
    return f"sha256(concat_ws('||', {columns}))"


@check(
    "pipe_bronze",
    " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, {_raw_hash(table)} AS record_hash, 'run-1' AS batch_id FROM raw_{table}"
        for table in TYPES
    ),
)
def pipe_bronze(t: Inputs) -> DataFrame:
    root, _ = load_csv(t)
    parts = [
        read_table(t.spark, f"{root}/bronze/{table}").select(
            F.lit(table).alias("table_name"), "record_hash", "batch_id"
        )
        for table in TYPES
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@check(
    "run_counts",
    " UNION ALL ".join(
        f"SELECT 'run-1' AS run_id, '{table}' AS table_name, COUNT(*) + COUNT(*) FILTER ({BAD_LINES}) AS rows_read, COUNT(*) AS rows_written, "
        f"COUNT(*) FILTER ({BAD_LINES}) AS rows_rejected, COUNT(*) AS rows_stored FROM raw_{table}"
        for table in TYPES
    ),
)
def run_counts(t: Inputs) -> DataFrame:
    """The audit table of a load that ran twice, over files with malformed lines, beside what Bronze holds."""
    log = RunLog(t.spark, fresh_folder(t.spark, "runs"))
    root, _ = load_csv(t, bad_lines=True, log=log, runs=2)
    stored = [
        read_table(t.spark, f"{root}/bronze/{table}").agg(F.count("*").alias("rows_stored")).withColumn("table_name", F.lit(table))
        for table in TYPES
    ]
    report = log.report().drop("layer", "recorded_at")
    return report.join(reduce(DataFrame.unionByName, stored), "table_name")


@check(
    "sink_bronze_append",
    " UNION ALL ".join(f"SELECT '{table}' AS table_name, {_raw_hash(table)} AS record_hash, n FROM raw_{table}, range(2) AS r(n)" for table in TYPES),
)
def sink_bronze_append(t: Inputs) -> DataFrame:
    """Two batches of one file: without a log each load appends its rows."""
    root, _ = load_csv(t)
    bronze.load_sources(t.spark, f"{root}/raw", f"{root}/bronze", f"{root}/quarantine", batch_id="run-2")
    number = F.when(F.col("batch_id") == "run-1", 0).otherwise(1).cast("bigint").alias("n")
    parts = [read_table(t.spark, f"{root}/bronze/{table}").select(F.lit(table).alias("table_name"), "record_hash", number) for table in TYPES]
    return reduce(DataFrame.unionByName, parts)


@check(
    "sink_bronze_quarantine",
    " UNION ALL ".join(f"SELECT '{table}' AS table_name, 'run-1' AS batch_id, {_raw_hash(table)} AS record_hash FROM raw_{table} WHERE {BAD_LINES}" for table in TYPES),
)
def sink_bronze_quarantine(t: Inputs) -> DataFrame:
    """The malformed lines of each table, with what could be parsed of them."""
    root, _ = load_csv(t, bad_lines=True)
    parts = [
        read_table(t.spark, f"{root}/quarantine/bronze/{table}/run-1").select(F.lit(table).alias("table_name"), "batch_id", "record_hash")
        for table in TYPES
    ]
    return reduce(DataFrame.unionByName, parts)


@check(
    "pipe_silver",
    _silver_stack_sql()
    + "".join(
        f" UNION ALL SELECT 'counts' AS table_name, '{table}' AS row_key, concat_ws('/', (SELECT COUNT(*) FROM raw_{table}), "
        f"(SELECT COUNT(*) FROM valid_{table}), (SELECT COUNT(*) FROM flagged_{table} WHERE len(flags) > 0)) AS digest"
        for table in TYPES
    ),
)
def pipe_silver(t: Inputs) -> DataFrame:
    root, counts = refined(t)
    rows = silver_stack(
        {name: read_table(t.spark, f"{root}/silver/{name}") for name in TYPES},
        {name: read_table(t.spark, f"{root}/quarantine/silver/{name}") for name in TYPES},
    )
    said = [("counts", c.table, f"{c.read}/{c.written}/{c.rejected}") for c in counts]
    return rows.unionByName(t.spark.createDataFrame(said, "table_name STRING, row_key STRING, digest STRING"))


@check("sink_silver_overwrite", _silver_stack_sql())
def sink_silver_overwrite(t: Inputs) -> DataFrame:
    """All seven tables and their rejected rows, published in one step over an earlier version."""
    root = fresh_folder(t.spark, "silver")
    for name in RAW:
        writer_of(t[name]).save(f"{root}/bronze/{name.removeprefix('raw_')}")
    layer = Snapshots(t.spark, f"{root}/silver")
    layer.commit({"categories": t.spark.range(3), silver.rejected_name("orders"): t.spark.range(3)})
    silver.refine_together(t.spark, f"{root}/bronze", layer)
    view = layer.current()
    return silver_stack(view.read_all(TYPES), {name: view.read(silver.rejected_name(name)) for name in TYPES})


@check("pipe_silver_changes", _silver_stack_sql())
def pipe_silver_changes(t: Inputs) -> DataFrame:
    """All seven tables refined from a part of their batches, then brought up to date with the others."""
    root = fresh_folder(t.spark, "silver")
    store = Snapshots(t.spark, f"{root}/silver")
    for part in ("batch_id < '3'", "NOT batch_id < '3'"):
        for name in RAW:
            writer_of(t[name].where(part)).mode("append").save(f"{root}/bronze/{name.removeprefix('raw_')}")
        changes.refine_changes(t.spark, f"{root}/bronze", store)
    view = store.current()
    return silver_stack(view.read_all(TYPES), {name: view.read(silver.rejected_name(name)) for name in TYPES})


@check("pipe_gold", stacking.serving_sql(_GOLD))
def pipe_gold(t: Inputs) -> DataFrame:
    """All five tables, built from refined Silver."""
    root, _ = refined(t)
    gold.build_all(t.spark, f"{root}/silver", f"{root}/gold", as_of=AS_OF)
    return stacking.serving({name: read_table(t.spark, f"{root}/gold/{name}") for name in _GOLD})


@check("sink_gold_snapshot", stacking.serving_sql({name: f"g_{view_name}" for name, view_name in zip(_GOLD, ("daily", "product", "category", "customer", "inventory"))}))
def sink_gold_snapshot(t: Inputs) -> DataFrame:
    """All five tables built from one version of Silver and published in one step."""
    root = fresh_folder(t.spark, "gold")
    layer, business = Snapshots(t.spark, f"{root}/silver"), Snapshots(t.spark, f"{root}/gold")
    layer.commit(t.silver())
    gold.build_together(layer.current(), business, as_of=AS_OF)
    return stacking.serving(business.current().read_all(_GOLD))


@check("silver_metadata", "SELECT customer_id, TRUE AS stamped FROM customers_m")
def silver_metadata(t: Inputs) -> DataFrame:
    """Every row carries the time of its processing, which is that of this query."""
    rows = silver.with_silver_time(t["customers_m"])
    age = F.unix_timestamp(F.current_timestamp()) - F.unix_timestamp("silver_processed_timestamp")
    return rows.select("customer_id", age.between(0, 3600).alias("stamped"))
