"""Sources, event parsing and real streaming runs, over messages and files derived from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.fixtures import Inputs
from checks.gold_checks import metrics_sql
from checks.registry import check, view
from checks.silver_checks import title
from sluicebox.contracts import CORRUPT, EVENT_TYPES, raw_source
from sluicebox.plans.serving import FileTarget, realtime_loader
from sluicebox.sources.csv import read_source_csv
from sluicebox.sources.storage import fresh_folder
from sluicebox.streaming import events as ev
from sluicebox.streaming import sinks
from sluicebox.streaming.metrics import realtime_metrics

FIELDS = [name for name in ev.EVENT_SCHEMA.names]
_KINDS = {"customer_id": "INTEGER", "product_id": "INTEGER", "category_id": "INTEGER", "quantity": "INTEGER", "price": "DOUBLE"}

# ---- DuckDB side ------------------------------------------------------------------------------------------

view("payloads", "SELECT *, CASE WHEN json_valid(value) THEN value END AS j FROM messages")
view(
    "parsed",
    "SELECT topic, partition, \"offset\", \"timestamp\" AS kafka_timestamp, key AS message_key, value AS raw_json, "
    + ", ".join(f"CAST(j ->> '{name}' AS {_KINDS.get(name, 'VARCHAR')}) AS {name}" for name in FIELDS)
    + " FROM payloads",
)
view(
    "bronze_stream",
    "SELECT *, 'kafka' AS source_system, topic AS source_file, CAST(\"offset\" AS VARCHAR) AS batch_id, "
    "sha256(coalesce(raw_json, '')) AS record_hash, event_id IS NULL AS is_malformed FROM parsed",
)
_KNOWN = ", ".join(f"'{v}'" for v in EVENT_TYPES)
view(
    "accepted",
    "SELECT event_id, customer_id, session_id, lower(trim(event_type)) AS event_type, product_id, category_id, quantity, "
    f"price, {title('trim(city)')} AS city, lower(trim(device_type)) AS device_type, "
    "CAST(event_timestamp AS TIMESTAMP) AS event_timestamp, raw_json, batch_id FROM bronze_stream WHERE NOT is_malformed "
    f"AND customer_id IS NOT NULL AND event_timestamp IS NOT NULL AND lower(trim(event_type)) IN ({_KNOWN}) "
    "AND (price IS NULL OR price >= 0) AND (quantity IS NULL OR quantity > 0)",
)
view("silver_stream", "SELECT DISTINCT * EXCLUDE (batch_id) FROM accepted")
view(
    "metric_stream",
    "SELECT DISTINCT event_id, customer_id, event_type, price, quantity, CAST(event_timestamp AS TIMESTAMP) AS event_timestamp "
    "FROM parsed WHERE event_id IS NOT NULL AND event_timestamp IS NOT NULL",
)
view(
    "metric_windows",
    "SELECT *, unnest(generate_series(date_trunc('minute', event_timestamp) - INTERVAL 4 MINUTE, "
    "date_trunc('minute', event_timestamp), INTERVAL 1 MINUTE)) AS window_start FROM metric_stream",
)
view("g_stream", metrics_sql("metric_windows"))
_BRONZE = (
    "topic, partition, \"offset\", message_key, " + ", ".join(FIELDS)
    + ", source_system, source_file, batch_id, record_hash, is_malformed"
)
_SILVER = ", ".join(FIELDS)

# ---- Spark side -------------------------------------------------------------------------------------------


def zoned(messages: DataFrame) -> DataFrame:
    """Messages as a broker delivers them: with a zoned time."""
    return messages.withColumn("timestamp", F.col("timestamp").cast("timestamp"))


def zoneless(df: DataFrame) -> DataFrame:
    times = [name for name, kind in df.dtypes if kind == "timestamp"]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in times})


def message_stream(t: Inputs) -> DataFrame:
    """A stream over message files that Spark wrote from the events table."""
    folder = fresh_folder(t.spark, "messages")
    zoned(t["messages"]).write.json(folder)
    return ev.read_message_files(t.spark, folder)


def drain(query) -> None:
    query.awaitTermination()


def appended(t: Inputs, stream: DataFrame) -> DataFrame:
    out = fresh_folder(t.spark, "stream")
    drain(sinks.start_append(stream, f"{out}/table", f"{out}/checkpoint", once=True))
    return t.spark.read.parquet(f"{out}/table")


@check("src_kafka_events", "SELECT topic, partition, \"offset\", \"timestamp\", key, value FROM messages")
def src_kafka_events(t: Inputs) -> DataFrame:
    """The broker source's columns, read as a stream of files (no broker here)."""
    return zoneless(appended(t, message_stream(t)))


@check("stream_parse", f"SELECT topic, partition, \"offset\", kafka_timestamp, message_key, raw_json, {_SILVER} FROM parsed")
def stream_parse(t: Inputs) -> DataFrame:
    return zoneless(ev.parse_messages(zoned(t["messages"])))


@check(
    "fn_from_json_event",
    "SELECT \"offset\", event_id, customer_id, quantity, price FROM parsed",
)
def fn_from_json_event(t: Inputs) -> DataFrame:
    return ev.parse_messages(zoned(t["messages"])).select("offset", "event_id", "customer_id", "quantity", "price")


@check(
    "stream_bronze_metadata",
    "SELECT \"offset\", source_system, source_file, batch_id, record_hash, is_malformed FROM bronze_stream",
)
def stream_bronze_metadata(t: Inputs) -> DataFrame:
    rows = ev.bronze_events(zoned(t["messages"]))
    return rows.select("offset", "source_system", "source_file", "batch_id", "record_hash", "is_malformed")


@check("stream_event_filter", "SELECT batch_id, event_id, event_type, price, quantity FROM accepted")
def stream_event_filter(t: Inputs) -> DataFrame:
    rows = ev.acceptable(ev.standardised(ev.bronze_events(zoned(t["messages"]))))
    return rows.select("batch_id", "event_id", "event_type", "price", "quantity")


@check("stream_dedup", f"SELECT {_SILVER} FROM silver_stream")
def stream_dedup(t: Inputs) -> DataFrame:
    return zoneless(ev.clean_events(ev.bronze_events(zoned(t["messages"])))).select(*FIELDS)


@check("stream_metrics_input", "SELECT * FROM metric_stream")
def stream_metrics_input(t: Inputs) -> DataFrame:
    rows = zoneless(ev.metric_events(zoned(t["messages"])))
    return rows.select("event_id", "customer_id", "event_type", "price", "quantity", "event_timestamp")


@check("stream_bronze", f"SELECT {_BRONZE} FROM bronze_stream")
def stream_bronze(t: Inputs) -> DataFrame:
    rows = appended(t, ev.bronze_events(message_stream(t)))
    return rows.drop("kafka_timestamp", "raw_json", "ingestion_timestamp")


@check("stream_silver", f"SELECT {_SILVER} FROM silver_stream")
def stream_silver(t: Inputs) -> DataFrame:
    return zoneless(appended(t, ev.clean_events(ev.bronze_events(message_stream(t))))).select(*FIELDS)


@check("sink_stream_append", f"SELECT {_SILVER}, raw_json FROM silver_stream")
def sink_stream_append(t: Inputs) -> DataFrame:
    return zoneless(appended(t, ev.clean_events(ev.bronze_events(message_stream(t))))).select(*FIELDS, "raw_json")


@check(
    "stream_watermark",
    "SELECT * FROM g_stream WHERE window_end <= (SELECT MAX(event_timestamp) FROM metric_stream) - INTERVAL 10 MINUTE",
)
def stream_watermark(t: Inputs) -> DataFrame:
    """Append mode writes a window once the watermark has passed its end; later windows stay open."""
    return zoneless(appended(t, realtime_metrics(ev.metric_events(message_stream(t)))))


@check("sink_stream_upsert", "SELECT * FROM g_stream")
def sink_stream_upsert(t: Inputs) -> DataFrame:
    folder = fresh_folder(t.spark, "live")
    live = sinks.LiveMetrics(t.spark, folder)
    drain(sinks.start_live_metrics(ev.metric_events(message_stream(t)), live, f"{folder}/checkpoint", once=True))
    return zoneless(live.read())


@check("stream_realtime_to_serving", "SELECT * FROM g_stream")
def stream_realtime_to_serving(t: Inputs) -> DataFrame:
    folder = fresh_folder(t.spark, "live")
    live = sinks.LiveMetrics(t.spark, folder, realtime_loader(FileTarget(f"{folder}/serving")))
    drain(sinks.start_live_metrics(ev.metric_events(message_stream(t)), live, f"{folder}/checkpoint", once=True))
    return zoneless(t.spark.read.parquet(f"{folder}/serving/realtime_metrics"))


_COLUMNS = raw_source("customers").columns
_PLAIN = {name: f"coalesce({name}, '-')" for name in _COLUMNS} | {"customer_name": "concat('n', record_hash)", "email": "'a@b.c'", "phone": "trim(phone)", "city": "trim(city)", "customer_segment": "coalesce(trim(customer_segment), '-')"}
_GOOD = ", ".join(f"{sql} AS {name}" for name, sql in _PLAIN.items())
_SHORT = ", ".join(f"{sql if i < 4 else 'NULL'} AS {name}" for i, (name, sql) in enumerate(_PLAIN.items()))


@check(
    "src_csv_permissive",
    f"SELECT {_GOOD}, false AS malformed FROM raw_customers UNION ALL SELECT {_GOOD}, true FROM raw_customers "
    f"UNION ALL SELECT {_SHORT}, true FROM raw_customers",
)
def src_csv_permissive(t: Inputs) -> DataFrame:
    """Each customer as a good line, as a line with a field too many, and as a line cut short."""
    folder = fresh_folder(t.spark, "csv")
    rows = t["raw_customers"].selectExpr(*[f"{sql} AS {name}" for name, sql in _PLAIN.items()])
    rows.write.csv(f"{folder}/part=good", header=True)
    rows.withColumn("extra", F.lit("x")).write.csv(f"{folder}/part=long", header=True)
    rows.select(*_COLUMNS[:4]).write.csv(f"{folder}/part=short", header=True)
    read = read_source_csv(t.spark, raw_source("customers"), folder)
    return read.select(*_COLUMNS, F.col(CORRUPT).isNotNull().alias("malformed"))
