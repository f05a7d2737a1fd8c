import json
import os
import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sluicebox.contracts import EVENT_SCHEMA, EVENT_TOPICS
from sluicebox.plans.serving import FileTarget, realtime_loader
from sluicebox.streaming import events as ev
from sluicebox.streaming import metrics, sinks
from sluicebox.streaming.keyed_log import KeyedLog

START = datetime(2026, 7, 23, 10, 0)


def event(key, minute=0, **change):
    base = dict(
        event_id=key, customer_id=1, session_id="s", event_type="product_view", product_id=1, category_id=1,
        quantity=1, price=9.0, city=" new delhi", device_type=" Mobile ",
        event_timestamp=(START + timedelta(minutes=minute)).strftime("%Y-%m-%d %H:%M:%S"),
    )
    return json.dumps(base | change)


def incoming(spark, folder, files_per_trigger=None):
    os.makedirs(folder, exist_ok=True)
    return ev.read_message_files(spark, folder, files_per_trigger)


def put(folder, name, *values):
    """One JSON file of messages."""
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.json", "w", encoding="utf-8") as file:
        for i, value in enumerate(values):
            file.write(json.dumps({
                "topic": "customer-events", "partition": 0, "offset": i, "timestamp": "2026-07-23T10:00:00Z",
                "key": "k", "value": value,
            }) + "\n")


def run(query):
    query.awaitTermination()


def test_event_payload_fields():
    assert set(EVENT_SCHEMA.names) == {
        "event_id", "customer_id", "session_id", "event_type", "product_id", "category_id", "quantity", "price",
        "city", "device_type", "event_timestamp",
    }
    assert len(EVENT_TOPICS) == 4


def test_window_metrics_on_a_batch(spark):
    rows = spark.createDataFrame(
        [
            ("e1", 1, "purchase_completed", 10.0, 2, START),
            ("e2", 2, "product_view", 9.0, 1, START + timedelta(minutes=1)),
            ("e3", 2, "payment_failed", 9.0, 1, START + timedelta(minutes=2)),
            ("e4", 1, "add_to_cart", 10.0, 1, START + timedelta(minutes=3)),
            ("e5", None, "product_view", 1.0, 1, START + timedelta(minutes=30)),
        ],
        "event_id string, customer_id bigint, event_type string, price double, quantity bigint, event_timestamp timestamp",
    )
    out = metrics.realtime_metrics(rows)
    best = out.agg(*[F.max(c).alias(c) for c in out.columns]).first()
    assert (best.revenue_per_window, best.orders_per_window, best.active_users) == (20.0, 1, 2)
    assert (best.product_views, best.payment_failures, best.add_to_cart_events) == (1, 1, 1)
    anonymous = out.filter(F.col("window_start") >= F.lit(START + timedelta(minutes=20))).collect()
    assert len(anonymous) == 5 and {(r.active_users, r.product_views) for r in anonymous} == {(0, 1)}


@pytest.mark.parametrize(
    "change, kept",
    [
        ({}, True),
        ({"event_type": "  PRODUCT_VIEW "}, True),
        ({"price": None, "quantity": None}, True),
        ({"event_type": "mystery"}, False),
        ({"quantity": 0}, False),
        ({"price": -1}, False),
        ({"customer_id": None}, False),
        ({"event_timestamp": "soon"}, False),
        ({"event_id": None}, False),
    ],
)
def test_which_events_are_kept(spark, folder, change, kept):
    put(folder, "a", event("1", **change))
    batch = spark.read.schema(ev.MESSAGE_SCHEMA).json(folder)
    rows = ev.clean_events(ev.bronze_events(batch)).collect()
    assert len(rows) == int(kept)
    if kept:
        assert (rows[0].event_type, rows[0].city, rows[0].device_type) == ("product_view", "New Delhi", "mobile")


def test_garbage_is_kept_in_bronze_with_a_mark(spark, folder):
    put(f"{folder}/in", "a", "garbage", event("1"))
    stream = ev.bronze_events(incoming(spark, f"{folder}/in"))
    run(sinks.start_append(stream, f"{folder}/out", sinks.checkpoint_folder(folder, "bronze_events"), once=True))
    rows = {r.raw_json[:7]: r for r in spark.read.parquet(f"{folder}/out").collect()}
    assert rows["garbage"].is_malformed and rows["garbage"].customer_id is None
    assert (rows["garbage"].source_system, rows["garbage"].source_file, rows["garbage"].batch_id) == ("kafka", "customer-events", "0")
    assert os.path.isdir(f"{folder}/streaming/bronze_events")


def test_stream_drops_copies_and_late_rows(spark, folder):
    """Three micro-batches: a copy of an id is dropped, a row behind the watermark is dropped."""
    stream = ev.clean_events(ev.bronze_events(incoming(spark, f"{folder}/in", 1)))
    steps = [
        (event("1", 0), event("1", 0), event("2", 1)),
        (event("1", 2), event("3", 60)),
        (event("late", 10), event("4", 61)),
    ]
    for i, step in enumerate(steps):
        put(f"{folder}/in", f"step{i}", *step)
        run(sinks.start_append(stream, f"{folder}/out", f"{folder}/cp", once=True))
    assert sorted(r.event_id for r in spark.read.parquet(f"{folder}/out").collect()) == ["1", "2", "3", "4"]


def test_closed_windows_are_written_once(spark, folder):
    stream = ev.metric_events(incoming(spark, f"{folder}/in"))
    put(f"{folder}/in", "a", event("1", 0), event("2", 1, customer_id=2), event("3", 40))
    run(sinks.start_closed_metrics(stream, f"{folder}/out", f"{folder}/cp", once=True))
    rows = spark.read.parquet(f"{folder}/out").collect()
    assert len(rows) == 6 and max(r.active_users for r in rows) == 2
    put(f"{folder}/in", "b", event("4", 90))
    run(sinks.start_closed_metrics(stream, f"{folder}/out", f"{folder}/cp", once=True))
    rows = spark.read.parquet(f"{folder}/out").collect()
    assert len(rows) == 11 == len({r.window_start for r in rows})


def test_live_metrics_equal_the_batch_after_every_step(spark, folder):
    live = sinks.LiveMetrics(spark, f"{folder}/live", realtime_loader(FileTarget(f"{folder}/serving")))
    stream = ev.metric_events(incoming(spark, f"{folder}/in", 1))
    seen = []
    steps = [
        [event("1", 0), event("2", 1, customer_id=2, event_type="purchase_completed", quantity=3)],
        [event("3", 2, event_type="add_to_cart"), event("2", 1, customer_id=2), event("4", 4, customer_id=3)],
        [event("5", 3, customer_id=3, event_type="payment_failed"), event("6", 25)],
    ]
    for i, step in enumerate(steps):
        put(f"{folder}/in", f"step{i}", *step)
        run(sinks.start_live_metrics(stream, live, f"{folder}/cp", once=True))
        seen += step
        put(f"{folder}/all{i}", "a", *[s for s in dict.fromkeys(seen) if s != event("2", 1, customer_id=2)])
        batch = spark.read.schema(ev.MESSAGE_SCHEMA).json(f"{folder}/all{i}")
        expected = sorted(metrics.realtime_metrics(ev.metric_events(batch)).collect())
        assert sorted(live.read().collect()) == expected
        served = spark.read.parquet(f"{folder}/serving/realtime_metrics")
        assert sorted(served.select(*live.read().columns).collect()) == expected
    assert live.metrics.finished() >= len(steps) - 1


def test_repeating_a_micro_batch_changes_nothing(spark, folder):
    live = sinks.LiveMetrics(spark, folder)
    rows = spark.createDataFrame(
        [("e1", 1, "purchase_completed", 10.0, 2, START), ("e2", 2, "product_view", 9.0, 1, START)],
        "event_id string, customer_id bigint, event_type string, price double, quantity bigint, event_timestamp timestamp",
    )
    for batch_id, df in ((0, rows.limit(1)), (1, rows), (1, rows)):
        live.apply(metrics.customer_windows(df), batch_id)
    assert sorted(live.read().collect()) == sorted(metrics.realtime_metrics(rows).collect())
    live.forget_parts("2026-07-24")
    assert not [n for n in os.listdir(f"{folder}/parts") if n.startswith("window_day=")]
    assert live.read().count() == 5


def test_live_metrics_keep_no_state_of_their_own(spark, folder):
    """Only the event ids are state. Batches of one customer's window add up, also a null customer's, and a repeated one counts once."""
    live = sinks.LiveMetrics(spark, f"{folder}/live")
    steps = [
        [event("1", 0, event_type="purchase_completed"), event("2", 0, customer_id=None)],
        [event("3", 0, event_type="purchase_completed", quantity=2), event("4", 1, customer_id=None), event("1", 0)],
    ]
    for i, step in enumerate(steps):
        put(f"{folder}/in", f"step{i}", *step)
        query = sinks.start_live_metrics(ev.metric_events(incoming(spark, f"{folder}/in", 1)), live, f"{folder}/cp", once=True)
        run(query)
        assert [operator["operatorName"] for operator in query.lastProgress["stateOperators"]] == ["dedupeWithinWatermark"]
    put(f"{folder}/all", "a", *steps[0], *steps[1][:2])
    events = ev.metric_events(spark.read.schema(ev.MESSAGE_SCHEMA).json(f"{folder}/all"))
    expected = sorted(metrics.realtime_metrics(events).collect())
    assert sorted(live.read().collect()) == expected and max(r.revenue_per_window for r in expected) == 27.0
    other = sinks.LiveMetrics(spark, f"{folder}/other")
    for batch_id, key in ((0, "1"), (1, "2"), (1, "2"), (2, "3"), (3, "4"), (3, "4")):
        other.add(events.where(F.col("event_id") == key), batch_id)
    assert sorted(other.read().collect()) == expected


KEYED = "k int, day date, v string"


def keyed_rows(spark, *rows):
    return spark.createDataFrame([(k, date(2026, 1, d), v) for k, d, v in rows], KEYED)


def keyed_log(spark, path, limit=3):
    return KeyedLog(spark, path, keyed_rows(spark).schema, ("k",), "day", limit)


def test_unfinished_batches_are_not_read(spark, folder):
    log = keyed_log(spark, f"{folder}/t")
    assert log.read() is None
    log.upsert(keyed_rows(spark, (1, 1, "a"), (2, 2, "b")), 0)
    log.upsert(keyed_rows(spark, (2, 2, "c")), 1)
    keyed_rows(spark, (1, 1, "z")).drop("day").write.parquet(f"{folder}/t/delta/log_day=2026-01-01/version=2")
    assert sorted((r.k, r.v) for r in log.read().collect()) == [(1, "a"), (2, "c")]
    log.upsert(keyed_rows(spark, (3, 1, "d")), 2)  # the batch comes again and replaces what the broken one left
    assert sorted((r.k, r.v) for r in log.read().collect()) == [(1, "a"), (2, "c"), (3, "d")]


@pytest.mark.parametrize("limit", [1, 2, 3, 100])
def test_log_equals_a_dictionary_after_every_batch(spark, folder, limit):
    dice, expected = random.Random(limit), {}
    log = keyed_log(spark, f"{folder}/t", limit)
    for version in range(9):
        changes = {k: (k, k % 4 + 1, f"{version}-{k}") for k in dice.sample(range(12), dice.randrange(5))}
        for _ in range(1 + version % 2):  # every other batch comes twice
            log.upsert(keyed_rows(spark, *changes.values()), version)
        log.upsert(keyed_rows(spark, *[(k, d, "late copy") for k, d, _ in changes.values()]), version - 1)
        expected |= {k: row[2] for k, row in changes.items()}
        assert {r.k: r.v for r in log.read().collect()} == expected and log.read().count() == len(expected)


def files_below(path):
    return {os.path.join(d, f): os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_a_batch_writes_what_it_touches(spark, folder):
    """Sixty days of history: a batch that touches one window writes one small file, merges rewrite one day, files stay few."""
    log = keyed_log(spark, f"{folder}/t", 4)
    history = spark.range(60 * 1440).selectExpr("cast(id as int) k", "date_add(DATE'2026-01-01', cast(id div 1440 as int)) day", "sha2(cast(id as string), 256) v")
    log.upsert(history, 0)
    whole = sum(files_below(folder).values())
    written = []
    for version in range(1, 21):
        before = files_below(folder)
        log.upsert(history.where("k = 30000").withColumn("v", F.lit(f"new {version}")), version)
        written.append(sum(size for path, size in files_below(folder).items() if path not in before))
    assert max(written) < whole / 20 and sorted(written)[14] < whole / 1000
    assert len([p for p in files_below(folder) if "log_day=2026-01-21" in p]) <= 2 * 4 + 2
    assert log.read().where("v = 'new 20'").count() == 1 and log.read().count() == 60 * 1440


def test_resting_days_are_read_without_a_shuffle(spark, folder):
    log = keyed_log(spark, f"{folder}/t", 1)
    log.upsert(keyed_rows(spark, (1, 1, "a"), (2, 2, "b")), 0)
    assert "Exchange" not in log.read()._jdf.queryExecution().executedPlan().toString()


def test_state_holds_no_customer_sets(spark, folder):
    put(folder, "a", event("1"))
    batch = spark.read.schema(ev.MESSAGE_SCHEMA).json(folder)
    plan = metrics.realtime_metrics(ev.metric_events(batch))._jdf.queryExecution().executedPlan().toString()
    assert "collect_set" not in plan and "Python" not in plan


def test_large_and_odd_prices_stay_in_window_revenue(spark):
    rows = [("a", "purchase_completed", 6e14, 30_000), ("b", "purchase_completed", 1e15, 1), ("c", "purchase_completed", 2.5, 2)]
    events = spark.createDataFrame(rows, "customer_id string, event_type string, price double, quantity bigint").selectExpr(
        "*", "timestamp'2026-01-01 00:00:30' AS event_timestamp"
    )
    found = {r.revenue_per_window for r in metrics.realtime_metrics(events).collect()}
    assert found == {6e14 * 30_000 + 1e15 + 5.0}
    odd = metrics.realtime_metrics(events.selectExpr("customer_id", "event_type", "double('NaN') AS price", "quantity", "event_timestamp"))
    assert all(r.revenue_per_window != r.revenue_per_window for r in odd.collect())
