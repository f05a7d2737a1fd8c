"""Incremental refine against a full one, batch after batch."""

import random

import pytest
from pyspark.sql import functions as F

from sluicebox.contracts import FLAGS, raw_source
from sluicebox.plans import changes, silver
from sluicebox.sources.snapshots import Snapshots
from sluicebox.sources.storage import Staging
from tests.test_snapshots import RAW

LOADED = "ingestion_timestamp timestamp, batch_id string, record_hash string"


def add_batch(spark, root, batch, rows_of):
    """Append one batch to Bronze; ``rows_of`` maps tables to raw rows."""
    for table, rows in rows_of.items():
        names = raw_source(table).columns
        df = spark.createDataFrame([(*row, str(k)) for k, row in enumerate(rows)], ", ".join(f"{c} string" for c in names) + ", record_hash string")
        stamp = F.expr(f"timestamp'2026-07-01 00:00:00' + make_interval(0, 0, 0, {int(batch)})")
        df.withColumns({"ingestion_timestamp": stamp, "batch_id": F.lit(batch)}).coalesce(1).write.mode("append").parquet(f"{root}/{table}")


def content(df):
    flags = [F.array_join(FLAGS, ",").alias("flags")] if FLAGS in df.columns else []
    names = sorted(c for c in df.columns if c not in (FLAGS, "silver_processed_timestamp"))
    return sorted(map(tuple, df.select(*names, *flags).collect()), key=str)


def assert_equal_to_full_refine(spark, folder, store, step):
    silver.refine(spark, f"{folder}/bronze", f"{folder}/full{step}", f"{folder}/aside{step}")
    view = store.current()
    for table in RAW:
        assert content(view.read(table)) == content(spark.read.parquet(f"{folder}/full{step}/{table}")), table
        bad = content(view.read(silver.rejected_name(table)))
        assert bad == content(spark.read.parquet(f"{folder}/aside{step}/silver/{table}")), table


def test_later_batches_change_old_verdicts(spark, folder):
    store, bronze = Snapshots(spark, f"{folder}/s"), f"{folder}/bronze"
    add_batch(spark, bronze, "1", RAW)
    first = {c.table: c.read for c in changes.refine_changes(spark, bronze, store)}
    assert first == {table: len(rows) for table, rows in RAW.items()}
    assert changes.refine_changes(spark, bronze, store) == [] and store.current().version == 1

    # the missing category and e-mail arrive: a product, an order and its items become valid, without being loaded again
    add_batch(spark, bronze, "2", {"categories": [("2", "light", "home")], "customers": [("2", "bob", "b@c.d", "1", "x", "y", "z", "2020-01-01", None)]})
    second = {c.table: c.read for c in changes.refine_changes(spark, bronze, store)}
    assert second == {"categories": 1, "customers": 1, "products": 1, "orders": 1, "order_items": 1, "payments": 0, "inventory": 1}

    # an order's total changes: its valid payment becomes a mismatch, and the rejected one becomes valid
    assert [r.payment_id for r in store.read("payments").collect()] == [1]
    add_batch(spark, bronze, "3", {"orders": [("1", "1", "2026-07-01", "delivered", "c", "s", "card", "99")]})
    third = {c.table: c.read for c in changes.refine_changes(spark, bronze, store)}
    assert third == {"orders": 1, "payments": 2}
    assert [r.payment_id for r in store.read("payments").collect()] == [2]

    # a newer payment row replaces one; when the total moves back, the superseded row is the newest valid one again
    add_batch(spark, bronze, "4", {"payments": [("2", "1", "card", "paid", "99.01", "2026-07-02 10:00:00")]})
    changes.refine_changes(spark, bronze, store)
    assert store.read(changes.superseded_name("payments")).count() == 1
    add_batch(spark, bronze, "5", {"orders": [("1", "1", "2026-07-01", "delivered", "c", "s", "card", "98.96")]})
    changes.refine_changes(spark, bronze, store)
    assert [r.payment_amount for r in store.read("payments").collect()] == [99.0]
    assert_equal_to_full_refine(spark, folder, store, 5)


def test_untouched_tables_keep_their_version(spark, folder):
    store, bronze = Snapshots(spark, f"{folder}/s"), f"{folder}/bronze"
    add_batch(spark, bronze, "1", RAW)
    changes.refine_changes(spark, bronze, store)
    before = store.current()
    add_batch(spark, bronze, "2", {"inventory": [("1", "w9", "5", "2", "2026-07-01 10:00:00")]})
    assert [c.table for c in changes.refine_changes(spark, bronze, store)] == ["inventory"]
    after = store.current()
    moved = {name for name in after.tables if after.tables[name] != before.tables[name]}
    assert moved == {"inventory", "rejected_inventory", changes.BATCHES}
    assert store.read("inventory").count() == 2


def test_random_batches_equal_a_full_refine(spark, folder):
    dice = random.Random(1)
    some = lambda *values: dice.choice(values)
    number = lambda: str(dice.randrange(1, 5))
    store = Snapshots(spark, f"{folder}/s")
    for batch in range(1, 3):
        rows = {
            "categories": [(number(), some("a", " "), "d") for _ in range(2)],
            "customers": [(number(), "n", some("e", None), "1", "x", "y", "z", "2020-01-01", "s") for _ in range(2)],
            "products": [(number(), "p", number(), "b", some("5", "-1"), "3", "4", "2020-01-01") for _ in range(3)],
            "orders": [(number(), number(), "2026-07-01", "delivered", "c", "s", "card", some("10", "20", "x")) for _ in range(4)],
            "order_items": [(number(), number(), number(), some("1", "0"), "5", "0", "5") for _ in range(5)],
            "payments": [(number(), number(), "card", "paid", some("10", "20"), "2026-07-01 10:00:00") for _ in range(6)],
            "inventory": [(number(), some("w1", "w2"), "5", "2", "2026-07-01 10:00:00") for _ in range(3)],
        }
        chosen = rows if batch == 1 else {t: rows[t] for t in dice.sample(sorted(rows), 4)}
        add_batch(spark, f"{folder}/bronze", str(batch), chosen)
        changes.refine_changes(spark, f"{folder}/bronze", store)
    assert_equal_to_full_refine(spark, folder, store, 2)


def test_newest_rows_are_stored_only_where_they_are_read_again(spark, folder, monkeypatch):
    stored, store = [], Staging.store
    monkeypatch.setattr(Staging, "store", lambda self, df, name: stored.append(name) or store(self, df, name))
    layer, bronze = Snapshots(spark, f"{folder}/s"), f"{folder}/bronze"
    add_batch(spark, bronze, "1", RAW)
    changes.refine_changes(spark, bronze, layer)
    newest = {name.removesuffix("-newest") for name in stored if name.endswith("-newest")}
    assert newest == {"categories", "customers", "products", "orders", "payments"}
    assert_equal_to_full_refine(spark, folder, layer, 1)


def test_only_keys_that_old_rows_have_are_looked_up(spark, folder, monkeypatch):
    """Fresh rows under new keys open no old row."""
    keys, plain = [], Staging.store

    def watched(stage, df, name):
        out = plain(stage, df, name)
        if name == "categories-keys":
            keys.append(sorted(r.category_id for r in out.collect()))
        return out

    monkeypatch.setattr(Staging, "store", watched)
    store, bronze = Snapshots(spark, f"{folder}/s"), f"{folder}/bronze"
    add_batch(spark, bronze, "1", RAW)
    changes.refine_changes(spark, bronze, store)
    for batch, name in (("2", "light"), ("3", "lamp")):
        add_batch(spark, bronze, batch, {"categories": [("2", name, "home")]})
        changes.refine_changes(spark, bronze, store)
    assert keys == [[], [2]]
    assert_equal_to_full_refine(spark, folder, store, "end")
