"""Several tables in one commit: readers, failures, conflicts, retention."""

import os
import threading
import time

import pytest
from pyspark.sql import functions as F

from sluicebox.contracts import SERVING_TABLES, raw_source
from sluicebox.plans import gold, serving, silver
from sluicebox.sources.snapshots import Conflict, Snapshots


def numbers(spark, load, rows=50):
    return spark.range(rows).select("id", F.lit(load).alias("load"))


def broken(spark):
    return spark.range(5).select(F.when(F.col("id") > 3, F.raise_error(F.lit("broken row"))).alias("x"))


def test_tables_of_a_load_appear_together(spark, folder):
    store = Snapshots(spark, f"{folder}/s")
    assert store.current().version == 0 and not store.current().tables
    assert store.commit({"a": numbers(spark, 1, 3), "b": numbers(spark, 1, 4)}) == {"a": 3, "b": 4}
    store.commit({"b": numbers(spark, 2, 5)})
    view = store.current()
    assert (view.version, view.rows("a"), view.rows("b")) == (2, 3, 5)
    assert {name: df.count() for name, df in view.read_all().items()} == {"a": 3, "b": 5}
    assert store.at(1).read("b").count() == 4
    assert "c" not in view
    with pytest.raises(KeyError):
        view.read("c")


def test_a_failed_table_leaves_all_others_old(spark, folder):
    store = Snapshots(spark, f"{folder}/s")
    store.commit({name: numbers(spark, 1) for name in "abc"})
    before = {os.path.join(d, f) for d, _, names in os.walk(folder) for f in names}
    with pytest.raises(Exception, match="broken row"):
        store.commit({"a": numbers(spark, 2), "b": numbers(spark, 2), "c": broken(spark)})
    assert all({r.load for r in df.collect()} == {1} for df in store.current().read_all().values())
    assert {os.path.join(d, f) for d, _, names in os.walk(folder) for f in names} == before  # nothing is left behind


def test_readers_during_loads_see_one_load(spark, folder):
    """A reader in a loop: all tables of one load, old or new, never a mix and never nothing."""
    store = Snapshots(spark, f"{folder}/s", keep=4)
    store.commit({name: numbers(spark, 0) for name in "abc"})
    seen, wrong, done = [], [], threading.Event()

    def reader():
        while not done.is_set():
            try:
                view = store.current()
                loads = {name: {r.load for r in view.read(name).distinct().select("load").collect()} for name in "abc"}
                values = set().union(*loads.values())
                seen.append(values)
                if len(values) != 1 or any(not found for found in loads.values()):
                    wrong.append(loads)
            except Exception as error:  # noqa: BLE001
                wrong.append(error)

    threads = [threading.Thread(target=reader) for _ in range(2)]
    for thread in threads:
        thread.start()
    for load in range(1, 9):
        store.commit({name: numbers(spark, load) for name in "abc"})
        time.sleep(0.2)
    done.set()
    for thread in threads:
        thread.join()
    assert not wrong and len({min(values) for values in seen}) > 2


def test_loads_at_the_same_time_all_get_in(spark, folder):
    store, failed = Snapshots(spark, f"{folder}/s"), []

    def load(name):
        try:
            for k in range(3):
                store.commit({name: numbers(spark, k)})
        except Exception as error:  # noqa: BLE001
            failed.append(error)

    threads = [threading.Thread(target=load, args=(name,)) for name in "abc"]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    view = store.current()
    assert not failed and view.version == 9
    assert {name: view.read(name).first().load for name in "abc"} == dict.fromkeys("abc", 2)


def test_a_load_made_from_an_old_version_is_refused(spark, folder):
    store = Snapshots(spark, f"{folder}/s")
    store.commit({"a": numbers(spark, 1), "b": numbers(spark, 1)})
    base = store.current()
    store.commit({"a": numbers(spark, 2)})
    with pytest.raises(Conflict, match="'a'"):
        store.commit({"a": base.read("a").withColumn("load", F.lit(9))}, base)
    store.commit({"b": base.read("b").withColumn("load", F.lit(3))}, base)  # b is as it was
    assert [store.read(name).first().load for name in "ab"] == [2, 3]


def test_old_versions_go_and_unpublished_folders_wait(spark, folder):
    store = Snapshots(spark, f"{folder}/s", keep=2)
    store.commit({"kept": numbers(spark, 0)})
    for k in range(5):
        store.commit({"a": numbers(spark, k)})
    assert store.versions() == [5, 6] and len(os.listdir(f"{folder}/s/data/a")) == 2
    assert store.read("kept").count() == 50
    numbers(spark, 7).write.parquet(f"{folder}/s/data/a/left-behind")
    store.commit({"a": numbers(spark, 8)})
    assert os.path.isdir(f"{folder}/s/data/a/left-behind")
    assert store.sweep(older_than_hours=1) == [] and store.sweep(older_than_hours=-1) == ["data/a/left-behind"]
    assert store.read("a").count() == 50


def test_a_load_reads_its_own_tables(spark, folder):
    store = Snapshots(spark, f"{folder}/s")
    store.commit({"parent": numbers(spark, 1, 5)})
    with store.load() as load:
        load.write("parent", numbers(spark, 2, 7))
        load.write("child", load.read("parent").where("id > 2"))
        assert store.read("parent").count() == 5
    assert (store.read("parent").count(), store.read("child").count()) == (7, 4)


# ---- layers -----------------------------------------------------------------------------------------------

RAW = {
    "categories": [("1", "audio", "shop"), ("2", " ", "shop")],
    "customers": [("1", "ann", "a@b.c", "1", "x", "y", "z", "2020-01-01", "gold"), ("2", "bob", None, "1", "x", "y", "z", "2020-01-01", None)],
    "products": [("1", "radio", "1", "b", "5", "3", "4", "2020-01-01"), ("2", "lamp", "2", "b", "5", "3", "4", "2020-01-01")],
    "orders": [("1", "1", "2026-07-01", "delivered", "c", "s", "card", "10"), ("2", "2", "2026-07-01", "delivered", "c", "s", "card", "5")],
    "order_items": [("1", "1", "1", "2", "5", "0", "10"), ("2", "2", "1", "1", "5", "0", "5")],
    "payments": [("1", "1", "card", "paid", "10", "2026-07-01 10:00:00"), ("2", "1", "card", "paid", "99", "2026-07-01 10:00:00")],
    "inventory": [("1", "w1", "5", "2", "2026-07-01 10:00:00"), ("2", "w1", "5", "2", "2026-07-01 10:00:00")],
}


def store_bronze(spark, root, raw=RAW):
    for name, rows in raw.items():
        df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in raw_source(name).columns))
        df = df.withColumns({"ingestion_timestamp": F.current_timestamp(), "batch_id": F.lit("1"), "record_hash": F.lit("h")})
        df.write.mode("overwrite").parquet(f"{root}/{name}")


def test_layers_publish_all_their_tables_at_once(spark, folder):
    store_bronze(spark, f"{folder}/bronze")
    plain = silver.refine(spark, f"{folder}/bronze", f"{folder}/silver", f"{folder}/quarantine")
    layer = Snapshots(spark, f"{folder}/silver-versions")
    assert silver.refine_together(spark, f"{folder}/bronze", layer) == plain
    view = layer.current()
    assert view.version == 1 and len(view.tables) == 14
    for name in RAW:
        for versioned, path in ((name, f"{folder}/silver/{name}"), (silver.rejected_name(name), f"{folder}/quarantine/silver/{name}")):
            left, right = (df.drop("silver_processed_timestamp") for df in (view.read(versioned), spark.read.parquet(path)))
            assert sorted(left.collect(), key=str) == sorted(right.select(left.columns).collect(), key=str)

    business = Snapshots(spark, f"{folder}/gold-versions")
    built = gold.build_together(view, business, as_of="2026-07-30")
    assert built == gold.build_all(spark, f"{folder}/silver", f"{folder}/gold", as_of="2026-07-30")
    target = serving.SnapshotTarget(Snapshots(spark, f"{folder}/served"))
    loads = serving.load_serving_view(business.current(), target)
    assert [(x.table, x.rows) for x in loads] == [(b.table, b.written) for b in built]
    assert loads == serving.load_serving(spark, f"{folder}/gold", target)
    served = target.view()
    assert served.version == 2 and set(served.tables) == {b.table for b in built}
    for name in served.tables:
        assert served.read(name).columns == SERVING_TABLES[name].columns
    with pytest.raises(FileNotFoundError, match="realtime_metrics"):
        serving.load_serving_view(business.current(), target, ["realtime_metrics"])


def test_a_broken_layer_publishes_nothing(spark, folder):
    store_bronze(spark, f"{folder}/bronze")
    layer = Snapshots(spark, f"{folder}/versions")
    silver.refine_together(spark, f"{folder}/bronze", layer)
    spark.range(3).write.mode("overwrite").parquet(f"{folder}/bronze/inventory")  # the last table has no column it needs
    with pytest.raises(Exception, match="product_id"):
        silver.refine_together(spark, f"{folder}/bronze", layer)
    assert layer.current().version == 1 and layer.read("inventory").count() == 1


class Recorded:
    """A database connection that writes down what it is asked."""

    def __init__(self, fails=""):
        self.calls, self.fails = [], fails

    def createStatement(self):  # noqa: N802
        return self

    def executeUpdate(self, sql):  # noqa: N802
        self.calls.append(sql)
        if self.fails and self.fails in sql:
            raise RuntimeError("duplicate key")

    def __getattr__(self, name):
        return lambda *args: self.calls.append((name, *args))


def test_database_tables_are_swapped_in_one_transaction():
    swaps = {"a": ("a_1", ["x", "y"]), "b": ("b_1", ["z"])}
    connection = Recorded()
    serving.swap_tables(connection, swaps)
    assert connection.calls == [
        ("setAutoCommit", False), "DELETE FROM a", "INSERT INTO a (x, y) SELECT x, y FROM a_1", "DELETE FROM b",
        "INSERT INTO b (z) SELECT z FROM b_1", ("commit",),
    ]
    connection = Recorded(fails="INTO b")
    with pytest.raises(RuntimeError):
        serving.swap_tables(connection, swaps)
    assert connection.calls[-1] == ("rollback",) and ("commit",) not in connection.calls
