from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from checks.fixtures import Inputs
from sluicebox.contracts import FLAGS
from sluicebox.functions import numbers, text
from sluicebox.operators import keys, quality
from sluicebox.plans import silver
from sluicebox.sources.storage import Staging, read_table

CUSTOMER = (
    "customer_id string, customer_name string, email string, phone string, city string, state string, country string, "
    "registration_date string, customer_segment string, ingestion_timestamp timestamp, batch_id string"
)


def customer(spark, *rows):
    return spark.createDataFrame(list(rows), CUSTOMER)


def at(hour):
    return datetime(2026, 7, 23, hour)


def one(df):
    (row,) = df.collect()
    return row


def test_newest_valid_customer_wins_and_bad_ones_are_kept_aside(spark):
    rows = customer(
        spark,
        ("1", "  alice  shah ", "ALICE@EXAMPLE.COM", "+917", "pune", "maharashtra", "india", "2026-01-01", "premium", at(10), "batch-a"),
        ("1", "Alice Shah", "alice.new@example.com", "+917", "Pune", "Maharashtra", "India", "2026-01-02", "premium", at(11), "batch-b"),
        (None, "Missing Id", "bad@example.com", "+918", "Mumbai", "Maharashtra", "India", "2026-01-03", "regular", at(12), "batch-c"),
    )
    valid, rejected = silver.clean("customers", rows)
    kept = one(valid)
    assert (kept.customer_id, kept.email, kept.city) == (1, "alice.new@example.com", "Pune")
    assert kept.registration_date == date(2026, 1, 2)
    assert kept.silver_processed_timestamp is not None
    assert one(rejected)[FLAGS] == ["missing_customer_id"]


def test_older_valid_row_beats_newer_invalid_one(spark):
    rows = customer(
        spark,
        ("1", "Old", "a@b.c", "1", "x", "y", "z", "2026-01-01", None, at(10), "a"),
        ("1", "New", "", "1", "x", "y", "z", "2026-01-01", None, at(11), "b"),
    )
    valid, rejected = silver.clean("customers", rows)
    assert (one(valid).customer_name, one(valid).customer_segment) == ("Old", "unknown")
    assert one(rejected)[FLAGS] == ["missing_email"]


def test_bad_casts_become_null_instead_of_failing(spark):
    rows = spark.createDataFrame([("abc",), ("12.7",), (" 5 ",), ("",), ("1e3",), (None,)], "v string")
    got = rows.select(numbers.to_long("v").alias("l"), numbers.to_double("v").alias("d")).collect()
    assert [r.l for r in got] == [None, 12, 5, None, None, None]
    assert [r.d for r in got] == [None, 12.7, 5.0, None, 1000.0, None]


def test_text_functions(spark):
    row = spark.createDataFrame([("  mary  o'neil-SMITH ", None)], "a string, b string")
    got = one(
        row.select(
            text.tidy_name("a"), text.titled("a"), text.snake_code("a"), text.is_blank("b"), text.or_unknown(F.col("b"))
        )
    )
    assert list(got) == ["Mary O'neil-smith", "Mary  O'neil-smith", "mary_o'neil-smith", True, "unknown"]


def order(spark, **change):
    base = dict(
        order_id="1", customer_id="7", order_date="2026-01-01", order_status=" Delivered ", shipping_city="a",
        shipping_state="b", payment_method=" UPI ", order_total="10", ingestion_timestamp=at(1), batch_id="a",
    )
    ddl = ", ".join(f"{k} {'timestamp' if k == 'ingestion_timestamp' else 'string'}" for k in base)
    return spark.createDataFrame([tuple((base | change).values())], ddl)


@pytest.fixture
def customers(spark):
    return spark.createDataFrame([(7,)], "customer_id bigint")


@pytest.mark.parametrize(
    "change, flags",
    [
        ({}, []),
        ({"order_status": None}, []),
        ({"order_status": "On  Hold"}, ["invalid_order_status"]),
        ({"customer_id": "8"}, ["missing_customer_fk"]),
        ({"customer_id": None}, ["missing_customer_id"]),
        ({"order_total": "-1", "order_date": "x"}, ["invalid_order_date", "invalid_order_total"]),
        ({"order_id": None, "customer_id": "9", "order_total": None}, ["missing_order_id", "invalid_order_total", "missing_customer_fk"]),
    ],
)
def test_order_rules_in_order(spark, customers, change, flags):
    assert one(silver.flagged("orders", order(spark, **change), {"customers": customers}))[FLAGS] == flags


PRODUCT = "product_id string, product_name string, category_id string, brand string, price string, cost_price string, rating string, created_at string"


@pytest.mark.parametrize(
    "row, flags",
    [
        (("1", "a", "1", "b", "1", "0", "5", "2020-01-01"), []),
        (("1", "a", "1", "b", "0", "-1", "5.1", "2020-01-01"), ["invalid_price", "invalid_cost_price", "invalid_rating"]),
        (("1", " ", None, "b", None, None, None, None),
         ["missing_product_name", "missing_category_id", "invalid_price", "invalid_cost_price", "invalid_rating", "invalid_created_at"]),
        (("1", "a", "2", "b", "1", "1", "-0.1", "2020-01-01"), ["invalid_rating", "missing_category_fk"]),
    ],
)
def test_product_rules(spark, row, flags):
    categories = spark.createDataFrame([(1,)], "category_id bigint")
    rows = spark.createDataFrame([row], PRODUCT)
    assert one(silver.flagged("products", rows, {"categories": categories}))[FLAGS] == flags


@pytest.mark.parametrize(
    "status, amount, flags",
    [
        ("paid", "100.05", []),
        ("paid", "100.06", ["payment_amount_mismatch"]),
        (" REFUNDED", "90", ["payment_amount_mismatch"]),
        ("failed", "1", []),
        (None, "1", []),
        ("lost", "1", ["invalid_payment_status"]),
        ("paid", "-1", ["invalid_payment_amount", "payment_amount_mismatch"]),
    ],
)
def test_payment_rules(spark, status, amount, flags):
    orders = spark.createDataFrame([(1, 100.0)], "order_id bigint, order_total double")
    rows = spark.createDataFrame(
        [("1", "1", "upi", status, amount, "2026-01-01 10:00:00")],
        "payment_id string, order_id string, payment_method string, payment_status string, payment_amount string, payment_timestamp string",
    )
    assert one(silver.flagged("payments", rows, {"orders": orders}))[FLAGS] == flags


def test_rejected_parent_rejects_its_children(spark, data):
    from checks.fixtures import Inputs

    cleaned = silver.clean_all(Inputs(spark, data).raw_tables())
    bad_category = {r.category_id for r in cleaned["categories"].rejected.collect()}
    assert bad_category
    lost = cleaned["products"].rejected.filter(F.col("category_id").isin(*bad_category))
    assert lost.count() > 0
    assert lost.filter(~F.array_contains(FLAGS, "missing_category_fk")).count() == 0
    assert cleaned["order_items"].rejected.filter(F.array_contains(FLAGS, "missing_product_fk")).count() > 0


def test_dependencies_come_first_and_unknown_tables_are_named():
    assert silver.with_dependencies(["payments"]) == ["customers", "orders", "payments"]
    assert silver.with_dependencies(["order_items"]) == ["categories", "customers", "products", "orders", "order_items"]
    assert silver.with_dependencies(None) == list(silver.CLEANINGS)
    with pytest.raises(ValueError, match="users"):
        silver.with_dependencies(["users"])


def test_stored_pipeline_equals_lazy_cleaning(spark, data, folder):
    """The pipeline marks orphans from staged key sets; the lazy API joins parents. Both give the same rows."""
    from checks.fixtures import Inputs

    raw = Inputs(spark, data).raw_tables()
    for table, df in raw.items():
        df.write.parquet(f"{folder}/bronze/{table}")
    counts = {c.table: c for c in silver.refine(spark, f"{folder}/bronze", f"{folder}/silver", f"{folder}/q")}
    lazy = silver.clean_all(raw)
    for table in ("products", "orders", "order_items", "payments"):
        for part, root in (("valid", "silver"), ("rejected", "q/silver")):
            stored = read_table(spark, f"{folder}/{root}/{table}").drop("silver_processed_timestamp")
            expected = getattr(lazy[table], part).select(*stored.columns)
            assert stored.exceptAll(expected).count() == 0 and expected.exceptAll(stored).count() == 0
        assert counts[table].read == raw[table].count()
        assert counts[table].rejected == lazy[table].rejected.count()


def test_clean_run_leaves_no_stale_quarantine(spark, folder):
    ddl = "category_id string, category_name string, department string, ingestion_timestamp timestamp, batch_id string"
    for department, rejected in (("", 1), ("d", 0)):
        rows = spark.createDataFrame([("1", "a", department, at(1), "a")], ddl)
        rows.write.mode("overwrite").parquet(f"{folder}/bronze/categories")
        silver.refine(spark, f"{folder}/bronze", f"{folder}/silver", f"{folder}/q", ["categories"])
        assert read_table(spark, f"{folder}/q/silver/categories").count() == rejected


def test_rerun_of_bronze_collapses_to_one_row(spark):
    rows = customer(
        spark,
        *[("1", "A", "a@b.c", "1", "x", "y", "z", "2026-01-01", None, at(h), f"run-{h}") for h in (1, 2, 3)],
    )
    assert one(silver.clean("customers", rows).valid).batch_id == "run-3"


def test_hot_key_is_cut_before_the_shuffle(spark):
    """One key holds most rows; the plan limits groups on both sides of the exchange."""
    rows = spark.range(30000).select(
        F.when(F.col("id") < 20000, 1).otherwise(F.col("id")).alias("k"), F.col("id").alias("batch_id")
    )
    newest = keys.latest_per_key(rows, ["k"], ["batch_id"])
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    before, after = plan.split("Exchange hashpartitioning", 1)
    assert "Final" in before and "Partial" in after
    assert newest.count() == 10001
    assert newest.filter("k = 1").first().batch_id == 19999


def test_orphans_agree_with_and_without_broadcast(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (None,), (3,)], "k bigint")
    parent = spark.createDataFrame([(1,), (3,)], "k bigint")
    expected = sorted(keys.with_parent(child, parent, "k", "k", "gone").collect(), key=repr)
    orphans = keys.orphan_keys(child, parent, "k", "k")
    assert [r.k for r in orphans.collect()] == [2]
    for hinted in (orphans, orphans.hint("broadcast"), orphans.hint("merge")):
        assert sorted(keys.with_orphans(child, hinted, "k", "gone").collect(), key=repr) == expected


def test_positions_are_a_total_order(spark):
    from sluicebox.sources.storage import ensure_checkpoint_folder

    ensure_checkpoint_folder(spark)
    rows = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v")).repartition(7)
    placed = keys.with_position(rows, ["v"])
    assert placed.filter("v <> position").count() == 0 and placed.count() == 1000


def test_flag_report_and_empty_rules(spark):
    rows = quality.with_flags(
        spark.createDataFrame([(1,), (2,), (None,)], "v int"),
        [quality.Rule("low", "v < 2"), quality.Rule("absent", "v IS NULL")],
    )
    report = {(r.table_name, r.flag): r.rejected_rows for r in quality.flag_report({"t": rows}).collect()}
    assert report == {("t", "low"): 1, ("t", "absent"): 1}
    assert one(quality.with_flags(spark.range(1), []))[FLAGS] == []


def test_rejected_flags_store_parent_keys_only(spark, data, folder):
    raw, stored = Inputs(spark, data).raw_tables(), {}

    def keep(df, name):
        df.write.parquet(f"{folder}/{name}")
        stored[name] = spark.read.parquet(f"{folder}/{name}")
        return stored[name]

    def tally(rejected):
        return sorted(tuple(r) for r in quality.flag_report(rejected).collect())

    found = silver.rejected_flags(raw, keep)
    cleaned = silver.clean_all(raw, Staging(spark, f"{folder}/all").store)
    assert tally(found) == tally({table: part.rejected for table, part in cleaned.items()})
    assert {name: df.columns for name, df in stored.items()} == {
        "categories-keys": ["category_id"], "customers-keys": ["customer_id"],
        "products-keys": ["product_id"], "orders-keys": ["order_id", "order_total"],
    }
    for table, part in cleaned.items():
        if f"{table}-keys" in stored:
            keys = stored[f"{table}-keys"]
            assert sorted(map(tuple, keys.collect())) == sorted(map(tuple, part.valid.select(*keys.columns).collect()))


def test_many_neighbouring_ids_are_marked_by_bitmaps(spark, folder, monkeypatch):
    """Also ids below zero, at the edges of bitmaps and at the ends of the range; too sparse sets are joined."""
    ids = [0, 1, -1, 7, 8, 32767, 32768, 32769, 65536, 65537, -32767, -32768, -32769, 2**63 - 1, -(2**63), 99999999999]
    child = spark.createDataFrame([(i,) for i in (None, *ids, *[i + 1 for i in ids[:-3]], 2, 9, 10**11)], "k bigint")
    keep = Staging(spark, folder).store
    orphans = keep(spark.createDataFrame([(i,) for i in ids], "k bigint"), "ids")
    expected = sorted((r.k, r.k in ids) for r in child.where("k IS NOT NULL").collect())
    for few_keys, few_maps, plan in ((100, 100, "Join"), (0, 100, "_bits"), (0, 1, "SortMergeJoin")):
        monkeypatch.setattr(keys, "BROADCAST_KEYS", few_keys)
        monkeypatch.setattr(keys, "BROADCAST_BITMAPS", few_maps)
        marked = keys.with_stored_orphans(child, orphans, "k", "missing", keep, f"ids-{few_keys}-{few_maps}")
        assert plan in marked._jdf.queryExecution().executedPlan().toString()
        assert sorted(tuple(r) for r in marked.where("k IS NOT NULL").collect()) == expected
        assert [r.missing for r in marked.where("k IS NULL").collect()] == [False]


@pytest.mark.parametrize("few_keys, few_maps, ranked", [(100, 100, 5), (0, 100, 5), (0, 0, 7)])
def test_only_rows_of_repeated_keys_are_ranked(spark, folder, monkeypatch, few_keys, few_maps, ranked):
    rows = [(1, 1, "a"), (2, 1, "b"), (2, 2, "c"), (None, 1, "d"), (None, 3, "e"), (None, 2, "f"), (40000, 1, "g")]
    monkeypatch.setattr(keys, "BROADCAST_KEYS", few_keys)
    monkeypatch.setattr(keys, "BROADCAST_BITMAPS", few_maps)
    keep, seen, latest = Staging(spark, folder).store, [], keys.latest_per_key
    stored = keep(spark.createDataFrame(rows, "k bigint, at int, v string"), "rows")

    def look(df, *rest):
        seen.append(df.count())
        return latest(df, *rest)

    monkeypatch.setattr(keys, "latest_per_key", look)
    alone, newest = keys.latest_per_key_of_stored(stored, ["k"], ["at"], keep, "repeated")
    got = sorted((alone.unionByName(newest)).collect(), key=lambda r: r.v)
    assert [r.v for r in got] == ["a", "c", "e", "g"] and seen == [ranked]
    assert [tuple(r) for r in got] == [(1, 1, "a"), (2, 2, "c"), (None, 3, "e"), (40000, 1, "g")]
    both, none = keys.latest_per_key_of_stored(stored.withColumn("w", F.col("v")), ["k", "w"], ["at"], keep, "repeated-2")
    assert both.count() == 7 and none.count() == 0


def test_whole_rows_are_not_shuffled_by_clean(spark, folder, data):
    """Parents and newest rows are settled by bare keys: the flagged rows hold no sort-merged join and no window."""
    t, texts = Inputs(spark, data), {}

    def keep(df, name):
        texts[name] = df._jdf.queryExecution().executedPlan().toString()
        return Staging(spark, folder).store(df, name)

    names = ("categories", "products", "customers", "orders", "order_items")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10000")
    try:
        cleaned = silver.clean_all({name: t[f"raw_{name}"] for name in names}, keep)
        plain = silver.clean_all({name: t[f"raw_{name}"] for name in names})
        for part in ("valid", "rejected"):
            ours, theirs = (sorted(map(str, getattr(c["order_items"], part).drop("silver_processed_timestamp").collect())) for c in (cleaned, plain))
            assert ours == theirs != []
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" not in texts["order_items-flagged"]
