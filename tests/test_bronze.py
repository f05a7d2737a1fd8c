import hashlib
import os

import pytest
from pyspark.sql import functions as F

from checks import layer_checks
from sluicebox import contracts
from sluicebox.plans import bronze
from sluicebox.sources.csv import read_source_csv, require_sources
from sluicebox.sources.storage import Staging, filesystem_path, read_table, write_counted


def write(path, text):
    with open(path, "w", encoding="utf-8") as file:
        file.write(text)


MIXED = "category_id,category_name,department\n1,2\n1,2,3\n1,2,3,4\n,,\n\"u\n"


def test_raw_sources_end_with_the_corrupt_column():
    assert set(contracts.RAW_SOURCES) == {
        "customers", "categories", "products", "orders", "order_items", "payments", "inventory",
    }
    for source in contracts.RAW_SOURCES.values():
        assert source.schema.names[-1] == contracts.CORRUPT
        assert {f.dataType.simpleString() for f in source.schema} == {"string"}


def test_unknown_source_is_named():
    with pytest.raises(ValueError, match="users"):
        contracts.raw_source("users")


def test_malformed_lines_do_not_depend_on_the_columns_read(spark, folder):
    write(f"{folder}/categories.csv", MIXED)
    rows = read_source_csv(spark, contracts.raw_source("categories"), f"{folder}/categories.csv")
    good, bad = bronze.split_malformed(rows)
    assert [r.category_id for r in good.select("category_id").collect()] == ["1", None]
    assert sorted(r.category_id for r in bad.select("category_id", contracts.CORRUPT).collect()) == ["1", "1", "u"]
    assert contracts.CORRUPT not in good.columns


def test_load_counts_quarantine_and_append(spark, folder):
    write(f"{folder}/categories.csv", MIXED)
    for batch in ("a", "b"):
        (counts,) = bronze.load_sources(
            spark, folder, f"{folder}/bronze", f"{folder}/quarantine", ["categories"], batch
        )
        assert (counts.read, counts.written, counts.rejected) == (5, 2, 3)
    stored = read_table(spark, f"{folder}/bronze/categories")
    assert stored.count() == 4
    assert {r.batch_id for r in stored.collect()} == {"a", "b"}
    for batch in ("a", "b"):
        assert read_table(spark, f"{folder}/quarantine/bronze/categories/{batch}").count() == 3


def test_no_quarantine_without_malformed_lines(spark, folder):
    write(f"{folder}/categories.csv", "category_id,category_name,department\n1,a,b\n")
    bronze.load_sources(spark, folder, f"{folder}/bronze", f"{folder}/quarantine", ["categories"], "x")
    assert not os.path.exists(f"{folder}/quarantine/bronze/categories/x")


def test_missing_files_are_all_named(spark, folder):
    write(f"{folder}/orders.csv", "order_id\n")
    with pytest.raises(FileNotFoundError, match="customers.csv, payments.csv"):
        require_sources(spark, folder, ["customers", "orders", "payments"])
    with pytest.raises(FileNotFoundError):
        read_source_csv(spark, contracts.raw_source("customers"), f"{folder}/customers.csv")
    with pytest.raises(FileNotFoundError):
        read_table(spark, f"{folder}/nowhere")


def test_hash_takes_null_as_empty_and_metadata_is_added(spark):
    source = contracts.raw_source("categories")
    rows = spark.createDataFrame([("1", None, "x"), ("1", "", "x")], "category_id string, category_name string, department string")
    out = bronze.with_load_metadata(rows, source, "f.csv", "b", F.lit("2024-01-01").cast("timestamp")).collect()
    expected = hashlib.sha256(b"1||||x").hexdigest()
    assert [r.record_hash for r in out] == [expected, expected]
    assert {(r.source_system, r.source_file, r.batch_id) for r in out} == {("ecommerce_batch", "f.csv", "b")}


def test_run_report(spark):
    counts = [bronze.LoadCounts("orders", "b", 5, 3, 2)]
    assert bronze.run_report(spark, counts).collect() == [("orders", 5, 3, 2)]


def test_stored_row_hashes_take_little_more_than_their_bytes(spark, folder):
    rows = spark.range(20_000).selectExpr("id", "md5(CAST(id AS STRING)) AS record_hash")
    Staging(spark, f"{folder}/stage").store(rows, "rows")
    assert write_counted(rows, f"{folder}/table", "append") == {"rows": 20_000}
    for path in (f"{folder}/stage/rows", f"{folder}/table"):
        stored = spark.read.parquet(path)
        assert stored.exceptAll(rows).isEmpty() and stored.count() == 20_000
        fs, target = filesystem_path(spark, path)
        assert fs.getContentSummary(target).getLength() < 20_000 * 26  # 16 bytes of hash and 8 of id; 40 as text


def test_only_files_with_malformed_lines_are_parsed_again(spark, folder, monkeypatch):
    path = f"{folder}/categories.csv"
    os.makedirs(path)
    write(f"{path}/good.csv", "category_id,category_name,department\n7,a,b\n")
    write(f"{path}/bad [1] 100%25 é.csv", MIXED)
    plain, calls = bronze.writer_of, []

    def writer_of(df, fmt):
        calls.append(fmt)
        if len(calls) == 2:
            os.remove(f"{path}/good.csv")
        return plain(df, fmt)

    monkeypatch.setattr(bronze, "writer_of", writer_of)
    (counts,) = bronze.load_sources(spark, folder, f"{folder}/bronze", f"{folder}/quarantine", ["categories"], "a")
    assert (counts.read, counts.written, counts.rejected) == (6, 3, 3)
    kept = read_table(spark, f"{folder}/quarantine/bronze/categories/a")
    assert kept.count() == 3 and "_file" not in kept.columns
    assert "_file" not in read_table(spark, f"{folder}/bronze/categories").columns


def test_raw_files_of_the_checks_are_small_and_whole(spark, tmp_path, monkeypatch):
    """Raw files are written under gzip, a bounded number of rows each, and read back as they were."""
    monkeypatch.setattr(layer_checks, "CSV_ROWS", 300)
    source = contracts.raw_source("categories")
    texts = [None, " x ", 'a "b", c', "plain", "  two   words  "]
    rows = [(str(i), texts[i % 5], f"general store {i % 3}") for i in range(1000)]
    df = spark.createDataFrame(rows, list(source.columns)).coalesce(1)
    layer_checks._write_csv(df, str(tmp_path / "raw.csv"))
    layer_checks._write_csv(df.limit(10), str(tmp_path / "raw.csv"))
    files = list((tmp_path / "raw.csv").glob("part-*"))
    assert len(files) >= 5 and all(f.name.endswith(".csv.gz") for f in files)
    assert sum(f.stat().st_size for f in files) < sum(len(",".join(map(str, r))) for r in rows) / 2
    back = [tuple(r) for r in read_source_csv(spark, source, str(tmp_path / "raw.csv")).select(*source.columns).collect()]
    assert sorted(back, key=str) == sorted(rows + rows[:10], key=str)
