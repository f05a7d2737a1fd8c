import pytest

from sluicebox.contracts import SERVING_TABLES
from sluicebox.plans import governed

# what the fixture's stand-in tables offer
ALLOWED = {
    name: ("product_id", "net_revenue", "m")
    for name in ("product_performance", "customer_360", "inventory_health", "daily_sales_summary")
}


@pytest.fixture
def gold(spark):
    for name in ("product_performance", "customer_360", "inventory_health", "daily_sales_summary"):
        spark.range(300).selectExpr("id AS product_id", "id AS net_revenue", "id % 12 + 1 AS m").createOrReplaceTempView(name)
    spark.range(3).createOrReplaceTempView("users")
    yield
    for view in ("product_performance", "customer_360", "inventory_health", "daily_sales_summary", "users"):
        spark.catalog.dropTempView(view)


@pytest.mark.parametrize(
    "sql, part",
    [
        ("", "empty"),
        ("DROP TABLE customer_360", "Only SELECT"),
        ("INSERT INTO customer_360 SELECT * FROM customer_360", "Only SELECT"),
        ("CREATE TABLE t AS SELECT * FROM customer_360", "Only SELECT"),
        ("SELECT * FROM users", "not approved"),
        ("SELECT * FROM customer_360, users", "not approved"),
        ("SELECT * FROM `users`", "not approved"),
        ("SELECT * FROM customer_360 WHERE product_id IN (SELECT id FROM users)", "not approved"),
        ("SELECT (SELECT max(id) FROM users) FROM customer_360", "not approved"),
        ("SELECT * FROM parquet.`/tmp/customer_360`", "not approved"),
        ("WITH q AS (SELECT * FROM users) SELECT * FROM q", "not approved"),
        ("WITH users AS (SELECT * FROM users) SELECT * FROM users, customer_360", "hides"),
        ("SELECT 1", "at least one"),
        ("SELECT * FROM range(5)", "Not allowed"),
        ("SELECT * FROM customer_360, range(5)", "Not allowed"),
        ("SELECT * FROM customer_360, IDENTIFIER('users')", "Not allowed"),
        ("SELECT * FROM customer_360, IDENTIFIER('us' || 'ers')", "Not allowed"),
        ("SELECT (SELECT max(id) FROM IDENTIFIER('users')) FROM customer_360", "Not allowed"),
        ("SELECT IDENTIFIER('reflect')('java.lang.System', 'nanoTime') FROM customer_360", "Not allowed"),
        ("SELECT IDENTIFIER('product_id') FROM customer_360", "Not allowed"),
        ("SELECT * FROM customer_360 LATERAL VIEW explode(array(1)) t AS y", "Not allowed"),
        ("SELECT /*+ BROADCAST(customer_360) */ * FROM customer_360", "Only SELECT"),
        ("SELECT :p FROM customer_360", "Not allowed"),
        ("SELECT input_file_name() FROM customer_360", "Function is not allowed"),
        ("SELECT my_function(product_id) FROM customer_360", "Function is not allowed"),
        ("SELECT spark_catalog.default.sum(product_id) FROM customer_360", "Function is not allowed"),
        ("SELECT reflect('java.lang.System', 'nanoTime') FROM customer_360", "not allowed"),
        ("SELECT * FROM customer_360; SELECT * FROM inventory_health", "Multiple"),
        ("SELECT (FROM", "cannot be parsed"),
    ],
)
def test_rejected(spark, gold, sql, part):
    verdict = governed.check_sql(spark, sql)
    assert not verdict.ok and part in verdict.error
    with pytest.raises(ValueError):
        governed.run_approved(spark, sql)


@pytest.mark.parametrize(
    "sql, rows",
    [
        ("SELECT product_id FROM product_performance ORDER BY net_revenue DESC", 100),
        ("SELECT product_id FROM product_performance;", 100),
        ("SELECT product_id FROM product_performance LIMIT 200", 200),
        ("SELECT a.product_id FROM (SELECT * FROM product_performance LIMIT 150) a", 100),
        ("SELECT p.product_id, 'drop; update' AS text FROM product_performance p JOIN customer_360 c USING (product_id)", 100),
        ("WITH q AS (SELECT * FROM product_performance) SELECT m, count(*) AS n FROM q GROUP BY m HAVING n > 1", 12),
        ("SELECT extract(month FROM date_add(DATE '2026-01-01', 5)) AS m FROM daily_sales_summary LIMIT 1", 1),
        ("SELECT product_id FROM customer_360 UNION SELECT product_id FROM inventory_health", 100),
        ("SELECT product_id FROM customer_360 -- all of them", 100),
        ("SELECT product_id FROM customer_360 ORDER BY product_id OFFSET 5", 100),
        ("SELECT product_id FROM customer_360 ORDER BY product_id OFFSET 250", 50),
        ("SELECT product_id FROM customer_360 LIMIT 10 OFFSET 5", 10),
        ("SELECT product_id FROM customer_360 LIMIT ALL", 100),
        ("SELECT m, row_number() OVER (PARTITION BY m ORDER BY net_revenue DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) r FROM customer_360", 100),
        ("SELECT CASE WHEN m > 6 THEN 'late' ELSE 'early' END half, sum(net_revenue) FROM customer_360 GROUP BY ROLLUP(1)", 3),
    ],
)
def test_accepted(spark, gold, sql, rows):
    assert governed.run_approved(spark, sql, allowed=ALLOWED).count() == rows


def test_default_limit_is_written_out(spark):
    verdict = governed.check_sql(spark, "SELECT product_name FROM product_performance ORDER BY net_revenue DESC")
    assert verdict.ok and verdict.sql.endswith("LIMIT 100")


def test_only_approved_names_are_registered(spark):
    with pytest.raises(ValueError):
        governed.run_approved(spark, "SELECT 1", {"users": spark.range(1)})


# ---- columns ----------------------------------------------------------------------------------------------


@pytest.fixture
def wide(spark):
    """All six tables with their contract's columns and one more."""
    frames = {}
    for name, table in SERVING_TABLES.items():
        columns = [f"CAST({'id' if f.dataType.typeName() in ('long', 'double', 'string') else 'NULL'} AS {f.dataType.simpleString()}) AS {f.name}" for f in table.schema]
        frames[name] = spark.range(4).selectExpr(*columns, "id AS internal_note")
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
    yield frames
    for name in frames:
        spark.catalog.dropTempView(name)


@pytest.mark.parametrize("table", list(SERVING_TABLES))
def test_contract_columns_can_be_read_and_no_other(spark, wide, table):
    columns = ", ".join(SERVING_TABLES[table].columns)
    assert governed.run_approved(spark, f"SELECT {columns} FROM {table}").count() == 4
    for sql in (f"SELECT * FROM {table}", f"SELECT internal_note FROM {table}", f"SELECT Internal_Note AS n FROM {table} t"):
        verdict = governed.check_sql(spark, sql)
        assert not verdict.ok and verdict.error == f"Column is not approved: {table}.internal_note."


@pytest.mark.parametrize(
    "sql",
    [
        "SELECT a.n FROM (SELECT internal_note AS n FROM customer_360) a",
        "SELECT customer_id FROM customer_360 WHERE internal_note > 1",
        "SELECT customer_id FROM customer_360 ORDER BY internal_note",
        "SELECT max(customer_id) FROM customer_360 GROUP BY internal_note",
        "SELECT max(customer_id) FROM customer_360 HAVING max(internal_note) > 1",
        "SELECT customer_id, rank() OVER (ORDER BY internal_note) FROM customer_360",
        "SELECT a.customer_id FROM customer_360 a JOIN customer_360 b ON a.customer_id = b.internal_note",
        "SELECT a.customer_id FROM customer_360 a JOIN inventory_health b USING (internal_note)",
        "SELECT customer_id FROM customer_360 NATURAL JOIN inventory_health",
        "SELECT customer_id FROM customer_360 WHERE customer_id IN (SELECT internal_note FROM inventory_health)",
        "SELECT customer_id FROM customer_360 c WHERE EXISTS (SELECT 1 FROM inventory_health i WHERE i.product_id = c.internal_note)",
        "SELECT (SELECT max(internal_note) FROM inventory_health) FROM customer_360",
        "WITH q AS (SELECT * FROM customer_360) SELECT customer_id FROM q",
        "WITH q AS (TABLE customer_360) SELECT customer_id FROM q",
        "TABLE customer_360 UNION ALL TABLE customer_360",
        "SELECT customer_id FROM customer_360 UNION SELECT internal_note FROM inventory_health",
        "SELECT product_id FROM (SELECT product_id, internal_note FROM inventory_health) customer_360",
    ],
)
def test_other_columns_are_found_wherever_they_hide(spark, wide, sql):
    verdict = governed.check_sql(spark, sql)
    assert not verdict.ok and "internal_note" in verdict.error
    with pytest.raises(ValueError, match="internal_note"):
        governed.run_approved(spark, sql, wide)


@pytest.mark.parametrize(
    "sql, rows",
    [
        ("SELECT count(*) AS n FROM customer_360", 1),
        ("SELECT * EXCEPT (internal_note) FROM customer_360", 4),
        ("SELECT customer_id AS internal_note FROM customer_360 ORDER BY internal_note", 4),
        ("WITH q AS (SELECT customer_id AS internal_note FROM customer_360) SELECT * FROM q", 4),
        ("SELECT a.customer_id FROM customer_360 a JOIN customer_360 b ON a.customer_id = b.customer_id", 4),
        ("SELECT n.k FROM (SELECT customer_id + 1 AS k FROM customer_360) n WHERE k > (SELECT min(product_id) FROM inventory_health)", 4),
    ],
)
def test_approved_columns_pass_under_any_name(spark, wide, sql, rows):
    assert governed.run_approved(spark, sql).count() == rows


def test_columns_of_stored_files_and_narrower_lists(spark, wide, folder):
    wide["inventory_health"].write.parquet(f"{folder}/t")
    spark.read.parquet(f"{folder}/t").createOrReplaceTempView("inventory_health")
    assert not governed.check_sql(spark, "SELECT _metadata.file_path FROM inventory_health").ok
    narrow = {"inventory_health": ["product_id"]}
    assert governed.check_sql(spark, "SELECT product_id FROM inventory_health", allowed=narrow).ok
    verdict = governed.check_sql(spark, "SELECT product_id FROM inventory_health WHERE stock_quantity > 0", allowed=narrow)
    assert verdict.error == "Column is not approved: inventory_health.stock_quantity."
    assert governed.check_sql(spark, "SELECT customer_id FROM customer_360", allowed=narrow).error == "Table is not approved: customer_360."


def test_a_view_replaced_after_the_check_is_judged_again(spark, wide, monkeypatch):
    sql = "SELECT customer_id FROM customer_360"
    passed = governed.check_sql(spark, sql)
    other = spark.range(3).selectExpr("id AS customer_id").where("customer_id > 0")
    other.createOrReplaceTempView("staff")
    monkeypatch.setattr(governed, "check_sql", lambda *_: governed.Verdict(True, "SELECT customer_id FROM staff"))
    assert passed.ok
    with pytest.raises(ValueError, match="staff"):
        governed.run_approved(spark, sql)
    spark.catalog.dropTempView("staff")
