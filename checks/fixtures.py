"""E-commerce inputs derived from the given tables, by the same expressions in Spark and in DuckDB.

``MAPPED`` tables are clean and typed; ``RAW`` tables are text with faults put in by rule. Every row of the
source table is used. ``{str}``, ``{ts}`` and ``{cat}`` stand for the few spellings that differ.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

AS_OF = "2001-08-01"

SPARK_WORDS = {"str": "STRING", "ts": "TIMESTAMP_NTZ", "cat": "CAST(conv(substring(md5(p_type), 1, 8), 16, 10) AS BIGINT)"}
DUCK_WORDS = {"str": "VARCHAR", "ts": "TIMESTAMP", "cat": "CAST('0x' || substr(md5(p_type), 1, 8) AS BIGINT)"}


def _money(expression: str) -> str:
    return f"CAST(CAST({expression} AS DECIMAL(18,2)) AS {{str}})"


def _text(expression: str) -> str:
    return f"CAST({expression} AS {{str}})"


def _loaded(day: str, batch: str, *identity: str) -> dict[str, str]:
    parts = ", '-', ".join(_text(i) for i in identity)
    return {
        "ingestion_timestamp": f"CAST(concat('2024-01-0', CAST(1 + {day} % 9 AS {{str}}), ' 00:00:00') AS {{ts}})",
        "batch_id": f"concat('batch-', CAST({batch} % 5 AS {{str}}))",
        "record_hash": f"md5(concat({parts}))",
    }


MAPPED: dict[str, tuple[str, dict[str, str]]] = {
    "products_m": ("part", {
        "product_id": "p_partkey",
        "product_name": "p_name",
        "category_id": "{cat}",
        "brand": "p_brand",
        "price": "p_retailprice",
        "cost_price": "p_retailprice * 0.5",
        "rating": "CAST(p_size % 11 AS DOUBLE) / 2.0",
        "created_at": "DATE '2020-01-01'",
    }),
    "customers_m": ("customer", {
        "customer_id": "c_custkey",
        "customer_name": "c_name",
        "email": "concat(lower(c_name), '@example.com')",
        "customer_segment": "lower(c_mktsegment)",
    }),
    "orders_m": ("orders", {
        "order_id": "o_orderkey",
        "customer_id": "o_custkey",
        "order_date": "CAST(o_orderdate AS DATE)",
        "order_status": "CASE WHEN o_orderkey % 25 = 0 THEN 'cancelled' WHEN o_orderkey % 25 = 1 THEN 'returned' "
                        "WHEN o_orderstatus = 'F' THEN 'delivered' WHEN o_orderstatus = 'O' THEN 'shipped' "
                        "ELSE 'processing' END",
        "payment_method": "lower(o_orderpriority)",
        "order_total": "o_totalprice",
    }),
    "order_items_m": ("lineitem", {
        "order_item_id": "l_orderkey * 10 + l_linenumber",
        "order_id": "l_orderkey",
        "product_id": "l_partkey",
        "quantity": "CAST(l_quantity AS BIGINT)",
        "unit_price": "l_extendedprice",
        "discount": "CAST(floor(l_extendedprice * l_discount) AS DOUBLE)",
        "item_total": "CAST(CAST(l_quantity AS DECIMAL(18,2)) * CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) "
                      "- CAST(floor(l_extendedprice * l_discount) AS DOUBLE)",
        "ingestion_timestamp": "l_shipdate",
        "batch_id": "CAST(l_suppkey AS {str})",
        "record_hash": "md5(concat(CAST(l_partkey AS {str}), '-', CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS {str})))",
    }),
    "payments_m": ("orders", {
        "payment_id": "o_orderkey",
        "order_id": "o_orderkey",
        "payment_status": "CASE WHEN o_orderkey % 25 = 0 THEN 'failed' WHEN o_orderkey % 25 = 1 THEN 'refunded' ELSE 'paid' END",
        "payment_amount": "CASE WHEN o_orderkey % 25 = 0 THEN 0.0 WHEN o_orderkey % 40 = 7 THEN o_totalprice + 1.0 ELSE o_totalprice END",
    }),
    "inventory_m": ("part", {
        "product_id": "p_partkey",
        "warehouse_id": "concat('WH-0', CAST(p_partkey % 8 + 1 AS {str}))",
        "stock_quantity": "CASE WHEN p_partkey % 50 = 0 THEN 0 ELSE (p_partkey * 37) % 500 END",
        "reorder_level": "15 + p_partkey % 66",
    }),
    "events_m": ("events", {
        "event_id": "CAST(event_id AS {str})",
        "customer_id": "user_id",
        "event_type": "CASE event_type WHEN 'view' THEN 'product_view' WHEN 'click' THEN 'add_to_cart' "
                      "WHEN 'purchase' THEN 'purchase_completed' WHEN 'error' THEN 'payment_failed' "
                      "ELSE 'checkout_started' END",
        "quantity": "CAST(1 + event_id % 4 AS BIGINT)",
        "price": "value",
        "event_timestamp": "ts",
    }),
}

RAW: dict[str, tuple[str, dict[str, str]]] = {
    # One row per part: the same six categories arrive again and again; one of them has no department.
    "raw_categories": ("part", {
        "category_id": _text("{cat}"),
        "category_name": "concat('  ', lower(p_type), '   goods ')",
        "department": "CASE WHEN p_type = 'PROMO' THEN '  ' ELSE 'general  store' END",
        **_loaded("p_partkey", "p_size", "p_partkey"),
    }),
    "raw_customers": ("customer", {
        "customer_id": "CASE WHEN c_custkey % 89 = 3 THEN 'abc' WHEN c_custkey % 97 = 5 THEN NULL "
                       "WHEN c_custkey % 40 = 1 THEN CAST(c_custkey - 1 AS {str}) ELSE CAST(c_custkey AS {str}) END",
        "customer_name": "CASE WHEN c_custkey % 83 = 7 THEN '  ' ELSE concat('  ', lower(c_name), '  x ') END",
        "email": "CASE WHEN c_custkey % 79 = 11 THEN NULL ELSE concat(' ', upper(c_name), '@EXAMPLE.COM ') END",
        "phone": "concat(' +91', CAST(7000000000 + c_custkey AS {str}), ' ')",
        "city": "concat(' new   city ', CAST(c_nationkey AS {str}))",
        "state": "concat('state  of ', CAST(c_nationkey AS {str}))",
        "country": "CASE WHEN c_custkey % 17 = 2 THEN NULL ELSE 'iNDIA' END",
        "registration_date": "CASE WHEN c_custkey % 73 = 13 THEN '2020-13-45' ELSE '2020-01-01' END",
        "customer_segment": "CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE concat(' ', c_mktsegment) END",
        **_loaded("c_custkey", "c_nationkey", "c_custkey"),
    }),
    "raw_products": ("part", {
        "product_id": "CASE WHEN p_partkey % 40 = 1 THEN CAST(p_partkey - 1 AS {str}) ELSE CAST(p_partkey AS {str}) END",
        "product_name": "CASE WHEN p_partkey % 83 = 4 THEN NULL ELSE concat(p_name, '  ', p_brand) END",
        "category_id": "CASE WHEN p_partkey % 71 = 9 THEN '17' WHEN p_partkey % 79 = 8 THEN NULL ELSE CAST({cat} AS {str}) END",
        "brand": "lower(p_brand)",
        "price": f"CASE WHEN p_partkey % 61 = 3 THEN '-1' ELSE {_money('p_retailprice')} END",
        "cost_price": f"CASE WHEN p_partkey % 59 = 2 THEN 'free' ELSE {_money('p_retailprice')} END",
        "rating": "CASE WHEN p_partkey % 67 = 5 THEN '7' ELSE CAST(p_size % 6 AS {str}) END",
        "created_at": "CASE WHEN p_partkey % 73 = 6 THEN 'yesterday' ELSE '2021-06-30' END",
        **_loaded("p_partkey", "p_size", "p_partkey"),
    }),
    "raw_orders": ("orders", {
        "order_id": "CASE WHEN o_orderkey % 83 = 5 THEN '' WHEN o_orderkey % 40 = 1 THEN CAST(o_orderkey - 1 AS {str}) ELSE CAST(o_orderkey AS {str}) END",
        "customer_id": "CASE WHEN o_orderkey % 47 = 6 THEN '99999999999' ELSE CAST(o_custkey AS {str}) END",
        "order_date": "CASE WHEN o_orderkey % 61 = 2 THEN 'soon' ELSE CAST(CAST(o_orderdate AS DATE) AS {str}) END",
        "order_status": "CASE WHEN o_orderkey % 53 = 4 THEN ' On   Hold ' WHEN o_orderkey % 59 = 8 THEN NULL "
                        "WHEN o_orderkey % 25 = 0 THEN 'Cancelled' WHEN o_orderkey % 25 = 1 THEN 'RETURNED ' ELSE ' Delivered' END",
        "shipping_city": "concat('port  ', CAST(o_custkey % 7 AS {str}))",
        "shipping_state": "'far  away'",
        "payment_method": "concat(' ', o_orderpriority)",
        "order_total": f"CASE WHEN o_orderkey % 67 = 3 THEN '-5' WHEN o_orderkey % 71 = 3 THEN '1,5' ELSE {_money('o_totalprice')} END",
        **_loaded("o_orderkey", "o_custkey", "o_orderkey"),
    }),
    "raw_order_items": ("lineitem", {
        "order_item_id": "CAST(l_orderkey * 10 + l_linenumber AS {str})",
        "order_id": "CASE WHEN (l_orderkey + l_linenumber) % 47 = 9 THEN '99999999999' ELSE CAST(l_orderkey AS {str}) END",
        "product_id": "CASE WHEN (l_orderkey + l_linenumber) % 53 = 9 THEN 'none' ELSE CAST(l_partkey AS {str}) END",
        "quantity": "CASE WHEN (l_orderkey + l_linenumber) % 41 = 3 THEN '0' WHEN (l_orderkey + l_linenumber) % 43 = 5 THEN 'x' "
                    "ELSE CAST(CAST(l_quantity AS BIGINT) AS {str}) END",
        "unit_price": _money("l_extendedprice"),
        "discount": "CASE WHEN (l_orderkey + l_linenumber) % 37 = 7 THEN '-1' ELSE CAST(CAST(floor(l_extendedprice * l_discount) AS BIGINT) AS {str}) END",
        "item_total": "CAST(CAST(CAST(l_quantity AS BIGINT) * CAST(l_extendedprice AS DECIMAL(18,2)) AS DECIMAL(18,2)) AS {str})",
        "ingestion_timestamp": "l_shipdate",
        "batch_id": "CAST(l_suppkey AS {str})",
        "record_hash": f"md5(concat(CAST(l_partkey AS {{str}}), '-', {_money('l_extendedprice')}))",
    }),
    "raw_payments": ("orders", {
        "payment_id": "CASE WHEN o_orderkey % 97 = 4 THEN NULL WHEN o_orderkey % 40 = 1 THEN CAST(o_orderkey - 1 AS {str}) ELSE CAST(o_orderkey AS {str}) END",
        "order_id": "CASE WHEN o_orderkey % 89 = 6 THEN NULL ELSE CAST(o_orderkey AS {str}) END",
        "payment_method": "concat(o_orderpriority, ' ')",
        "payment_status": "CASE WHEN o_orderkey % 53 = 7 THEN 'weird' WHEN o_orderkey % 59 = 9 THEN NULL "
                          "WHEN o_orderkey % 25 = 0 THEN ' Failed' WHEN o_orderkey % 25 = 1 THEN 'REFUNDED' ELSE 'Paid ' END",
        "payment_amount": f"CASE WHEN o_orderkey % 61 = 5 THEN '-1' WHEN o_orderkey % 43 = 7 THEN {_money('o_totalprice + 1.0')} ELSE {_money('o_totalprice')} END",
        "payment_timestamp": "CASE WHEN o_orderkey % 73 = 3 THEN 'later' ELSE concat(CAST(CAST(o_orderdate AS DATE) AS {str}), ' 10:30:00') END",
        **_loaded("o_orderkey", "o_custkey", "o_orderkey"),
    }),
    "raw_inventory": ("part", {
        "product_id": "CAST(p_partkey AS {str})",
        "warehouse_id": "CASE WHEN p_partkey % 61 = 3 THEN ' ' ELSE concat(' wh-0', CAST(p_partkey % 8 + 1 AS {str}), ' ') END",
        "stock_quantity": "CASE WHEN p_partkey % 59 = 3 THEN '-4' ELSE CAST((p_partkey * 37) % 500 AS {str}) END",
        "reorder_level": "CASE WHEN p_partkey % 67 = 3 THEN NULL ELSE CAST(15 + p_partkey % 66 AS {str}) END",
        "last_updated": "CASE WHEN p_partkey % 71 = 3 THEN '' ELSE '2024-03-01 08:00:00' END",
        **_loaded("p_partkey", "p_size", "p_partkey"),
    }),
}

# Event messages, one row per message. Each fiftieth event is sent twice.
_JSON_EVENT = (
    "concat('{{\"event_id\":\"', CAST(event_id AS {str}), '\",\"customer_id\":', "
    "CASE WHEN event_id % 71 = 2 THEN 'null' ELSE CAST(user_id AS {str}) END, "
    "',\"session_id\":\"s-', CAST(user_id % 50 AS {str}), '\",\"event_type\":\"', "
    "CASE WHEN event_id % 97 = 5 THEN 'mystery' WHEN event_id % 73 = 13 THEN '  PRODUCT_VIEW ' "
    "WHEN event_type = 'view' THEN 'product_view' WHEN event_type = 'click' THEN 'add_to_cart' "
    "WHEN event_type = 'purchase' THEN 'purchase_completed' WHEN event_type = 'error' THEN 'payment_failed' "
    "ELSE 'checkout_started' END, "
    "'\",\"product_id\":', CAST(event_id % 200 AS {str}), ',\"category_id\":', CAST(event_id % 6 AS {str}), "
    "',\"quantity\":', CASE WHEN event_id % 89 = 7 THEN '0' ELSE CAST(1 + event_id % 4 AS {str}) END, "
    "',\"price\":', CASE WHEN event_id % 83 = 9 THEN '-1' WHEN event_id % 79 = 11 THEN 'null' "
    "ELSE CAST(CAST(value AS DECIMAL(18,2)) AS {str}) END, "
    "',\"city\":\" new delhi \",\"device_type\":\" Mobile\",\"event_timestamp\":\"', "
    "CAST(date_trunc('second', ts) AS {str}), '\"}}')"
)
MESSAGES = {
    "topic": "CASE event_type WHEN 'purchase' THEN 'order-events' WHEN 'error' THEN 'payment-events' ELSE 'customer-events' END",
    "partition": "CAST(event_id % 3 AS INT)",
    "offset": "event_id * 10 + copy",
    "timestamp": "date_trunc('second', ts)",
    "key": "CAST(user_id AS {str})",
    "value": f"CASE WHEN event_id % 101 = 3 THEN 'garbage' ELSE {_JSON_EVENT} END",
}


def _render(expressions: dict[str, str], words: dict[str, str], quote: str) -> list[str]:
    return [f"{e.format(**words)} AS {quote}{name}{quote}" for name, e in expressions.items()]


class Inputs:
    """Spark frames of the given and derived tables for one scale folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def given(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def __getitem__(self, name: str) -> DataFrame:
        if name == "categories_m":
            return self.given("part").selectExpr(
                *_render({"category_id": "{cat}", "category_name": "p_type"}, SPARK_WORDS, "`")
            ).distinct()
        if name == "messages":
            copies = "explode(sequence(1, CASE WHEN event_id % 50 = 0 THEN 2 ELSE 1 END)) AS copy"
            twice = self.given("events").selectExpr("*", copies)
            return twice.selectExpr(*_render(MESSAGES, SPARK_WORDS, "`"))
        source, expressions = (MAPPED | RAW)[name]
        return self.given(source).selectExpr(*_render(expressions, SPARK_WORDS, "`"))

    def raw_tables(self) -> dict[str, DataFrame]:
        return {name.removeprefix("raw_"): self[name] for name in RAW}

    def silver(self) -> dict[str, DataFrame]:
        """Clean mapped tables under their Silver names."""
        names = ("categories", "customers", "products", "orders", "order_items", "inventory")
        return {name: self[f"{name}_m"] for name in names}


def duck_views() -> dict[str, str]:
    """The same tables as DuckDB queries."""
    views = {
        name: f"SELECT {', '.join(_render(expressions, DUCK_WORDS, chr(34)))} FROM {source}"
        for name, (source, expressions) in (MAPPED | RAW).items()
    }
    views["categories_m"] = f"SELECT DISTINCT {DUCK_WORDS['cat']} AS category_id, p_type AS category_name FROM part"
    views["messages"] = (
        f"SELECT {', '.join(_render(MESSAGES, DUCK_WORDS, chr(34)))} FROM (SELECT *, "
        "unnest(generate_series(1, CASE WHEN event_id % 50 = 0 THEN 2 ELSE 1 END)) AS copy FROM events)"
    )
    return views
