"""Bronze and Silver: metadata, types, rules, foreign keys, newest row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.fixtures import Inputs
from checks.registry import check, view
from sluicebox.contracts import CORRUPT, FLAGS, ORDER_STATUSES, PAYMENT_STATUSES, raw_source
from sluicebox.functions import dates, hashing, numbers, text
from sluicebox.operators.keys import fk_orphans, latest_per_key, newest_order, with_parent
from sluicebox.operators.quality import Rule, flag_report, split_by_flags, with_flags
from sluicebox.plans import bronze, silver
from sluicebox.sources.storage import Staging, fresh_folder

# ---- DuckDB side: the seven tables, written out as SQL ----------------------------------------------------


def title(x: str) -> str:
    return f"array_to_string(list_transform(string_split(lower({x}), ' '), lambda w: upper(w[1]) || w[2:]), ' ')"


def tidy(x: str) -> str:
    return title(rf"regexp_replace(trim({x}), '\s+', ' ', 'g')")


def _long(x: str) -> str:
    return f"TRY_CAST({x} AS BIGINT)"


def _double(x: str) -> str:
    return f"TRY_CAST({x} AS DOUBLE)"


def _date(x: str) -> str:
    return f"TRY_CAST({x} AS DATE)"


def _time(x: str) -> str:
    return f"TRY_CAST({x} AS TIMESTAMP)"


def _lower(x: str) -> str:
    return f"lower(trim({x}))"


def _in(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


TYPES: dict[str, dict[str, str]] = {
    "categories": {
        "category_id": _long("category_id"),
        "category_name": tidy("category_name"),
        "department": tidy("department"),
    },
    "customers": {
        "customer_id": _long("customer_id"),
        "customer_name": tidy("customer_name"),
        "email": _lower("email"),
        "phone": "trim(phone)",
        "city": tidy("city"),
        "state": tidy("state"),
        "country": tidy("country"),
        "registration_date": _date("registration_date"),
        "customer_segment": f"coalesce({_lower('customer_segment')}, 'unknown')",
    },
    "products": {
        "product_id": _long("product_id"),
        "product_name": tidy("product_name"),
        "category_id": _long("category_id"),
        "brand": tidy("brand"),
        "price": _double("price"),
        "cost_price": _double("cost_price"),
        "rating": _double("rating"),
        "created_at": _date("created_at"),
    },
    "orders": {
        "order_id": _long("order_id"),
        "customer_id": _long("customer_id"),
        "order_date": _date("order_date"),
        "order_status": r"lower(regexp_replace(trim(order_status), '\s+', '_', 'g'))",
        "shipping_city": tidy("shipping_city"),
        "shipping_state": tidy("shipping_state"),
        "payment_method": _lower("payment_method"),
        "order_total": _double("order_total"),
    },
    "order_items": {
        "order_item_id": _long("order_item_id"),
        "order_id": _long("order_id"),
        "product_id": _long("product_id"),
        "quantity": _long("quantity"),
        "unit_price": _double("unit_price"),
        "discount": _double("discount"),
        "item_total": _double("item_total"),
    },
    "payments": {
        "payment_id": _long("payment_id"),
        "order_id": _long("order_id"),
        "payment_method": _lower("payment_method"),
        "payment_status": _lower("payment_status"),
        "payment_amount": _double("payment_amount"),
        "payment_timestamp": _time("payment_timestamp"),
    },
    "inventory": {
        "product_id": _long("product_id"),
        "warehouse_id": "upper(trim(warehouse_id))",
        "stock_quantity": _long("stock_quantity"),
        "reorder_level": _long("reorder_level"),
        "last_updated": _time("last_updated"),
    },
}
KEYS = {
    "categories": "category_id", "customers": "customer_id", "products": "product_id", "orders": "order_id",
    "order_items": "order_item_id", "payments": "payment_id", "inventory": "product_id, warehouse_id",
}
BLANK = "coalesce(trim({0}), '') = ''"


def _orphan(child: str, key: str, parent: str) -> str:
    return f"{child}.{key} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM valid_{parent} p WHERE p.{key} = {child}.{key})"


FLAG_SQL: dict[str, dict[str, str]] = {
    "categories": {
        "missing_category_id": "category_id IS NULL",
        "missing_category_name": BLANK.format("category_name"),
        "missing_department": BLANK.format("department"),
    },
    "customers": {
        "missing_customer_id": "customer_id IS NULL",
        "missing_customer_name": BLANK.format("customer_name"),
        "missing_email": BLANK.format("email"),
        "invalid_registration_date": "registration_date IS NULL",
    },
    "products": {
        "missing_product_id": "product_id IS NULL",
        "missing_product_name": BLANK.format("product_name"),
        "missing_category_id": "category_id IS NULL",
        "invalid_price": "coalesce(price <= 0, true)",
        "invalid_cost_price": "coalesce(cost_price < 0, true)",
        "invalid_rating": "coalesce(rating < 0 OR rating > 5, true)",
        "invalid_created_at": "created_at IS NULL",
        "missing_category_fk": _orphan("typed_products", "category_id", "categories"),
    },
    "orders": {
        "missing_order_id": "order_id IS NULL",
        "missing_customer_id": "customer_id IS NULL",
        "invalid_order_date": "order_date IS NULL",
        "invalid_order_status": f"order_status NOT IN ({_in(ORDER_STATUSES)})",
        "invalid_order_total": "coalesce(order_total < 0, true)",
        "missing_customer_fk": _orphan("typed_orders", "customer_id", "customers"),
    },
    "order_items": {
        "missing_order_item_id": "order_item_id IS NULL",
        "missing_order_id": "order_id IS NULL",
        "missing_product_id": "product_id IS NULL",
        "invalid_quantity": "coalesce(quantity <= 0, true)",
        "invalid_unit_price": "coalesce(unit_price <= 0, true)",
        "invalid_discount": "coalesce(discount < 0, true)",
        "invalid_item_total": "coalesce(item_total < 0, true)",
        "missing_order_fk": _orphan("typed_order_items", "order_id", "orders"),
        "missing_product_fk": _orphan("typed_order_items", "product_id", "products"),
    },
    "payments": {
        "missing_payment_id": "payment_id IS NULL",
        "missing_order_id": "order_id IS NULL",
        "invalid_payment_status": f"payment_status NOT IN ({_in(PAYMENT_STATUSES)})",
        "invalid_payment_amount": "coalesce(payment_amount < 0, true)",
        "invalid_payment_timestamp": "payment_timestamp IS NULL",
        "missing_order_fk": _orphan("typed_payments", "order_id", "orders"),
        "payment_amount_mismatch": "payment_status IN ('paid', 'refunded') AND abs(payment_amount - "
        "(SELECT max(o.order_total) FROM valid_orders o WHERE o.order_id = typed_payments.order_id)) > 0.05",
    },
    "inventory": {
        "missing_product_id": "product_id IS NULL",
        "missing_warehouse_id": BLANK.format("warehouse_id"),
        "invalid_stock_quantity": "coalesce(stock_quantity < 0, true)",
        "invalid_reorder_level": "coalesce(reorder_level < 0, true)",
        "invalid_last_updated": "last_updated IS NULL",
        "missing_product_fk": _orphan("typed_inventory", "product_id", "products"),
    },
}

for _table, _types in TYPES.items():
    _columns = ", ".join(f"{sql} AS {name}" for name, sql in _types.items())
    view(f"typed_{_table}", f"SELECT {_columns}, ingestion_timestamp, batch_id, record_hash FROM raw_{_table}")
    _flags = ", ".join(f"CASE WHEN {sql} THEN '{flag}' END" for flag, sql in FLAG_SQL[_table].items())
    view(
        f"flagged_{_table}",
        f"SELECT *, list_filter([{_flags}], lambda f: f IS NOT NULL) AS flags FROM typed_{_table}",
    )
    view(
        f"valid_{_table}",
        f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {KEYS[_table]} "
        "ORDER BY ingestion_timestamp DESC NULLS LAST, batch_id DESC NULLS LAST, record_hash DESC NULLS LAST) AS rn "
        f"FROM flagged_{_table} WHERE len(flags) = 0) WHERE rn = 1",
    )


def _names(table: str) -> str:
    return ", ".join(TYPES[table])


def _plain(df: DataFrame) -> DataFrame:
    """Comparable columns: zoneless times, flags as one text, no load or processing times."""
    times = [name for name, kind in df.dtypes if kind == "timestamp"]
    out = df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in times})
    if FLAGS in df.columns:
        out = out.withColumn("flags", F.array_join(FLAGS, ",")).drop(FLAGS)
    return out.drop("ingestion_timestamp", "silver_processed_timestamp")


def _keep(t: Inputs) -> silver.Keep:
    """Store intermediate tables in the shared folder, as a long chain on a cluster should."""
    return Staging(t.spark, fresh_folder(t.spark, "silver")).store


def _parents(t: Inputs, table: str) -> dict[str, DataFrame]:
    """Cleaned parents of one raw table."""
    needed = [name for name in silver.with_dependencies([table]) if name != table]
    cleaned = silver.clean_all({name: t[f"raw_{name}"] for name in needed}, _keep(t))
    return {name: part.valid for name, part in cleaned.items()}


# ---- one typed_, dq_ and clean_ check per table -----------------------------------------------------------


def _register(table: str) -> None:
    @check(f"typed_{table}", f"SELECT {_names(table)}, record_hash FROM typed_{table}")
    def typed(t: Inputs) -> DataFrame:
        return _plain(silver.typed(table, t[f"raw_{table}"])).drop("batch_id")

    @check(
        f"dq_{table}",
        f"SELECT {KEYS[table]}, record_hash, array_to_string(flags, ',') AS flags FROM flagged_{table}",
    )
    def rules(t: Inputs) -> DataFrame:
        rows = silver.flagged(table, t[f"raw_{table}"], _parents(t, table), silver.join_cleaned_parent)
        return _plain(rows).select(*KEYS[table].split(", "), "record_hash", "flags")

    both = f"{_names(table)}, batch_id, record_hash, array_to_string(flags, ',') AS flags"

    @check(
        f"clean_{table}",
        f"SELECT {both}, 'valid' AS verdict FROM valid_{table} UNION ALL "
        f"SELECT {both}, 'rejected' AS verdict FROM flagged_{table} WHERE len(flags) > 0",
    )
    def cleaned(t: Inputs) -> DataFrame:
        parents = _parents(t, table)
        valid, rejected = silver.clean(table, t[f"raw_{table}"], parents, silver.join_cleaned_parent, _keep(t))
        both = valid.withColumn("verdict", F.lit("valid")).unionByName(
            rejected.withColumn("verdict", F.lit("rejected"))
        )
        return _plain(both)


for _table in TYPES:
    _register(_table)


# ---- Bronze metadata and malformed lines ------------------------------------------------------------------

_RAW_CUSTOMER = ", ".join(f"coalesce({c}, '')" for c in raw_source("customers").columns)


@check(
    "bronze_metadata",
    f"SELECT customer_id, email, 'ecommerce_batch' AS source_system, 'customers.csv' AS source_file, "
    f"'run-1' AS batch_id, sha256(concat_ws('||', {_RAW_CUSTOMER})) AS record_hash FROM raw_customers",
)
def bronze_metadata(t: Inputs) -> DataFrame:
    source = raw_source("customers")
    rows = bronze.with_load_metadata(t["raw_customers"].select(*source.columns), source, "customers.csv", "run-1")
    return rows.select("customer_id", "email", "source_system", "source_file", "batch_id", "record_hash")


@check(
    "fn_record_hash",
    "SELECT order_id, sha256(concat_ws('||', coalesce(order_status, ''), coalesce(order_total, ''))) AS h FROM raw_orders",
)
def fn_record_hash(t: Inputs) -> DataFrame:
    return t["raw_orders"].select("order_id", hashing.record_hash(["order_status", "order_total"]).alias("h"))


@check(
    "split_malformed",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 4 THEN 'line ' || o_orderkey END AS corrupt, "
    "o_orderkey % 9 = 4 AS malformed FROM orders",
)
def split_malformed(t: Inputs) -> DataFrame:
    broken = F.when(F.col("o_orderkey") % 9 == 4, F.concat(F.lit("line "), F.col("o_orderkey").cast("string")))
    good, bad = bronze.split_malformed(t.given("orders").select("o_orderkey", broken.alias(CORRUPT)))
    return good.select("o_orderkey", F.lit(None).cast("string").alias("corrupt"), F.lit(False).alias("malformed")).union(
        bad.select("o_orderkey", CORRUPT, F.lit(True))
    )


# ---- rules ------------------------------------------------------------------------------------------------

_TWO_RULES = [Rule("no_segment", "customer_segment IS NULL"), Rule("no_email", "email IS NULL")]


@check("quality_init", "SELECT customer_id, 0 AS flag_count FROM raw_customers")
def quality_init(t: Inputs) -> DataFrame:
    return with_flags(t["raw_customers"], []).select("customer_id", F.size(FLAGS).alias("flag_count"))


@check(
    "quality_flag",
    "SELECT record_hash, concat_ws(',', CASE WHEN customer_segment IS NULL THEN 'no_segment' END, "
    "CASE WHEN email IS NULL THEN 'no_email' END) AS flags FROM raw_customers",
)
def quality_flag(t: Inputs) -> DataFrame:
    return with_flags(t["raw_customers"], _TWO_RULES).select("record_hash", F.array_join(FLAGS, ",").alias("flags"))


@check(
    "split_quality",
    "SELECT record_hash, customer_segment IS NULL OR email IS NULL AS rejected FROM raw_customers",
)
def split_quality(t: Inputs) -> DataFrame:
    valid, rejected = split_by_flags(with_flags(t["raw_customers"], _TWO_RULES))
    return valid.select("record_hash", F.lit(False).alias("rejected")).union(
        rejected.select("record_hash", F.lit(True))
    )


@check(
    "fn_array_flags",
    "SELECT record_hash, CAST((customer_segment IS NULL)::INT + (email IS NULL)::INT AS INTEGER) AS flag_count "
    "FROM raw_customers",
)
def fn_array_flags(t: Inputs) -> DataFrame:
    return with_flags(t["raw_customers"], _TWO_RULES).select("record_hash", F.size(FLAGS).alias("flag_count"))


@check("is_blank", "SELECT record_hash, coalesce(trim(customer_name), '') = '' AS blank FROM raw_customers")
def is_blank(t: Inputs) -> DataFrame:
    return t["raw_customers"].select("record_hash", text.is_blank("customer_name").alias("blank"))


@check(
    "dq_payment_mismatch",
    "SELECT payment_id, payment_amount, order_total FROM payments_m JOIN orders_m USING (order_id) "
    "WHERE payment_status IN ('paid', 'refunded') AND abs(payment_amount - order_total) > 0.05",
)
def dq_payment_mismatch(t: Inputs) -> DataFrame:
    rows = with_parent(
        t["payments_m"], t["orders_m"], "order_id", "order_id", "_missing", {"order_total": "order_total"}, unique_parent=True
    )
    rule = silver.amount_mismatch("payment_amount", "order_total")
    return rows.filter(rule.broken).select("payment_id", "payment_amount", "order_total")


@check(
    "dq_report",
    " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, flag, COUNT(*) AS rejected_rows "
        f"FROM (SELECT unnest(flags) AS flag FROM flagged_{table}) GROUP BY flag"
        for table in TYPES
    ),
)
def dq_report(t: Inputs) -> DataFrame:
    return flag_report(silver.rejected_flags(t.raw_tables(), _keep(t)))


# ---- keys -------------------------------------------------------------------------------------------------


@check(
    "fk_flag",
    "SELECT record_hash, customer_id, customer_id IS NOT NULL AND NOT EXISTS "
    "(SELECT 1 FROM customers_m c WHERE c.customer_id = o.customer_id) AS missing_customer_fk FROM typed_orders o",
)
def fk_flag(t: Inputs) -> DataFrame:
    typed = silver.typed("orders", t["raw_orders"])
    marked = with_parent(
        typed, t["customers_m"], "customer_id", "customer_id", "missing_customer_fk", unique_parent=True
    )
    return marked.select("record_hash", "customer_id", "missing_customer_fk")


@check(
    "fk_orphans",
    "SELECT record_hash, customer_id FROM typed_orders o WHERE customer_id IS NOT NULL AND "
    "customer_id NOT IN (SELECT customer_id FROM customers_m)",
)
def orphans(t: Inputs) -> DataFrame:
    typed = silver.typed("orders", t["raw_orders"])
    return fk_orphans(typed, t["customers_m"], "customer_id", "customer_id").select("record_hash", "customer_id")


@check(
    "dedup_latest",
    "SELECT order_item_id, product_id, quantity, batch_id FROM (SELECT *, row_number() OVER (PARTITION BY order_item_id "
    "ORDER BY ingestion_timestamp DESC NULLS LAST, batch_id DESC NULLS LAST, record_hash DESC NULLS LAST) AS rn "
    "FROM order_items_m) WHERE rn = 1",
)
def dedup_latest(t: Inputs) -> DataFrame:
    items = t["order_items_m"]
    newest = latest_per_key(items, ["order_item_id"], newest_order(items))
    return newest.select("order_item_id", "product_id", "quantity", "batch_id")


# ---- scalar functions -------------------------------------------------------------------------------------


def _scalar(name: str, table: str, key: str, column, sql: str) -> None:
    @check(name, f"SELECT {key}, {sql} AS result FROM {table}")
    def scalar(t: Inputs) -> DataFrame:
        return t[table].select(key, column().alias("result"))


_scalar("fn_normalize_name", "raw_customers", "record_hash", lambda: text.tidy_name("customer_name"), tidy("customer_name"))
_scalar("fn_lower_trim", "raw_payments", "record_hash", lambda: text.lowered("payment_status"), "lower(trim(payment_status))")
_scalar("fn_upper_trim", "raw_inventory", "record_hash", lambda: text.uppered("warehouse_id"), "upper(trim(warehouse_id))")
_scalar("fn_trim", "raw_customers", "record_hash", lambda: text.trimmed("phone"), "trim(phone)")
_scalar("fn_initcap_trim", "raw_customers", "record_hash", lambda: text.titled("city"), title("trim(city)"))
_scalar("fn_snake_status", "raw_orders", "record_hash", lambda: text.snake_code("order_status"), TYPES["orders"]["order_status"])
_scalar(
    "fn_default_unknown", "raw_customers", "record_hash",
    lambda: text.or_unknown(F.col("customer_segment")), "coalesce(customer_segment, 'unknown')",
)
_scalar("fn_to_date", "raw_orders", "record_hash", lambda: dates.to_date("order_date"), _date("order_date"))
_scalar(
    "fn_to_timestamp", "raw_payments", "record_hash",
    lambda: dates.to_timestamp("payment_timestamp").cast("timestamp_ntz"), _time("payment_timestamp"),
)


@check(
    "fn_safe_cast",
    "SELECT record_hash, TRY_CAST(quantity AS BIGINT) AS whole, TRY_CAST(discount AS DOUBLE) AS fraction FROM raw_order_items",
)
def fn_safe_cast(t: Inputs) -> DataFrame:
    return t["raw_order_items"].select(
        "record_hash", numbers.to_long("quantity").alias("whole"), numbers.to_double("discount").alias("fraction")
    )
