"""Table contracts: raw sources, event payload, serving tables, and the fixed code lists."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

CORRUPT = "_corrupt_record"
FLAGS = "data_quality_flags"

# Accepted codes, which decide what is valid and what counts as revenue.
REVENUE_STATUSES = ("delivered", "shipped", "processing")
ORDER_STATUSES = ("delivered", "shipped", "processing", "cancelled", "returned")
PAYMENT_STATUSES = ("paid", "failed", "refunded")
SETTLED_PAYMENTS = ("paid", "refunded")
AT_RISK_STATUSES = ("out_of_stock", "low_stock")
EVENT_TYPES = (
    "product_view", "product_search", "add_to_cart", "remove_from_cart",
    "checkout_started", "purchase_completed", "payment_failed",
)
EVENT_TOPICS = ("customer-events", "order-events", "payment-events", "inventory-events")

# How far a settled payment may differ from its order, and the days counted as recent.
AMOUNT_TOLERANCE = 0.05
RECENT_DAYS = 30

# Stream timing.
WATERMARK = "10 minutes"
WINDOW = "5 minutes"
SLIDE = "1 minute"


_TYPES = {
    "STRING": T.StringType(),
    "INT": T.IntegerType(),
    "BIGINT": T.LongType(),
    "DOUBLE": T.DoubleType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampType(),
}


def struct(text: str) -> T.StructType:
    """``"id BIGINT NOT NULL, name STRING"`` as a schema; unlike ``fromDDL`` it needs no session."""
    fields = []
    for item in text.split(","):
        name, kind, *rest = item.split()
        fields.append(T.StructField(name, _TYPES[kind], nullable=not rest))
    return T.StructType(fields)


@dataclass(frozen=True)
class RawSource:
    """One headered CSV source, read as text only."""

    table: str
    columns: tuple[str, ...]
    source_system: str = "ecommerce_batch"

    @property
    def file_name(self) -> str:
        return f"{self.table}.csv"

    @property
    def schema(self) -> T.StructType:
        return T.StructType(
            [T.StructField(name, T.StringType()) for name in (*self.columns, CORRUPT)]
        )


# Raw column order per source.
_RAW = {
    "customers": "customer_id customer_name email phone city state country registration_date customer_segment",
    "categories": "category_id category_name department",
    "products": "product_id product_name category_id brand price cost_price rating created_at",
    "orders": "order_id customer_id order_date order_status shipping_city shipping_state payment_method order_total",
    "order_items": "order_item_id order_id product_id quantity unit_price discount item_total",
    "payments": "payment_id order_id payment_method payment_status payment_amount payment_timestamp",
    "inventory": "product_id warehouse_id stock_quantity reorder_level last_updated",
}
RAW_SOURCES = {table: RawSource(table, tuple(columns.split())) for table, columns in _RAW.items()}


def raw_source(table: str) -> RawSource:
    if table not in RAW_SOURCES:
        raise ValueError(f"Unknown source table {table!r}; known: {', '.join(sorted(RAW_SOURCES))}")
    return RAW_SOURCES[table]


EVENT_SCHEMA = struct(
    "event_id STRING, customer_id INT, session_id STRING, event_type STRING, product_id INT, "
    "category_id INT, quantity INT, price DOUBLE, city STRING, device_type STRING, event_timestamp STRING"
)
MESSAGE_SCHEMA = struct(
    "topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP, key STRING, value STRING"
)


@dataclass(frozen=True)
class ServingTable:
    """Column order and types of a serving table, with its key and text-length limits."""

    name: str
    schema: T.StructType
    key: tuple[str, ...]
    max_length: dict[str, int]

    @property
    def columns(self) -> list[str]:
        return self.schema.names

    @property
    def required(self) -> list[str]:
        return [field.name for field in self.schema if not field.nullable]


def _serving(name: str, ddl: str, key: str, **max_length: int) -> ServingTable:
    return ServingTable(name, struct(ddl), (key,), max_length)


# Serving columns in order, types, keys and text lengths.
SERVING_TABLES = {
    table.name: table
    for table in (
        _serving(
            "daily_sales_summary",
            "sales_date DATE NOT NULL, total_orders BIGINT NOT NULL, total_revenue DOUBLE NOT NULL, "
            "total_items_sold BIGINT NOT NULL, average_order_value DOUBLE NOT NULL, "
            "unique_customers BIGINT NOT NULL",
            "sales_date",
        ),
        _serving(
            "product_performance",
            "product_id BIGINT NOT NULL, product_name STRING NOT NULL, category_name STRING, "
            "units_sold BIGINT NOT NULL, gross_revenue DOUBLE NOT NULL, discount_amount DOUBLE NOT NULL, "
            "net_revenue DOUBLE NOT NULL, average_rating DOUBLE",
            "product_id", product_name=255, category_name=255,
        ),
        _serving(
            "category_performance",
            "category_id BIGINT NOT NULL, category_name STRING NOT NULL, total_orders BIGINT NOT NULL, "
            "units_sold BIGINT NOT NULL, revenue DOUBLE NOT NULL, average_order_value DOUBLE NOT NULL",
            "category_id", category_name=255,
        ),
        _serving(
            "customer_360",
            "customer_id BIGINT NOT NULL, customer_name STRING NOT NULL, total_orders BIGINT NOT NULL, "
            "lifetime_value DOUBLE NOT NULL, average_order_value DOUBLE NOT NULL, last_order_date DATE, "
            "days_since_last_order BIGINT, customer_segment STRING NOT NULL",
            "customer_id", customer_name=255, customer_segment=100,
        ),
        _serving(
            "inventory_health",
            "product_id BIGINT NOT NULL, product_name STRING NOT NULL, stock_quantity BIGINT NOT NULL, "
            "reorder_level BIGINT NOT NULL, inventory_status STRING NOT NULL, estimated_days_remaining DOUBLE",
            "product_id", product_name=255, inventory_status=50,
        ),
        _serving(
            "realtime_metrics",
            "window_start TIMESTAMP NOT NULL, window_end TIMESTAMP NOT NULL, revenue_per_window DOUBLE NOT NULL, "
            "orders_per_window BIGINT NOT NULL, active_users BIGINT NOT NULL, product_views BIGINT NOT NULL, "
            "payment_failures BIGINT NOT NULL, add_to_cart_events BIGINT NOT NULL, "
            "checkout_events BIGINT NOT NULL, payment_failure_rate DOUBLE NOT NULL, "
            "cart_abandonment_rate DOUBLE NOT NULL",
            "window_start",
        ),
    )
}
BATCH_GOLD = tuple(name for name in SERVING_TABLES if name != "realtime_metrics")


def serving_table(name: str) -> ServingTable:
    if name not in SERVING_TABLES:
        raise ValueError(f"Unknown serving table {name!r}; known: {', '.join(sorted(SERVING_TABLES))}")
    return SERVING_TABLES[name]
