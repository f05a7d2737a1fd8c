"""Silver: typed rows checked by rule tables and against cleaned parents; one row per key."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicebox.contracts import (
    AMOUNT_TOLERANCE,
    FLAGS,
    ORDER_STATUSES,
    PAYMENT_STATUSES,
    SETTLED_PAYMENTS,
    raw_source,
)
from sluicebox.functions.dates import to_date, to_timestamp
from sluicebox.functions.numbers import to_double, to_long
from sluicebox.functions.text import is_blank, lowered, or_unknown, snake_code, tidy_name, trimmed, uppered
from sluicebox.operators.keys import latest_per_key, latest_per_key_of_stored, newest_order, orphan_keys, with_parent, with_stored_orphans
from sluicebox.operators.quality import Rule, collect_flags, has_flags, split_by_flags, with_flags
from sluicebox.plans.bronze import LoadCounts
from sluicebox.sources.snapshots import Snapshots
from sluicebox.sources.storage import DEFAULT_FORMAT, read_table, staging, write_counted


@dataclass(frozen=True)
class Parent:
    """A foreign key, by the same column name on both sides, and parent columns the rules need."""

    table: str
    key: str
    carry: tuple[str, ...] = ()

    @property
    def missing(self) -> str:
        return f"_no_{self.table}"

    def rule(self, flag: str) -> Rule:
        return Rule(flag, self.missing, of_parent=True)

    def carried(self) -> dict[str, str]:
        return {name: f"_{self.table}_{name}" for name in self.carry}


@dataclass(frozen=True)
class Cleaning:
    """How one table is typed, checked and keyed; ``file_order`` sorts its stored files for range filters."""

    key: tuple[str, ...]
    types: dict[str, Column]
    rules: list[Rule]
    parents: list[Parent] = field(default_factory=list)
    file_order: tuple[str, ...] = ()


class Cleaned(NamedTuple):
    valid: DataFrame
    rejected: DataFrame


def _each(convert: Callable[[str], Column], *names: str) -> dict[str, Column]:
    return {name: convert(name) for name in names}


def _absent(name: str, flag: str | None = None) -> Rule:
    return Rule(flag or f"missing_{name}", f"{name} IS NULL")


def _blank(name: str) -> Rule:
    return Rule(f"missing_{name}", is_blank(name))


def _bad(name: str, broken: str = "") -> Rule:
    """Invalid when NULL or when the given comparison holds, as in ``_bad('price', '<= 0')``."""
    return Rule(f"invalid_{name}", f"{name} IS NULL OR {name} {broken}" if broken else f"{name} IS NULL")


def _not_in(name: str, allowed: Iterable[str]) -> Rule:
    """Unknown codes are invalid; a NULL code makes the predicate NULL, so it is not marked."""
    return Rule(f"invalid_{name}", ~F.col(name).isin(*allowed))


def _customers() -> Cleaning:
    return Cleaning(
        key=("customer_id",),
        types={
            **_each(to_long, "customer_id"),
            **_each(tidy_name, "customer_name", "city", "state", "country"),
            **_each(lowered, "email"),
            **_each(trimmed, "phone"),
            **_each(to_date, "registration_date"),
            "customer_segment": or_unknown(lowered("customer_segment")),
        },
        rules=[_absent("customer_id"), _blank("customer_name"), _blank("email"), _bad("registration_date")],
    )


def _categories() -> Cleaning:
    return Cleaning(
        key=("category_id",),
        types={**_each(to_long, "category_id"), **_each(tidy_name, "category_name", "department")},
        rules=[_absent("category_id"), _blank("category_name"), _blank("department")],
    )


def _products() -> Cleaning:
    category = Parent("categories", "category_id")
    return Cleaning(
        key=("product_id",),
        types={
            **_each(to_long, "product_id", "category_id"),
            **_each(tidy_name, "product_name", "brand"),
            **_each(to_double, "price", "cost_price", "rating"),
            **_each(to_date, "created_at"),
        },
        rules=[
            _absent("product_id"),
            _blank("product_name"),
            _absent("category_id"),
            _bad("price", "<= 0"),
            _bad("cost_price", "< 0"),
            _bad("rating", "NOT BETWEEN 0 AND 5"),
            _bad("created_at"),
            category.rule("missing_category_fk"),
        ],
        parents=[category],
    )


def _orders() -> Cleaning:
    customer = Parent("customers", "customer_id")
    return Cleaning(
        key=("order_id",),
        types={
            **_each(to_long, "order_id", "customer_id"),
            **_each(to_date, "order_date"),
            **_each(snake_code, "order_status"),
            **_each(tidy_name, "shipping_city", "shipping_state"),
            **_each(lowered, "payment_method"),
            **_each(to_double, "order_total"),
        },
        rules=[
            _absent("order_id"),
            _absent("customer_id"),
            _bad("order_date"),
            _not_in("order_status", ORDER_STATUSES),
            _bad("order_total", "< 0"),
            customer.rule("missing_customer_fk"),
        ],
        parents=[customer],
        file_order=("order_date",),
    )


def _order_items() -> Cleaning:
    order, product = Parent("orders", "order_id"), Parent("products", "product_id")
    return Cleaning(
        key=("order_item_id",),
        types={
            **_each(to_long, "order_item_id", "order_id", "product_id", "quantity"),
            **_each(to_double, "unit_price", "discount", "item_total"),
        },
        rules=[
            _absent("order_item_id"),
            _absent("order_id"),
            _absent("product_id"),
            _bad("quantity", "<= 0"),
            _bad("unit_price", "<= 0"),
            _bad("discount", "< 0"),
            _bad("item_total", "< 0"),
            order.rule("missing_order_fk"),
            product.rule("missing_product_fk"),
        ],
        parents=[order, product],
    )


def amount_mismatch(amount: str, expected: str) -> Rule:
    """A settled payment that differs from its order's total by more than the tolerance."""
    settled = F.col("payment_status").isin(*SETTLED_PAYMENTS)
    differs = F.abs(F.col(amount) - F.col(expected)) > AMOUNT_TOLERANCE
    return Rule("payment_amount_mismatch", settled & F.col(expected).isNotNull() & differs, of_parent=True)


def _payments() -> Cleaning:
    order = Parent("orders", "order_id", carry=("order_total",))
    return Cleaning(
        key=("payment_id",),
        types={
            **_each(to_long, "payment_id", "order_id"),
            **_each(lowered, "payment_method", "payment_status"),
            **_each(to_double, "payment_amount"),
            **_each(to_timestamp, "payment_timestamp"),
        },
        rules=[
            _absent("payment_id"),
            _absent("order_id"),
            _not_in("payment_status", PAYMENT_STATUSES),
            _bad("payment_amount", "< 0"),
            _bad("payment_timestamp"),
            order.rule("missing_order_fk"),
            amount_mismatch("payment_amount", order.carried()["order_total"]),
        ],
        parents=[order],
    )


def _inventory() -> Cleaning:
    product = Parent("products", "product_id")
    return Cleaning(
        key=("product_id", "warehouse_id"),
        types={
            **_each(to_long, "product_id", "stock_quantity", "reorder_level"),
            **_each(uppered, "warehouse_id"),
            **_each(to_timestamp, "last_updated"),
        },
        rules=[
            _absent("product_id"),
            _blank("warehouse_id"),
            _bad("stock_quantity", "< 0"),
            _bad("reorder_level", "< 0"),
            _bad("last_updated"),
            product.rule("missing_product_fk"),
        ],
        parents=[product],
    )


# Parents come before their children.
CLEANINGS: dict[str, Callable[[], Cleaning]] = {
    "categories": _categories,
    "customers": _customers,
    "products": _products,
    "orders": _orders,
    "order_items": _order_items,
    "payments": _payments,
    "inventory": _inventory,
}

AttachParent = Callable[[DataFrame, DataFrame, Parent], DataFrame]
Keep = Callable[[DataFrame, str], DataFrame]


def join_parent(child: DataFrame, parent: DataFrame, link: Parent) -> DataFrame:
    """For any parent, also one that lists a key twice."""
    return with_parent(child, parent, link.key, link.key, link.missing, link.carried())


def join_cleaned_parent(child: DataFrame, parent: DataFrame, link: Parent) -> DataFrame:
    """For cleaned parents, which have one row per key."""
    return with_parent(child, parent, link.key, link.key, link.missing, link.carried(), unique_parent=True)


def by_orphans(keep: Keep, table: str, attach: AttachParent = join_cleaned_parent) -> AttachParent:
    """Keys without a parent are stored first, as bare ids: whole rows are then marked without shuffling them, unless the
    orphans themselves are many and far apart. Parents that carry values are joined by ``attach``."""

    def by(child: DataFrame, parent: DataFrame, link: Parent) -> DataFrame:
        if link.carry:
            return attach(child, parent, link)
        name = f"{table}-orphans-{link.table}"
        orphans = keep(orphan_keys(child, parent, link.key, link.key), name)
        return with_stored_orphans(child, orphans, link.key, link.missing, keep, name)

    return by


def typed(table: str, bronze: DataFrame) -> DataFrame:
    """Casts and normal forms only; no row is dropped or marked."""
    return bronze.withColumns(CLEANINGS[table]().types)


def flagged(
    table: str, bronze: DataFrame, parents: Mapping[str, DataFrame] | None = None, attach: AttachParent = join_parent
) -> DataFrame:
    """Typed rows with the list of rules each one breaks."""
    return judged(table, typed(table, bronze), parents, attach)


def judged(
    table: str, rows: DataFrame, parents: Mapping[str, DataFrame] | None = None, attach: AttachParent = join_parent
) -> DataFrame:
    """Rows that are typed already, with the list of rules each one breaks."""
    cleaning = CLEANINGS[table]()
    for link in cleaning.parents:
        rows = attach(rows, (parents or {})[link.table], link)
    helpers = [name for link in cleaning.parents for name in (link.missing, *link.carried().values())]
    return with_flags(rows, cleaning.rules).drop(*helpers)


def with_silver_time(df: DataFrame) -> DataFrame:
    return df.withColumn("silver_processed_timestamp", F.current_timestamp())


def newest_valid(table: str, valid: DataFrame) -> DataFrame:
    """One row per key. Runs after validation, so an older valid row beats a newer rejected one."""
    return latest_per_key(valid, CLEANINGS[table]().key, newest_order(valid))


def newest_of_stored(table: str, valid: DataFrame, keep: Keep) -> tuple[DataFrame, DataFrame]:
    """``newest_valid`` of stored rows, in two parts: rows alone with their key, which are not shuffled, and the newest of the others."""
    return latest_per_key_of_stored(valid, CLEANINGS[table]().key, newest_order(valid), keep, f"{table}-repeated")


def clean(
    table: str,
    bronze: DataFrame,
    parents: Mapping[str, DataFrame] | None = None,
    attach: AttachParent = join_parent,
    keep: Keep | None = None,
) -> Cleaned:
    """Clean one table: (newest valid row per key, every rejected row).

    Lazy unless ``keep`` is given. Both results need the checked rows: ``keep`` (such as ``Staging.store``)
    stores these, and the newest rows of repeated keys, so that they are computed once and later steps start from stored tables.
    """
    rows = flagged(table, bronze, parents, by_orphans(keep, table, attach) if keep else attach)
    if keep:
        rows = keep(rows, f"{table}-flagged")
    valid, rejected = split_by_flags(rows)
    if keep:
        alone, newest = newest_of_stored(table, valid, keep)
        valid = alone.unionByName(keep(newest, f"{table}-valid"))
    else:
        valid = newest_valid(table, valid)
    return Cleaned(with_silver_time(valid), with_silver_time(rejected))


def clean_all(bronze: Mapping[str, DataFrame], keep: Keep | None = None) -> dict[str, Cleaned]:
    """Clean the given tables in dependency order; children are checked against cleaned parents."""
    done: dict[str, Cleaned] = {}
    for table in CLEANINGS:
        if table in bronze:
            parents = {name: part.valid for name, part in done.items()}
            done[table] = clean(table, bronze[table], parents, join_cleaned_parent, keep)
    return done


def rejected_flags(bronze: Mapping[str, DataFrame], keep: Keep) -> dict[str, DataFrame]:
    """The flags of all rejected rows of the given tables, nothing else of them.

    Rules that need no parent are settled before the joins, so these move keys and what the other rules read. Of cleaned parents
    only the columns that children read are made, and stored by ``keep``; a table without children is not stored at all.
    """
    found: dict[str, DataFrame] = {}
    parents: dict[str, DataFrame] = {}
    for table in CLEANINGS:
        if table not in bronze:
            continue
        cleaning = CLEANINGS[table]()
        rows = typed(table, bronze[table]).withColumn("_own", collect_flags([rule for rule in cleaning.rules if not rule.of_parent]))
        for link in cleaning.parents:
            rows = join_cleaned_parent(rows, parents[link.table], link)
        rows = rows.withColumn(FLAGS, F.concat("_own", collect_flags([rule for rule in cleaning.rules if rule.of_parent])))
        valid, rejected = split_by_flags(rows)
        found[table] = rejected.select(FLAGS)
        links = [link for child in bronze for link in CLEANINGS[child]().parents if link.table == table]
        read = list(dict.fromkeys(name for link in links for name in (link.key, *link.carry)))
        if read:
            bare = set(read) == set(cleaning.key)
            parents[table] = keep(valid.select(*read).distinct() if bare else newest_valid(table, valid).select(*read), f"{table}-keys")
    return found


def with_dependencies(tables: Iterable[str] | None) -> list[str]:
    """The chosen tables and all they depend on, parents first."""
    needed: set[str] = set()

    def add(table: str) -> None:
        needed.add(raw_source(table).table)
        for link in CLEANINGS[table]().parents:
            add(link.table)

    for table in tables or CLEANINGS:
        raw_source(table)
        add(table)
    return [table for table in CLEANINGS if table in needed]


Put = Callable[[DataFrame, str], int]


def _refine_into(
    spark: SparkSession, table: str, bronze: DataFrame, parents: Mapping[str, DataFrame], put: Put
) -> LoadCounts:
    """Clean one stored table; ``put`` writes its ``valid`` and its ``rejected`` rows and returns their number.

    Flagged rows are staged once, split by verdict, so the scan, casts and key checks run once for both
    outputs.
    """
    with staging(spark, f"silver-{table}") as stage:
        rows = flagged(table, bronze, parents, by_orphans(stage.store, table)).withColumn("_rejected", has_flags())
        path = f"{stage.folder}/flagged"
        read = write_counted(rows, path, "overwrite", partition_by=("_rejected",))["rows"]
        stored = spark.read.schema(rows.schema).parquet(path)
        alone, newest = newest_of_stored(table, stored.filter("NOT _rejected").drop("_rejected"), stage.store)
        valid = alone.unionByName(newest)
        order = CLEANINGS[table]().file_order
        if order:
            valid = valid.sortWithinPartitions(*order)
        rejected = stored.filter("_rejected").drop("_rejected")
        written = put(with_silver_time(valid), "valid")
        bad = put(with_silver_time(rejected), "rejected")
    return LoadCounts(table, "", read, written, bad)


def refine_table(
    spark: SparkSession,
    table: str,
    bronze: DataFrame,
    parents: Mapping[str, DataFrame],
    silver_root: str,
    quarantine_root: str,
    fmt: str = DEFAULT_FORMAT,
) -> LoadCounts:
    """Clean one stored table into its Silver and quarantine folders."""
    paths = {"valid": f"{silver_root}/{table}", "rejected": f"{quarantine_root}/silver/{table}"}

    def put(df: DataFrame, verdict: str) -> int:
        return write_counted(df, paths[verdict], "overwrite", fmt)["rows"]

    return _refine_into(spark, table, bronze, parents, put)


def refine(
    spark: SparkSession,
    bronze_root: str,
    silver_root: str,
    quarantine_root: str,
    tables: Iterable[str] | None = None,
    fmt: str = DEFAULT_FORMAT,
) -> list[LoadCounts]:
    """Bronze to Silver for the chosen tables and their dependencies, in order."""
    results, cleaned = [], {}
    for table in with_dependencies(tables):
        bronze = read_table(spark, f"{bronze_root}/{table}", fmt)
        results.append(refine_table(spark, table, bronze, cleaned, silver_root, quarantine_root, fmt))
        cleaned[table] = read_table(spark, f"{silver_root}/{table}", fmt)
    return results


def rejected_name(table: str) -> str:
    return f"rejected_{table}"


def refine_together(
    spark: SparkSession, bronze_root: str, store: Snapshots, tables: Iterable[str] | None = None, fmt: str = DEFAULT_FORMAT
) -> list[LoadCounts]:
    """Bronze to Silver, published in one step: valid tables under their names, rejected rows as ``rejected_<table>``.

    Children are checked against the cleaned parents of the same load, which no reader sees before the end.
    """
    results = []
    with store.load() as load:
        for table in with_dependencies(tables):

            def put(df: DataFrame, verdict: str, table: str = table) -> int:
                name = table if verdict == "valid" else rejected_name(table)
                return load.write(name, df)["rows"]

            parents = {link.table: load.read(link.table) for link in CLEANINGS[table]().parents}
            bronze = read_table(spark, f"{bronze_root}/{table}", fmt)
            results.append(_refine_into(spark, table, bronze, parents, put))
    return results
