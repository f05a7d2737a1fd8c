"""Quality rules: name what is wrong with a row, then keep good and bad rows apart."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from sluicebox.contracts import FLAGS, ServingTable, serving_table
from sluicebox.sources.storage import Staging


@dataclass(frozen=True)
class Rule:
    """A flag and the SQL predicate of the rows it marks. A NULL predicate does not mark.

    ``of_parent``: the predicate reads what a join with a parent has added.
    """

    flag: str
    broken: str | Column
    of_parent: bool = False

    def raised(self) -> Column:
        """The flag in an array, or an empty array."""
        broken = F.expr(self.broken) if isinstance(self.broken, str) else self.broken
        return F.when(broken, F.array(F.lit(self.flag))).otherwise(no_flags())


def no_flags() -> Column:
    return F.array().cast("array<string>")


def collect_flags(rules: Sequence[Rule]) -> Column:
    """All raised flags in rule order, as one expression that compiles (no projection or lambda per rule)."""
    return F.concat(no_flags(), *[rule.raised() for rule in rules])


def with_flags(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    return df.withColumn(FLAGS, collect_flags(rules))


def has_flags() -> Column:
    return F.size(FLAGS) > 0


def split_by_flags(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return df.filter(~has_flags()), df.filter(has_flags())


def flag_report(rejected: Mapping[str, DataFrame]) -> DataFrame:
    """Rejected rows per table and flag. A row with two flags counts under both."""
    parts = [
        df.select(F.lit(table).alias("table_name"), F.explode(FLAGS).alias("flag"))
        .groupBy("table_name", "flag")
        .agg(F.count("*").alias("rejected_rows"))
        for table, df in rejected.items()
    ]
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report


def _rule_checks(table: ServingTable) -> dict[str, Column]:
    checks = {f"not_null:{name}": F.col(name).isNull() for name in table.required}
    return checks | {f"max_length:{name}": F.length(name) > size for name, size in table.max_length.items()}


def unique_rule(table: ServingTable) -> str:
    return f"unique:{','.join(table.key)}"


def contract_report(frames: Mapping[str, DataFrame], stage: Staging) -> DataFrame:
    """Contract violations of several tables, (table_name, rule, violations), from one pass over all of them.

    The tables are stacked as bare pairs of table number and 64-bit key hash. Nulls and lengths are counted while the stack is
    read. Pairs are counted with a map-side combine, so a key that repeats endlessly is one row per task, and only the hashes
    that occur twice are kept. Whether these are repeated keys or colliding hashes is settled on their own rows alone; a table
    without any is not read again.
    """
    seen, parts, measures = Observation(f"contracts-{uuid.uuid4()}"), [], {}
    for number, (name, df) in enumerate(frames.items()):
        broken = _rule_checks(serving_table(name))
        flags = F.array(*broken.values())
        parts.append(df.select(F.lit(number).alias("number"), F.xxhash64(*serving_table(name).key).alias("hash"), flags.alias("broken")))
        for place, rule in enumerate(broken):
            measures[f"r{number}_{place}"] = (name, rule)
    tallies = [
        F.count_if((F.col("number") == int(label[1:].split("_")[0])) & F.get("broken", F.lit(int(label.split("_")[1])))).alias(label)
        for label in measures
    ]
    stack = reduce(DataFrame.unionByName, parts).observe(seen, *tallies)
    twice = stage.store(stack.groupBy("number", "hash").agg(F.count("*").alias("n")).where("n > 1").drop("n"), "repeated-hashes")
    try:
        found = [(*measures[label], int(n)) for label, n in seen.get.items() if n]
    except Py4JJavaError:  # Spark leaves out the counting of a stack that it can tell to be empty, and then has no counts to give
        if not stack.isEmpty():
            raise
        found = []
    suspects = {row["number"] for row in twice.select("number").distinct().collect()}  # one row per table at most
    for number, (name, df) in enumerate(frames.items()):
        if number in suspects:
            table = serving_table(name)
            hashes = twice.where(F.col("number") == number).select("hash")
            keys = df.select(*table.key, F.xxhash64(*table.key).alias("hash")).join(hashes, "hash", "left_semi")
            surplus = keys.groupBy(*table.key).agg(F.count("*").alias("copies")).agg(F.sum(F.col("copies") - 1)).first()[0]
            if surplus:
                found.append((name, unique_rule(table), int(surplus)))
    return twice.sparkSession.createDataFrame(found, "table_name STRING, rule STRING, violations BIGINT")


def contract_violations(df: DataFrame, table: ServingTable) -> DataFrame:
    """Rows breaking NOT NULL and length limits, and surplus rows per key, counted per rule.

    Limits need one pass and no shuffle of rows. Key counts are combined before they are shuffled,
    so one key that repeats endlessly is no heavier than any other.
    """
    checks = _rule_checks(table)
    counts = df.agg(*[F.count_if(check).alias(name) for name, check in checks.items()])
    by_rule = counts.unpivot([], list(checks), "rule", "violations")
    surplus = (
        df.groupBy(*table.key)
        .agg(F.count("*").alias("copies"))
        .agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("violations"))
        .select(F.lit(unique_rule(table)).alias("rule"), "violations")
    )
    return (
        by_rule.unionByName(surplus)
        .filter("violations > 0")
        .select(F.lit(table.name).alias("table_name"), "rule", "violations")
    )
