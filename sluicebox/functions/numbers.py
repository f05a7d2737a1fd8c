"""Safe casts, money sums that lose nothing, and guarded ratios.

Money arrives as double. A value of ordinary size is read as a whole number of ten-thousandths, and sums of such are kept
as two bigints (blocks of 2**20 and the rest), so a total is exact, does not depend on how rows were split over tasks,
and costs about what a double sum costs. Values outside that range, NaN and infinity go into a double sum beside them. Both
are added when a group is finished, so every value reaches its total and none can overflow. Exact totals are rounded half up as
decimals and given back as double, the type of the serving tables.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLOCK_BITS = 20
BLOCK = 1 << BLOCK_BITS
SCALE = 10_000
EXACT_LIMIT = 1 << 50  # in ten-thousandths: about 110 thousand million


def to_long(name: str) -> Column:
    """Whole number or NULL. '12.7' gives 12 and '.5' gives 0, as the lenient cast does; the pattern runs only on misses."""
    whole = F.regexp_replace(F.col(name).cast("string"), r"^\s*([+-]?)(\d*)\.(?:\d*)\s*$", "$10$2")
    whole = F.when(F.col(name).cast("string").rlike(r"\d"), whole)
    return F.coalesce(F.col(name).try_cast("bigint"), whole.try_cast("bigint"))


def to_double(name: str) -> Column:
    return F.col(name).try_cast("double")


class Money(NamedTuple):
    """A value or a total: the exact part, and a double for what is outside the exact range; either may be NULL."""

    exact: Column
    other: Column

    def where(self, condition: Column) -> Money:
        return Money(F.when(condition, self.exact), F.when(condition, self.other))

    def times(self, factor: Column) -> Money:
        """Of single values: a product that leaves the exact range goes on as a double."""
        product = F.try_multiply(self.exact, factor.cast("bigint"))
        kept = F.when(F.abs(product) < EXACT_LIMIT, product)
        double = F.coalesce(self.other, self.exact.cast("double") / SCALE) * factor.cast("double")
        return Money(kept, F.when(kept.isNull(), double))

    def double(self) -> Column:
        """The whole total."""
        exact = self.exact.cast("double")
        return F.when(self.other.isNull(), exact).otherwise(F.coalesce(exact, F.lit(0.0)) + self.other)

    def rounded(self, digits: int = 2) -> Column:
        return F.when(self.other.isNull(), F.round(self.exact, digits).cast("double")).otherwise(F.round(self.double(), digits))

    def ratio(self, denominator: Column, digits: int) -> Column:
        """The total over a count, rounded; NULL unless the count is above zero."""
        rough = F.when(denominator > 0, F.round(self.double() / denominator.cast("double"), digits))
        return F.when(self.other.isNull(), safe_ratio(self.exact, denominator, digits)).otherwise(rough)


def money(name: str) -> Money:
    """A money column in whole ten-thousandths, or as a double where it is too large for them or not finite."""
    value = F.col(name).cast("double")
    exact = F.rint(value * SCALE).try_cast("bigint")
    kept = F.when(F.abs(value) < EXACT_LIMIT / SCALE, exact)
    return Money(kept, F.when(kept.isNull(), value))


def count_of(name: str) -> Column:
    """How many values of a money column there are."""
    return F.count(F.col(name).cast("double"))


def sum_parts(value: Money, name: str) -> list[Column]:
    """The sums of a value: ``<name>_blocks`` and ``<name>_rest`` as bigint, ``<name>_other`` as double."""
    return [
        F.sum(F.shiftright(value.exact, BLOCK_BITS)).alias(f"{name}_blocks"),
        F.sum(value.exact.bitwiseAND(F.lit(BLOCK - 1))).alias(f"{name}_rest"),
        F.sum(value.other).alias(f"{name}_other"),
    ]


def resum_parts(name: str) -> list[Column]:
    """Add up stored parts."""
    return [F.sum(f"{name}_{part}").alias(f"{name}_{part}") for part in ("blocks", "rest", "other")]


def _joined(blocks: Column, rest: Column, other: Column) -> Money:
    whole = blocks.cast("decimal(20,0)") * F.lit(BLOCK).cast("decimal(7,0)") + rest.cast("decimal(20,0)")
    return Money(whole * F.lit("0.0001").cast("decimal(4,4)"), other)


def from_parts(name: str) -> Money:
    """The total of three stored part columns."""
    return _joined(*(F.col(f"{name}_{part}") for part in ("blocks", "rest", "other")))


def times_parts(name: str, factor: Column) -> Money:
    """The total of three stored part columns that count ``factor`` times."""
    return _joined(*(F.col(f"{name}_{part}") * factor for part in ("blocks", "rest", "other")))


def sum_of_parts(name: str) -> Money:
    return _joined(*resum_parts(name))


def total(value: Money) -> Money:
    """The total of a value, as an aggregate."""
    return _joined(*sum_parts(value, ""))


def rounded(value: Column, digits: int = 2) -> Column:
    return F.round(value, digits).cast("double")


def safe_ratio(numerator: Column, denominator: Column, digits: int, otherwise: float | None = None) -> Column:
    """numerator / denominator, rounded; ``otherwise`` unless the denominator is above zero."""
    ratio = F.round(numerator.cast("decimal(28,4)") / denominator.cast("decimal(28,4)"), digits)
    return F.when(denominator > 0, ratio.cast("double")).otherwise(F.lit(otherwise).cast("double"))


def nan_to_null(df: DataFrame) -> DataFrame:
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({name: F.when(~F.isnan(name), F.col(name)) for name in floats})
