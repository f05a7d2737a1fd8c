"""Text clean-up expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def trimmed(name: str) -> Column:
    return F.trim(F.col(name))


def lowered(name: str) -> Column:
    return F.lower(trimmed(name))


def uppered(name: str) -> Column:
    return F.upper(trimmed(name))


def titled(name: str) -> Column:
    """Title case without touching inner spaces."""
    return F.initcap(trimmed(name))


def spaced(name: str, separator: str = " ") -> Column:
    """Trim, then turn each inner run of white space into one separator."""
    return F.regexp_replace(trimmed(name), r"\s+", separator)


def tidy_name(name: str) -> Column:
    return F.initcap(spaced(name))


def snake_code(name: str) -> Column:
    return F.lower(spaced(name, "_"))


def or_unknown(value: Column) -> Column:
    """NULL becomes 'unknown'; a blank text stays blank."""
    return F.coalesce(value, F.lit("unknown"))


def is_blank(name: str) -> Column:
    return F.coalesce(trimmed(name), F.lit("")) == ""
