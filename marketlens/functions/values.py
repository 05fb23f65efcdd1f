"""Column helpers for loosely typed feed values."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text stored when a record has none of its identifying fields; every such
# record of an account then shares one key.
NO_KEY = "None"


def blank_to_null(column: Column) -> Column:
    return F.nullif(column, F.lit(""))


def to_decimal(column: Column, precision: int = 18, scale: int = 6) -> Column:
    """Text or number to decimal. Blank is null, anything else unparsable fails."""
    return blank_to_null(column.cast("string")).cast(f"decimal({precision},{scale})")


def to_long(column: Column) -> Column:
    return blank_to_null(column.cast("string")).cast("bigint")


def to_int(column: Column) -> Column:
    return blank_to_null(column.cast("string")).cast("int")


def first_filled(*columns: Column) -> Column:
    """First value that is neither null nor blank, else the literal ``None``."""
    return F.coalesce(*[blank_to_null(c.cast("string")) for c in columns], F.lit(NO_KEY))


def strip(column: Column) -> Column:
    """Remove leading and trailing whitespace of any script, not just spaces."""
    return F.regexp_replace(column, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda left, right: left | right, conditions)


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda left, right: left & right, conditions)


def snake_case(name: str) -> str:
    """``saleID`` -> ``sale_id``, ``isKgvpV2`` -> ``is_kgvp_v2``."""
    return re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", name).lower()
