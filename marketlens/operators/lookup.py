"""Joins of many rows to at most one match each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_KEY = "_lookup_key"


def shuffled(rows: DataFrame) -> DataFrame:
    """``rows`` as a side of a join that is never broadcast.

    For sides that grow with the data. The planner takes a side's size from compressed
    files and from declared widths: of keys taken out of a wide parsed object it expects
    a few hundredths of the file, and would gather millions of them in the driver.
    """
    return rows.hint("merge")


def lookup(
    rows: DataFrame, unique: DataFrame, keys: list[str], how: str = "left", grows: bool = False
) -> DataFrame:
    """Join ``rows`` to ``unique``, which has one row per key.

    One key may hold a large share of ``rows``. Adaptive execution splits such a
    key over several tasks, but only where both sides of the join come straight
    from a shuffle made for it; a side that a grouping or window has already
    partitioned by the key rules that out. So the key goes in as one struct,
    which no earlier step has partitioned by. A small ``unique`` is broadcast as
    usual, after the planner has looked at its size; one that ``grows`` with the data is
    not, see ``shuffled``.

    Keys must not be null: inside a struct two nulls are equal.
    """
    keyed = rows.withColumn(_KEY, F.struct(*keys))
    others = [] if how in ("left_semi", "left_anti") else [c for c in unique.columns if c not in keys]
    found = unique.select(F.struct(*keys).alias(_KEY), *others)
    return keyed.join(shuffled(found) if grows else found, _KEY, how).drop(_KEY)
