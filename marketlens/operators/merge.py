"""Row merging: which of several versions of a row stays."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from marketlens.functions.values import any_of
from marketlens.operators.lookup import lookup, shuffled


def _one_per_key(rows: DataFrame, keys: list[str], order: list) -> DataFrame:
    # ``row_number() = 1`` is planned with a group limit before the shuffle: a
    # task sends at most one row per key, so a key that holds a third of the
    # rows costs its reducer one row per map task.
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def latest_per_key(rows: DataFrame, keys: list[str], arrival: list[str]) -> DataFrame:
    """Last row of each key in arrival order (``arrival`` must be unique)."""
    return _one_per_key(rows, keys, [F.desc_nulls_last(c) for c in arrival])


def first_per_key(rows: DataFrame, keys: list[str], arrival: list[str]) -> DataFrame:
    """First row of each key in arrival order."""
    return _one_per_key(rows, keys, [F.asc_nulls_last(c) for c in arrival])


def latest_per_complete_key(rows: DataFrame, keys: list[str], arrival: list[str]) -> DataFrame:
    """Like ``latest_per_key``, but a null in a key never equals anything, so
    rows with an incomplete key all stay. One pass: such a row is numbered, and its
    number is part of its key."""
    incomplete = any_of([F.col(c).isNull() for c in keys])
    numbered = rows.withColumn("_alone", F.when(incomplete, F.monotonically_increasing_id()))
    return latest_per_key(numbered, [*keys, "_alone"], arrival).drop("_alone")


def merge_rows(stored: DataFrame, latest: DataFrame, keys: list[str], grows: bool = False) -> DataFrame:
    """Upsert: rows of ``latest`` (unique by key) replace stored rows whole,
    nulls included. The stored side is not re-sorted or re-grouped; when the
    batch is small the planner broadcasts its keys and the table never moves.
    Keys of a batch that ``grows`` with the data are not broadcast, see ``lookup``."""
    replaced = latest.select(*keys)
    kept = stored.join(shuffled(replaced) if grows else replaced, keys, "left_anti")
    return kept.unionByName(latest)


def upsert(
    stored: DataFrame, batch: DataFrame, keys: list[str], arrival: list[str]
) -> DataFrame:
    """Table after loading ``batch``, whose ``arrival`` columns are dropped."""
    latest = latest_per_key(batch, keys, arrival).select(*stored.columns)
    return merge_rows(stored, latest, keys)


def replace_children(
    stored: DataFrame, new_rows: DataFrame, parents: DataFrame, parent_keys: list[str]
) -> DataFrame:
    """Detail rows after a load: those of touched parents are all replaced, also
    when a parent brings none; the others stay. Duplicates are kept."""
    touched = parents.select(*parent_keys).distinct()
    kept = lookup(stored, touched, parent_keys, "left_anti")
    return kept.unionByName(new_rows.select(*stored.columns))


def replace_snapshot(
    stored: DataFrame,
    batch: DataFrame,
    loaded_accounts: DataFrame,
    keys: list[str],
    arrival: list[str],
) -> DataFrame:
    """Snapshot after a load: every loaded account has only the batch's rows."""
    kept = lookup(stored, loaded_accounts, ["account_id"], "left_anti")
    fresh = latest_per_complete_key(batch, keys, arrival).select(*stored.columns)
    return kept.unionByName(fresh)


def append_once(stored: DataFrame, batch: DataFrame, group: list[str]) -> DataFrame:
    """Rows of ``batch`` whose group (say day and account) is not stored yet."""
    return lookup(batch, stored.select(*group).distinct(), group, "left_anti")
