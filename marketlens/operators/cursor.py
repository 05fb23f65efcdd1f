"""Incremental extraction: cursors, what lies behind them, and how they move.

A cursor is (timestamp, key) per (account, feed). The feed state is one row per
(account, feed), looked up by every row of the feed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.functions.dates import feed_day_end, feed_midnight
from marketlens.operators.lookup import lookup

FEED = ["account_id", "api_type"]


def initial_cursor(configs: DataFrame, state: DataFrame, now: Column) -> DataFrame:
    """Where each configured feed starts: its stored cursor, else ``now`` minus
    its look-back days and no key."""
    stored = state.select(*FEED, "cursor_timestamp", "cursor_key")
    lookback = now - F.make_dt_interval(days=F.col("lookback_days"))
    has_cursor = F.col("cursor_timestamp").isNotNull()
    return configs.join(stored, FEED, "left").select(
        *FEED,
        F.coalesce("cursor_timestamp", lookback).alias("cursor_timestamp"),
        F.when(has_cursor, F.col("cursor_key")).alias("cursor_key"),
    )


def rows_after_cursor(rows: DataFrame, cursors: DataFrame, at: str, key: str) -> DataFrame:
    """Rows strictly behind the cursor their feed *started* from.

    An earlier row is dropped; a row at the cursor's very time is dropped when
    its key is not greater, provided a key was stored. Nothing is deduplicated.
    Feeds without a cursor keep every row.
    """
    started = cursors.select(
        *FEED, F.col("cursor_timestamp").alias("_at"), F.col("cursor_key").alias("_key")
    )
    is_old = F.col(at) < F.col("_at")
    is_seen = (F.col(at) == F.col("_at")) & (F.col(key) <= F.col("_key"))
    dropped = F.coalesce(is_old, F.lit(False)) | F.coalesce(is_seen, F.lit(False))
    return lookup(rows, started, FEED).filter(~dropped).drop("_at", "_key")


def advance_cursor(cursors: DataFrame, kept: DataFrame, at: str, key: str) -> DataFrame:
    """Next cursor: the highest (timestamp, key) kept, never below the old one."""
    reached = kept.groupBy(*FEED).agg(
        F.max(F.struct(F.col(at).alias("at"), F.col(key).alias("key"))).alias("_top"),
        F.count("*").alias("_kept"),
    )
    old = F.struct(F.col("cursor_timestamp").alias("at"), F.col("cursor_key").alias("key"))
    # A kept row never sorts below the cursor it passed, except that a null key
    # sorts lowest, which is what lets any key follow it.
    moved = F.col("_top").isNotNull() & ((F.col("_top") > old) | F.col("cursor_timestamp").isNull())
    top = F.when(moved, F.col("_top")).otherwise(old)
    return cursors.join(reached, FEED, "left").select(
        *FEED,
        top.getField("at").alias("cursor_timestamp"),
        top.getField("key").alias("cursor_key"),
        F.coalesce("_kept", F.lit(0)).alias("rows_kept"),
        F.coalesce(moved, F.lit(False)).alias("moved"),
    )


def run_status(rows_written: Column) -> Column:
    return F.when(rows_written > 0, F.lit("success")).otherwise(F.lit("noop"))


def progress_report(rows: DataFrame, advanced: DataFrame, configs: DataFrame) -> DataFrame:
    """Per feed, of one fetched page that starts at the cursor: rows read and kept,
    status, and whether it is stuck, that is the page is full and nothing in it lies
    behind the cursor. For a whole landed history this is no test."""
    read = rows.groupBy(*FEED).agg(F.count("*").alias("rows_read"))
    limits = configs.select(*FEED, "batch_limit")
    joined = advanced.join(read, FEED, "left").join(limits, FEED, "left")
    rows_read = F.coalesce("rows_read", F.lit(0))
    return joined.select(
        *FEED,
        rows_read.alias("rows_read"),
        "rows_kept",
        run_status(F.col("rows_kept")).alias("status"),
        F.coalesce((rows_read >= F.col("batch_limit")) & ~F.col("moved"), F.lit(False)).alias("stuck"),
    )


def require_progress(report: DataFrame) -> None:
    """Fail when any feed is stuck: reading on would repeat the page for ever. The
    report has one row per feed."""
    stuck = sorted(tuple(row) for row in report.filter("stuck").select(*FEED).collect())
    if stuck:
        named = "; ".join(f"account_id={account} api_type={api}" for account, api in stuck)
        raise RuntimeError(f"cursor did not advance for {named}")


# ------------------------------------------------------------ settlement window


def settlement_window(cursor: Column, now: Column) -> tuple[Column, Column]:
    """From the start of the cursor's UTC+3 day to the last second of today."""
    return feed_midnight(cursor), feed_day_end(now)


def settlement_backlog(
    lines: DataFrame, cursors: DataFrame, now: Column, at: str = "date_from", keep: Column | None = None
) -> DataFrame:
    """Lines inside each account's window and behind its line checkpoint; those that
    ``keep`` names stay wherever they are.

    ``cursor_key`` holds the last line number stored by an unfinished run.
    """
    first, last = settlement_window(F.col("cursor_timestamp"), now)
    bounds = cursors.select(
        "account_id",
        first.alias("_first"),
        last.alias("_last"),
        F.coalesce(F.nullif("cursor_key", F.lit("")).cast("bigint"), F.lit(0)).alias("_after"),
    )
    inside = F.col(at).between(F.col("_first"), F.col("_last")) & (F.col("rrd_id") > F.col("_after"))
    if keep is not None:
        inside = F.coalesce(inside, F.lit(False)) | keep
    return lookup(lines, bounds, ["account_id"], "inner").filter(inside).drop("_first", "_last", "_after")


def checkpoint(backlog: DataFrame) -> DataFrame:
    """Resume point to store while a run is going on: the highest line written."""
    return backlog.groupBy("account_id").agg(F.max("rrd_id").cast("string").alias("cursor_key"))


def settlement_next_cursor(cursors: DataFrame, backlog: DataFrame, now: Column) -> DataFrame:
    """After success: today's UTC+3 midnight and no key, rows or not. The last
    day is therefore always read again."""
    written = backlog.groupBy("account_id").agg(F.count("*").alias("_written"))
    rows = F.coalesce("_written", F.lit(0))
    return cursors.join(written, "account_id", "left").select(
        "account_id",
        feed_midnight(now).alias("cursor_timestamp"),
        F.lit(None).cast("string").alias("cursor_key"),
        rows.alias("rows_written"),
        run_status(rows).alias("status"),
    )


def lookback_window(now: Column, lookback_days: Column) -> tuple[Column, Column]:
    """Last ``lookback_days`` UTC+3 days up to the end of today."""
    start = feed_midnight(now - F.make_dt_interval(days=lookback_days))
    return start, feed_day_end(now)
