"""Feed configuration, feed state, the run ledger and their reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.schemas import RUN_EVENTS

FEED = ["account_id", "api_type"]

# Fixed value: longest error message kept.
MESSAGE_LIMIT = 4000

# Event kinds, and the state columns each one writes. ``heartbeat`` and
# ``checkpoint`` only touch a state row that exists; the others create it.
STARTED, CHECKPOINT, SUCCESS, ERROR, INTERRUPTED, HEARTBEAT = (
    "started",
    "checkpoint",
    "success",
    "error",
    "interrupted",
    "heartbeat",
)
_CREATING = (STARTED, SUCCESS, ERROR, INTERRUPTED)
_FAILED = (ERROR, INTERRUPTED)


def feed_configs(
    configs: DataFrame,
    accounts: DataFrame,
    api_type: str | None = None,
    account_code: str | None = None,
) -> DataFrame:
    """Configured feeds with their account; enabled only when both are."""
    owners = accounts.select(
        F.col("id").alias("account_id"),
        "account_code",
        "account_name",
        "token_env_var",
        F.col("enabled").alias("_account_enabled"),
    )
    joined = configs.join(owners, "account_id")
    if api_type is not None:
        joined = joined.filter(F.col("api_type") == api_type)
    if account_code is not None:
        joined = joined.filter(F.col("account_code") == account_code)
    return joined.select(
        "id",
        "account_id",
        "account_code",
        "account_name",
        "token_env_var",
        "api_type",
        (F.col("_account_enabled") & F.col("enabled")).alias("enabled"),
        "schedule_seconds",
        "lookback_days",
        "batch_limit",
        "revision",
    ).orderBy("account_id", "api_type")


def feed_state(state: DataFrame, account_id: int, api_type: str) -> DataFrame:
    return state.filter((F.col("account_id") == account_id) & (F.col("api_type") == api_type))


def run_event(
    spark: SparkSession, account_id: int, api_type: str, run_id: str, kind: str, at, seq: int, **details
) -> DataFrame:
    """One row to append to the run-event log. ``details``: rows_written,
    cursor_timestamp, cursor_key, message."""
    row = {
        "account_id": account_id, "api_type": api_type, "run_id": run_id,
        "kind": kind, "at": at, "seq": seq, **details,
    }
    return spark.createDataFrame([tuple(row.get(n) for n in RUN_EVENTS.names)], RUN_EVENTS)


def _order() -> list[Column]:
    return [F.col("at"), F.col("seq")]


def _last(kinds: tuple[str, ...], **values: Column) -> Column:
    """Latest event among ``kinds`` as a struct of its time and ``values``."""
    event = F.struct(*_order(), *[v.alias(n) for n, v in values.items()])
    return F.max(F.when(F.col("kind").isin(*kinds), event))


def _message() -> Column:
    return F.substring("message", 1, MESSAGE_LIMIT)


# Events per task of a fold; up to 200 tasks a shuffle writes rows as they come, above it
# holds them in memory to sort them.
_FOLD_EVENTS, _FOLD_TASKS = 50_000, 200


def _fold_tasks(events: DataFrame) -> int:
    """Over how many tasks a log is folded. Folding texts means sorting the rows of a task,
    messages and all, so what a task holds is set by number of events: files and adaptive
    execution cut by compressed bytes, of which messages have few."""
    return min(_FOLD_TASKS, 1 + events.count() // _FOLD_EVENTS)


def state_from_events(events: DataFrame) -> DataFrame:
    """Feed state after the run events, taken in order of (at, seq).

    Each column is set by some kinds of event only, so its value is that of the
    latest event of those kinds. A stream of events is grouped once, a log first by
    parts of its runs: of a busy feed a task then holds a part.
    """
    events = events.withColumn("message", _message())
    created = F.min(F.when(F.col("kind").isin(*_CREATING), F.struct(*_order()))).alias("created")
    latest = [
        _last((CHECKPOINT, SUCCESS), ts=F.col("cursor_timestamp"), key=F.col("cursor_key")).alias("cursor"),
        _last((STARTED,)).alias("started"),
        _last((SUCCESS,)).alias("succeeded"),
        _last((SUCCESS, *_FAILED)).alias("finished"),
        _last((SUCCESS, *_FAILED), kind=F.col("kind"), text=F.col("message")).alias("outcome"),
        _last((*_CREATING, CHECKPOINT, HEARTBEAT), run=F.col("run_id")).alias("touched"),
        _last((*_CREATING, CHECKPOINT), kind=F.col("kind")).alias("status"),
    ]
    if events.isStreaming:
        folded = events.groupBy(*FEED).agg(created, *latest)
    else:
        tasks = _fold_tasks(events)
        part = F.pmod(F.hash("run_id"), F.lit(tasks)).alias("_part")
        parts = events.select("*", part).repartition(tasks, *FEED, "_part")
        parts = parts.groupBy(*FEED, "_part").agg(created, *latest)
        found = [name for name in parts.columns if name not in (*FEED, "_part", "created")]
        folded = parts.repartition(tasks, *FEED).groupBy(*FEED).agg(
            F.min("created").alias("created"), *(F.max(name).alias(name) for name in found)
        )
    # A checkpoint before the row existed wrote nothing.
    cursor_stands = F.struct("cursor.at", "cursor.seq") >= F.col("created")
    failed = F.col("outcome.kind").isin(*_FAILED)
    status = (
        F.when(F.col("status.kind").isin(STARTED, CHECKPOINT), F.lit("running"))
        .when(F.col("status.kind") == SUCCESS, F.lit("idle"))
        .when(F.col("status.kind") == ERROR, F.lit("error"))
        .otherwise(F.lit("stopped"))
    )
    return folded.filter(F.col("created").isNotNull()).select(
        *FEED,
        F.when(cursor_stands, F.col("cursor.ts")).alias("cursor_timestamp"),
        F.when(cursor_stands, F.col("cursor.key")).alias("cursor_key"),
        F.col("started.at").alias("last_started_at"),
        F.col("finished.at").alias("last_finished_at"),
        F.col("succeeded.at").alias("last_success_at"),
        F.when(failed, F.col("outcome.at")).alias("last_error_at"),
        F.when(failed, F.col("outcome.text")).alias("last_error_message"),
        F.col("touched.at").alias("heartbeat_at"),
        F.col("touched.run").alias("run_id"),
        status.alias("status"),
    )


def run_ledger(events: DataFrame) -> DataFrame:
    """One row per started run, closed by its outcome.

    Success and error always close a run. An interruption closes only a run that
    nothing has closed yet. Success leaves an earlier error message in place.
    """
    spread = events.withColumn("message", _message()).repartition(_fold_tasks(events), *FEED, "run_id")
    runs = spread.groupBy(*FEED, "run_id").agg(
        F.min(F.when(F.col("kind") == STARTED, F.struct(*_order()))).alias("started"),
        _last((SUCCESS, ERROR), kind=F.col("kind")).alias("closed"),
        F.min(F.when(F.col("kind").isin(SUCCESS, ERROR), F.struct(*_order()))).alias("first_closed"),
        F.min(
            F.when(F.col("kind") == INTERRUPTED, F.struct(*_order(), F.col("message").alias("text")))
        ).alias("stopped"),
        _last((SUCCESS,), rows=F.col("rows_written")).alias("succeeded"),
        _last((ERROR,), text=F.col("message")).alias("failed"),
    )
    stop_counts = F.col("stopped").isNotNull() & F.coalesce(
        F.struct("stopped.at", "stopped.seq") < F.col("first_closed"), F.lit(True)
    )
    stopped_text = F.when(stop_counts, F.col("stopped.text"))
    return runs.filter(F.col("started").isNotNull()).select(
        *FEED,
        "run_id",
        F.col("started.at").alias("started_at"),
        F.coalesce("closed.at", F.when(stop_counts, F.col("stopped.at"))).alias("finished_at"),
        F.coalesce("closed.kind", F.when(stop_counts, F.lit("stopped")), F.lit("running")).alias("status"),
        F.coalesce("succeeded.rows", F.lit(0)).alias("rows_written"),
        F.coalesce("failed.text", stopped_text).alias("error_message"),
    )


def interruptions(events: DataFrame, at: Column, message: str = "run did not end") -> DataFrame:
    """One interrupted event for every run that was started and that nothing has closed:
    what the driver of such a run could no longer log."""
    closing = (SUCCESS, *_FAILED)
    key = [*FEED, "run_id"]
    started = events.filter(F.col("kind") == STARTED).select(*key).distinct()
    closed = events.filter(F.col("kind").isin(*closing)).select(*key)
    fixed = {
        "seq": F.lit(0).cast("bigint"),
        "at": at,
        "kind": F.lit(INTERRUPTED),
        "message": F.lit(message[:MESSAGE_LIMIT]),
    }
    found = started.join(closed, key, "left_anti").withColumns(fixed)
    columns = [
        (F.col(f.name) if f.name in found.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in RUN_EVENTS.fields
    ]
    return found.select(*columns)


def state_report(state: DataFrame) -> DataFrame:
    return state.select(
        *FEED, "status", "cursor_timestamp", "last_success_at", "last_error_at", "last_error_message"
    ).orderBy(*FEED)


def recent_runs(ledger: DataFrame, limit: int = 20) -> DataFrame:
    """The newest runs of the ledger (it is a report of the last ``limit``)."""
    return (
        ledger.orderBy(F.desc("id"))
        .limit(limit)
        .select(
            *FEED, "status", "rows_written", "started_at", "finished_at", "error_message"
        )
    )


def load_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table."""
    counts = [
        rows.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name, rows in tables.items()
    ]
    merged = counts[0]
    for other in counts[1:]:
        merged = merged.unionByName(other)
    return merged
