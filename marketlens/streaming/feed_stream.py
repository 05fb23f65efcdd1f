"""Continuous change feed: landed files to an upserted table, batch by batch.

Each micro-batch runs the same operators as a batch load. A row counts as new by
the cursor its feed had when the run of the stream started, not by an event-time
watermark: the cursor is per (account, feed) and breaks ties by key. All the
micro-batches of a run compare with the same cursors and are parts of one load, so
neither their size nor the order of files decides which rows stay.

Order of writes in a batch: rows first, then the cursor. A batch repeated after
a crash in between keeps the same rows and upserts them again, which changes
nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from marketlens import schemas
from marketlens.functions.dates import feed_instant
from marketlens.operators import cursor, normalize
from marketlens.plans.loads import movement_batch
from marketlens.session import discarding, remove, staged
from marketlens.sources.tables import finished_folders, next_number, numbered, upsert_table

_CURSOR_SCHEMA = (
    "account_id bigint, api_type string, cursor_timestamp timestamp, cursor_key string"
)
_KEPT = 2  # folders of cursors that stay: the newest, and the one a repeated batch reads
_FEEDS = {
    "orders": normalize.order_key,
    "sales": normalize.sale_key,
}
_ARRIVAL = ["page", "position"]


def read_cursors(
    spark: SparkSession, path: str, before_batch: int | None = None
) -> DataFrame:
    """Cursor of each feed. Every batch leaves a folder with all of them, so only
    the newest finished folder is read (older than ``before_batch``, if given)."""
    numbers = numbered(finished_folders(spark, path), "batch")
    usable = [n for n in numbers if before_batch is None or n < before_batch]
    if not usable:
        return spark.createDataFrame([], _CURSOR_SCHEMA)
    return spark.read.schema(_CURSOR_SCHEMA).parquet(f"{path}/batch={max(usable)}")


def _drop_old(spark: SparkSession, path: str, kind: str) -> None:
    for number in numbered(finished_folders(spark, path), kind)[:-_KEPT]:
        remove(spark, f"{path}/{kind}={number}")


def load_batch(
    rows: DataFrame,
    batch_id: int,
    api_type: str,
    table_path: str,
    cursor_path: str,
    starts: DataFrame | None = None,
    order: int | None = None,
) -> None:
    """One idempotent load of landed rows (account_id, page, position, fields).
    ``starts`` are the cursors the rows must lie behind (default: those before this
    batch), ``order`` the number of the load the batch is a part of."""
    with discarding(rows.sparkSession):
        _load_batch(rows, batch_id, api_type, table_path, cursor_path, starts, order)


def _load_batch(
    rows: DataFrame,
    batch_id: int,
    api_type: str,
    table_path: str,
    cursor_path: str,
    starts: DataFrame | None,
    order: int | None,
) -> None:
    spark = rows.sparkSession
    key = _FEEDS[api_type]
    # Cursors this very batch wrote before a crash must not hide its rows.
    before = read_cursors(spark, cursor_path, batch_id)
    marked = rows.withColumns(
        {
            "api_type": F.lit(api_type),
            "row_at": feed_instant(F.col("lastChangeDate")),
            "row_key": key(),
        }
    )
    starts = before if starts is None else starts
    kept = staged(cursor.rows_after_cursor(marked, starts, "row_at", "row_key"), "feed-batch")
    batch = movement_batch(kept, api_type)
    upsert_table(batch, table_path, schemas.KEYS[api_type], _ARRIVAL, order)
    known = before.unionByName(starts.join(before, cursor.FEED, "left_anti"))
    new_feeds = kept.select(*cursor.FEED).distinct().join(known, cursor.FEED, "left_anti")
    feeds = known.unionByName(new_feeds, allowMissingColumns=True)
    moved = cursor.advance_cursor(feeds, kept, "row_at", "row_key")
    # One folder per batch: a repeated batch overwrites its own cursors only.
    (
        moved.select(*cursor.FEED, "cursor_timestamp", "cursor_key")
        .repartition(1)  # one row per feed; what makes them runs in many tasks
        .write.mode("overwrite")
        .parquet(f"{cursor_path}/batch={batch_id}")
    )
    _drop_old(spark, cursor_path, "batch")


def _started(
    spark: SparkSession, table_path: str, cursor_path: str, starts: DataFrame | None, resumed: bool
) -> tuple[DataFrame, int]:
    """Cursors and load number of a run, kept in ``start=<number>`` for one that goes on."""
    path = f"{cursor_path}/runs"
    numbers = numbered(finished_folders(spark, path), "start")
    if resumed and numbers:
        number = numbers[-1]
    else:
        number = max([next_number(spark, table_path), *(n + 1 for n in numbers)])
        first = read_cursors(spark, cursor_path)
        if starts is not None:
            given = starts.select(*first.columns)
            first = first.unionByName(given.join(first, cursor.FEED, "left_anti"))
        first.repartition(1).write.mode("overwrite").parquet(f"{path}/start={number}")
        _drop_old(spark, path, "start")
    return spark.read.schema(_CURSOR_SCHEMA).parquet(f"{path}/start={number}"), number


def start_load(
    feed: DataFrame,
    api_type: str,
    table_path: str,
    cursor_path: str,
    checkpoint_path: str,
    trigger: dict | None = None,
    load: Callable[..., None] = load_batch,
    starts: DataFrame | None = None,
    resumed: bool = False,
    **options,
) -> StreamingQuery:
    """Run ``load_batch`` over a streaming feed. Default: all there is, then stop.

    ``starts`` gives cursors to feeds that have none yet (``cursor.initial_cursor``:
    the look-back). ``resumed`` says that the run before this one died: its
    starting cursors hold for the rest of its files too."""
    first, order = _started(feed.sparkSession, table_path, cursor_path, starts, resumed)
    return (
        feed.writeStream.foreachBatch(
            lambda rows, batch_id: load(
                rows, batch_id, api_type, table_path, cursor_path, starts=first, order=order, **options
            )
        )
        .option("checkpointLocation", checkpoint_path)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
