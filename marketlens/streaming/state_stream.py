"""Feed state as a streaming aggregate over the log of run events.

The state of a feed is a fold of its events, and every part of the fold is a minimum or a
maximum, so the state store holds one row per feed and a micro-batch reads only the events
that came since. What changed is upserted into the table of feed states: a run looks
its cursor up there at a cost that does not grow with the log.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from marketlens import schemas
from marketlens.operators import control
from marketlens.session import discarding
from marketlens.sources.tables import upsert_table


def event_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The folder that runs append their events to, as an unbounded source."""
    return spark.readStream.schema(schemas.RUN_EVENTS).parquet(folder)


def start_state(
    events: DataFrame, table_path: str, checkpoint_path: str, trigger: dict | None = None
) -> StreamingQuery:
    """Keep the feed states of ``events`` up to date. Default: all there is, then stop. A
    micro-batch that is repeated after a crash writes the same states again."""

    def load(rows: DataFrame, batch_id: int) -> None:
        with discarding(rows.sparkSession):
            numbered = rows.withColumn("_batch", F.lit(batch_id).cast("bigint"))
            upsert_table(numbered, table_path, schemas.KEYS["feed_state"], ["_batch"])

    return (
        control.state_from_events(events)
        .writeStream.outputMode("update")
        .foreachBatch(load)
        .option("checkpointLocation", checkpoint_path)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
