"""Observed prices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.operators.merge import latest_per_key

_OBSERVED = (
    "item_key",
    "item_name",
    "price",
    "wallet_price",
    "old_price",
    "currency",
    "availability",
    "observed_at",
    "final_url",
    "page_title",
)


def page_fingerprint(html: Column) -> Column:
    """Hex SHA-256 of a page, stored next to what was read from it."""
    return F.sha2(html, 256)


def latest_prices(snapshots: DataFrame, sources: DataFrame) -> DataFrame:
    """Newest observation of each source; the later snapshot wins a tie.

    The source's description is joined to the winners only.
    """
    newest = latest_per_key(
        snapshots.select("id", "source_id", *_OBSERVED), ["source_id"], ["observed_at", "id"]
    )
    described = sources.select(F.col("id").alias("source_id"), "source_code", "source_name", "source_type")
    return newest.drop("id").join(described, "source_id")
