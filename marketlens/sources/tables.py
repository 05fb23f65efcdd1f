"""Stored tables: Parquet folders that a load only adds to.

A loaded table is a folder of folders:

``load=<n>``      the rows of load ``n``, each with ``_order``: what decides between
                  two versions of a row (load number, then arrival)
``replaced=<n>``  for loads that replace: the keys whose earlier rows no longer count
``base=<n>``      the rows in force after load ``n``, by account

A folder counts once Spark has written its ``_SUCCESS``, as the last thing. No load
rewrites or removes a folder, so one that dies leaves the table as it was, and its
cost does not depend on the size of the table. Reading merges the loads since the
base into it; when they are few the planner broadcasts them and the base is not
moved. ``compact`` makes a new base, as often as reads should be cheap. One load or
compaction of a table runs at a time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlens import schemas
from marketlens.operators.lookup import lookup
from marketlens.operators.merge import latest_per_key, merge_rows
from marketlens.session import files_at, remove

# Keys of so many loaded rows may be broadcast when a table is read.
_BROADCAST_ROWS = 500_000
_ORDER = T.StructField("_order", T.ArrayType(T.LongType()))


def folders(spark: SparkSession, path: str) -> list[str]:
    files, target = files_at(spark, path)
    if not files.exists(target):
        return []
    return [status.getPath().getName() for status in files.listStatus(target)]


def exists(spark: SparkSession, path: str) -> bool:
    """Is there any data? Markers, whose names start with _ or ., do not count."""
    return any(name[0] not in "_." for name in folders(spark, path))


def finished_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders under ``path`` whose write was committed."""
    files, _ = files_at(spark, path)
    names = folders(spark, path)
    return [n for n in names if files.exists(files_at(spark, f"{path}/{n}/_SUCCESS")[1])]


def numbered(names: list[str], kind: str) -> list[int]:
    """The numbers of the folders ``<kind>=<n>``, ascending."""
    start = f"{kind}="
    return sorted(int(name.removeprefix(start)) for name in names if name.startswith(start))


def next_number(spark: SparkSession, path: str) -> int:
    """Number of the next load; that of one that died is not used again."""
    names = folders(spark, path)
    return 1 + max([0, *(n for kind in ("load", "replaced", "base") for n in numbered(names, kind))])


def _since_base(spark: SparkSession, path: str) -> tuple[int, list[int]]:
    """Number of the newest base (0: none) and the finished loads after it."""
    names = finished_folders(spark, path)
    base = max([0, *numbered(names, "base")])
    return base, [n for n in numbered(names, "load") if n > base]


def read_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    """The rows of a table in force; an absent table reads as empty."""
    schema = schemas.TABLES[name]
    if name not in schemas.LOADED:
        if not exists(spark, path):
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(path).select(*schema.names)
    base, loads = _since_base(spark, path)
    stored = spark.createDataFrame([], schema)
    if base:
        stored = spark.read.schema(schema).parquet(f"{path}/base={base}").select(*schema.names)
    if not loads:
        return stored
    added = spark.read.schema(T.StructType([*schema.fields, _ORDER]))
    rows = added.parquet(*(f"{path}/load={n}" for n in loads))
    keys = schemas.LOADED[name]
    if keys == schemas.KEYS.get(name):
        # A load holds one row per key, so a single one needs no sort of all its rows.
        latest = (latest_per_key(rows, keys, ["_order"]) if len(loads) > 1 else rows).select(*schema.names)
        if not base:
            return latest
        # Counted, because sizes are estimated from compressed files: keys taken for 5 MB held 235.
        return merge_rows(stored, latest, keys, grows=rows.select().count() > _BROADCAST_ROWS)
    replaced = spark.read.parquet(*(f"{path}/replaced={n}" for n in loads))
    last = replaced.groupBy(*keys).agg(F.max("_load").alias("_load"))
    in_force = lookup(
        rows.withColumn("_load", F.element_at("_order", 1)), last, [*keys, "_load"], "left_semi"
    )
    kept = lookup(stored, last, keys, "left_anti")
    return kept.unionByName(in_force.select(*schema.names))


def _order(number: int, arrival: list[str]) -> Column:
    parts = [F.lit(number).cast("bigint"), *(F.col(c).cast("bigint") for c in arrival)]
    return F.array(*parts).alias("_order")


def upsert_table(
    batch: DataFrame, path: str, keys: list[str], arrival: list[str], order: int | None = None
) -> None:
    """Insert or overwrite rows by key; the last arrival of a key wins.

    Later loads win over earlier ones. Loads that are given the same ``order`` count
    as parts of one, so that among them arrival (whole numbers) alone decides. A
    repeat of the same batch leaves the table as it is.
    """
    number = next_number(batch.sparkSession, path)
    columns = [c for c in batch.columns if c not in arrival or c in keys]
    latest = latest_per_key(batch, keys, arrival)
    version = _order(number, []) if order is None else _order(order, arrival)
    latest.select(*columns, version).write.parquet(f"{path}/load={number}")


def replace_rows(rows: DataFrame, replaced: DataFrame, path: str, keys: list[str]) -> None:
    """Make ``rows`` all there is of every key in ``replaced``, also where there are none."""
    number = next_number(rows.sparkSession, path)
    gone = replaced.select(*keys, F.lit(number).cast("bigint").alias("_load")).distinct()
    gone.write.parquet(f"{path}/replaced={number}")
    rows.select(*rows.columns, _order(number, [])).write.parquet(f"{path}/load={number}")


def compact(spark: SparkSession, path: str, name: str) -> None:
    """Make the rows in force the new base. What the base before it needs stays until
    the next compaction, for those who read it. Afterwards arrival decides no more
    between a row of the base and a load: compact when no stream is amid a run."""
    base, loads = _since_base(spark, path)
    if not loads:
        return
    target = f"{path}/base={loads[-1]}"
    rows = read_table(spark, path, name).hint("rebalance", "account_id")
    # Overwrites at most what a compaction that died has left.
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
    writer.partitionBy("account_id").parquet(target)
    names = folders(spark, path)
    for old in [f"base={n}" for n in numbered(names, "base") if n < base]:
        remove(spark, f"{path}/{old}")
    for kind in ("load", "replaced"):
        for number in numbered(names, kind):
            if number <= base:
                remove(spark, f"{path}/{kind}={number}")


def write_groups(rows: DataFrame, path: str, partition: list[str]) -> None:
    """Write whole partitions; a repeat after a crash replaces what it left.

    Rebalancing groups the rows by partition and splits the groups that are large.
    """
    (
        rows.hint("rebalance", *partition)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition)
        .parquet(path)
    )
