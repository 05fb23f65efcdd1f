"""Session settings the library relies on, and the shared scratch folder."""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Instants are stored in UTC; casts must fail loudly (a bad number fails the
# batch, it does not become null); a table rewrite touches only the partitions
# present in the written data. The wide feed projections compile to methods above
# the size the JVM's own compiler accepts (8000 bytes); past that limit Spark
# should split them rather than run them interpreted. Shuffled joins hash their smaller
# side where each part of it is known to be small, and sort both only where it is not.
_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings above to ``spark`` and return it."""
    for key, value in _SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, named by ``spark.checkpoint.dir``.

    Where that is unset, a folder of the warehouse, which they share as well.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/checkpoint"


def new_run_dir(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def files_at(spark: SparkSession, path: str):
    """Hadoop's view of ``path``: works for every file system Spark writes to."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def remove(spark: SparkSession, path: str) -> None:
    files, target = files_at(spark, path)
    files.delete(target, True)


_open_scope: ContextVar[list[str] | None] = ContextVar("open_scope", default=None)


def staged(rows: DataFrame, label: str = "stage") -> DataFrame:
    """The same rows, written once to the shared folder and read back.

    For rows that several branches of a plan read: they are computed once, each
    branch scans only its columns, and a lost executor costs a re-read. The
    folder stays until the enclosing ``discarding`` block ends, or for good.
    """
    spark = rows.sparkSession
    folder = new_run_dir(spark, label)
    scope = _open_scope.get()
    if scope is not None:
        scope.append(folder)
    rows.write.parquet(folder)
    return spark.read.schema(rows.schema).parquet(folder)


@contextmanager
def discarding(spark: SparkSession):
    """Remove what was staged inside the block when it ends, so that a job that
    runs for ever does not fill the shared folder. Results must be written, not
    returned, inside the block."""
    token = _open_scope.set([])
    try:
        yield
    finally:
        folders = _open_scope.get()
        _open_scope.reset(token)
        for folder in folders:
            remove(spark, folder)
