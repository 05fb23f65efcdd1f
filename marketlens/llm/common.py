"""What the operators share: staged results, text identity, reading a table."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import gc
import sys
import types
import uuid
from collections.abc import Callable
from typing import Any

import pyarrow
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_folders: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _delete(spark: SparkSession, folder: str) -> None:
    with contextlib.suppress(Exception):  # the session may have ended
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def run_folder(spark: SparkSession) -> str:
    """This application's folder below ``spark.checkpoint.dir``, or below the
    warehouse where that is unset; all executors share either. It is deleted
    when the driver's Python ends."""
    application = spark.sparkContext.applicationId
    if application not in _folders:
        shared = spark.conf.get("spark.checkpoint.dir", None) or (
            spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/checkpoint"
        )
        _folders[application] = f"{shared.rstrip('/')}/llm-{application}-{uuid.uuid4().hex[:8]}"
        atexit.register(_delete, spark, _folders[application])
    return _folders[application]


def staged(rows: DataFrame, label: str) -> DataFrame:
    """The same rows, written once to the shared folder and read back: computed
    once, cut from their lineage, and safe from the loss of an executor."""
    spark = rows.sparkSession
    folder = f"{run_folder(spark)}/{label}-{uuid.uuid4().hex}"
    rows.write.parquet(folder)
    return spark.read.schema(rows.schema).parquet(folder)


def small_batches(rows: DataFrame) -> DataFrame:
    """``rows``, in a session that hands at most 2 MB, or one row, at a time to Python:
    texts may be long, and default batches of them take much of an executor's memory. The
    setting stays, since rows are handed over when a result is written, not here."""
    key, most = "spark.sql.execution.arrow.maxBytesPerBatch", 2 << 20
    conf = rows.sparkSession.conf
    if int(conf.get(key).rstrip("bB")) > most:
        conf.set(key, str(most))
    return rows


#: Bits of the filter that ``divided`` broadcasts: 2 MB, however many keys there are.
_FILTER_BITS = 1 << 24


def divided(rows: DataFrame, key: str, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows`` in two parts: those whose ``key`` (a hash, long) may be among ``keys``
    (one column of hashes), and those for which it is certainly not, which then need no
    shuffle to be told apart. A bitmap of fixed size is broadcast; more keys than it has
    bits only make the first part larger. A null key is certainly not among them."""
    word = F.col("_llm_bit").bitwiseAND(F.lit((1 << 15) - 1))
    bits = keys.toDF("_llm_bit").select(F.col("_llm_bit").bitwiseAND(F.lit(_FILTER_BITS - 1)).alias("_llm_bit"))
    bits = bits.groupBy(F.shiftright("_llm_bit", 15).alias("_llm_bucket")).agg(
        F.bitmap_construct_agg(word).alias("_llm_bits")
    )
    bits = staged(bits, "filter")
    own = F.col(key).bitwiseAND(F.lit(_FILTER_BITS - 1))
    looked = rows.withColumn("_llm_bucket", F.shiftright(own, 15)).join(F.broadcast(bits), "_llm_bucket", "left")
    place = own.bitwiseAND(F.lit((1 << 15) - 1))
    byte = F.substring("_llm_bits", (F.shiftright(place, 3) + 1).cast("int"), F.lit(1))
    mask = F.pow(F.lit(2), place.bitwiseAND(F.lit(7))).cast("long")
    among = F.coalesce(F.conv(F.hex(byte), 16, 10).cast("long").bitwiseAND(mask) != 0, F.lit(False))
    return looked.filter(among).select(*rows.columns), looked.filter(~among).select(*rows.columns)


def others(rows: DataFrame, *given: str) -> list[str]:
    """The columns of ``rows`` that stay beside the results ``given``. A result takes the
    place of a column of its name, upper and lower case alike."""
    taken = {name.lower() for name in given}
    return [name for name in rows.columns if name.lower() not in taken]


def text_key(text: Column) -> Column:
    """Identity of a text: equal for equal texts, and for null and the empty one."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def _kept() -> dict[str, Any]:
    # Functions that travel by value have no module of their own to keep things in.
    return sys.modules.setdefault("marketlens_kept", types.ModuleType("marketlens_kept")).__dict__.setdefault("kept", {})


def kept_in_process(name: str, make: Callable[[], Any]) -> Any:
    """What ``make`` gives, made once in a Python worker and used by its later tasks
    too, until a task of another kind ends there (``give_back_memory``)."""
    kept = _kept()
    if name not in kept:
        kept.clear()
        kept[name] = make()
    return kept[name]


def give_back_memory(keep: str | None = None) -> None:
    """Called when a task's Python ends: lets go of what other kinds of tasks kept in the
    worker, all but ``keep``, and hands freed memory to the system. The worker lives on for
    the next stages, which share the executor's memory with it."""
    kept = _kept()
    for name in set(kept) - {keep}:
        del kept[name]
    gc.collect()
    pyarrow.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some C libraries have it
    if trim is not None:
        trim(0)
