"""Landed feed pages: NDJSON folders read with a declared schema.

A landed folder holds one JSON object per line and is partitioned by
``account_id=<n>``. Fields that are not declared get no column; feeds whose tables
keep the source object carry it whole in ``_raw``, a variant. A line that is not an
object of the declared shape fails the read, or is set apart with its account.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlens import schemas
from marketlens.functions.dates import feed_day_end, feed_instant, feed_midnight
from marketlens.operators.lookup import lookup

FEEDS = {
    "orders": schemas.ORDERS.landed(),
    "sales": schemas.SALES.landed(),
    "finance_sales_report_details": schemas.SETTLEMENT.landed(),
    "finance_sales_report_weekly": schemas.SETTLEMENT.landed(),
    "report_list": schemas.REPORT_LIST.landed(),
    "warehouse_remains": schemas.STOCK.landed(),
    "fbw_supplies": schemas.SUPPLY.landed(),
    "supply_details": schemas.SUPPLY_DETAIL.landed(),
    "supply_goods": schemas.SUPPLY_GOOD.landed(),
    "supply_packages": schemas.SUPPLY_PACKAGE.landed(),
    "supply_payloads": schemas.SUPPLY_PAYLOAD,
}

# Supply states the supplies feed asks for.
SUPPLY_STATUSES = (1, 2, 3, 4, 5, 6)

# What the landing job writes next to the source's own fields. Responses for one
# supply carry no id, so they are landed with the key they were requested for.
_ARRIVAL = [T.StructField(n, T.LongType()) for n in ("account_id", "page", "position")]
_REQUESTED_FOR = [T.StructField("supply_key", T.StringType())]
_PER_SUPPLY = ("supply_details", "supply_goods", "supply_packages")


def landed_schema(feed: str) -> T.StructType:
    keyed = _REQUESTED_FOR if feed in _PER_SUPPLY else []
    return T.StructType(_ARRIVAL + keyed + FEEDS[feed].fields)


#: Feeds whose tables keep the source object.
WITH_PAYLOAD = (
    "finance_sales_report_details",
    "finance_sales_report_weekly",
    "warehouse_remains",
    "fbw_supplies",
    "supply_payloads",
    *_PER_SUPPLY,
)
#: Partition of a landed folder: the UTC day on which its lines were landed.
LANDED_ON = "landed_on"
#: Text of a line that is no object of its feed.
BROKEN = "_broken"
#: Number of the answer a line is part of, in feeds that are streamed by answers.
ANSWER = "answer"


def read_feed(spark: SparkSession, folder: str, feed: str, keep_broken: bool = False) -> DataFrame:
    """All landed rows of ``feed``. ``page`` and ``position`` give arrival order.

    A line that is no object of the declared shape fails the read. With
    ``keep_broken`` it becomes a row of its account, without fields and with its text in
    ``_broken``, so that a run can fail that account and load the others.
    """
    return parsed_lines(spark.read.text(folder), feed, keep_broken)


def parsed_lines(
    lines: DataFrame, feed: str, keep_broken: bool = False, answered: bool = False
) -> DataFrame:
    """Rows of a feed from its lines (column ``value``; others are columns of the folder's
    partitions, which stand before a field of that name). ``answered`` adds ``answer``."""
    schema, line = landed_schema(feed), F.col("value")
    if answered:
        schema = T.StructType([*schema.fields, T.StructField(ANSWER, T.LongType())])
    outside = [name for name in lines.columns if name != "value"]
    is_object = F.ltrim(line).startswith("{")
    if keep_broken:
        schema = T.StructType([*schema.fields, T.StructField(BROKEN, T.StringType())])
        options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN}
        whole = F.from_json(F.when(is_object, line), schema, options)
    else:
        not_one = F.raise_error(F.concat(F.lit("MALFORMED_RECORD: no object: "), F.substring(line, 1, 200)))
        whole = F.from_json(F.when(is_object, line).otherwise(not_one), schema, {"mode": "FAILFAST"})
    # Unfolded as a one-row array, so that a line is parsed once.
    rows = lines.filter(F.trim(line) != "").select(*outside, "value", F.inline_outer(F.array(whole)).alias(
        *(f"_{name}" if name in outside else name for name in schema.names)
    ))
    columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields if f.name != BROKEN]
    columns += [F.col(LANDED_ON).cast("date").alias(LANDED_ON)] if LANDED_ON in outside else []
    if feed in WITH_PAYLOAD:
        columns.append(F.try_parse_json("value").alias("_raw"))
    if keep_broken:
        columns.append(F.when(is_object, F.col(BROKEN)).otherwise(F.col("value")).alias(BROKEN))
    return rows.select(*columns)


def stream_feed(
    spark: SparkSession, folder: str, feed: str, max_files: int | None = None
) -> DataFrame:
    """The same folder as an unbounded source."""
    reader = spark.readStream.schema(landed_schema(feed)).option("mode", "FAILFAST")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(folder)


def parse_payload(payload: Column, feed: str) -> Column:
    """A payload kept as JSON text, as a struct; text that does not parse fails."""
    return F.from_json(payload, FEEDS[feed], {"mode": "FAILFAST"})


def changed_since(feed: DataFrame, since: Column) -> DataFrame:
    """Order / sale rows whose change date is not before ``since``."""
    return feed.filter(feed_instant(F.col("lastChangeDate")) >= since)


def landed_since(feed: DataFrame, cursors: DataFrame, at: str = "cursor_timestamp") -> DataFrame:
    """``feed`` without the landing days that no cursor reaches back to.

    For folders with a second partition, ``landed_on``, the UTC day on which a line was
    landed. A row is landed on the day it changed or later, so rows behind a cursor lie in
    no earlier day; the days before are not even listed. Rows of an earlier day with a
    later date do not exist, late rows lie in the day they came. The lowest cursor is one
    value; other folders are read whole.
    """
    if LANDED_ON not in feed.columns:
        return feed
    lowest = cursors.agg(F.to_date(F.min(at)).alias("day"), F.count_if(F.col(at).isNull()).alias("open")).first()
    if lowest["day"] is None or lowest["open"]:
        return feed
    return feed.filter(F.col(LANDED_ON) >= F.lit(lowest["day"]))


def reports_between(report_list: DataFrame, start: Column, end: Column) -> DataFrame:
    """Listed reports that overlap the days of ``start`` .. ``end``."""
    begins, ends = feed_instant(F.col("dateFrom")), feed_instant(F.col("dateTo"))
    return report_list.filter(
        (F.coalesce(ends, begins) >= feed_midnight(start)) & (begins <= feed_day_end(end))
    )


def supplies_created(supplies: DataFrame, first_day: Column, last_day: Column) -> DataFrame:
    """Supplies in a listed state created on the days ``first_day`` .. ``last_day``."""
    created = F.to_date(feed_instant(F.col("createDate")) + F.expr("interval 3 hours"))
    return supplies.filter(
        F.col("statusID").cast("int").isin(*SUPPLY_STATUSES) & created.between(first_day, last_day)
    )


def report_lines(lines: DataFrame, reports: DataFrame) -> DataFrame:
    """All lines of the given reports (account_id, reportId)."""
    wanted = reports.select("account_id", "reportId").filter("reportId is not null").distinct()
    return lookup(lines, wanted, ["account_id", "reportId"], "left_semi")
