"""Every operator as a query over the test tables.

A query builds its inputs from the whole tables, runs the operator and returns
its rows with plain types: money as double, days and instants as text. The
operators themselves keep exact decimals and real dates.
"""

from __future__ import annotations

import contextlib
from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlens import schemas
from marketlens.functions.dates import feed_instant, feed_midnight, request_text, week_start
from marketlens.operators import checks, control, cost, cursor, normalize, reports, supplies
from marketlens.operators.lookup import shuffled
from marketlens.operators.merge import first_per_key, latest_per_key, replace_snapshot, upsert
from marketlens.plans import facts, identity, prices, runs, settlement
from marketlens.plans.loads import Store, load_identified_lines
from marketlens.session import new_run_dir, staged
from marketlens.sources import landed, tables
from marketlens.streaming import answer_stream, feed_stream
from marketlens.streaming import state_stream as state_events
from workload import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}



def at(text: str) -> Column:
    return F.lit(text).cast("timestamp")


def fact_day() -> Column:
    return F.lit("2026-06-01").cast("date")


NOW = "2026-06-01 12:00:00"
DAILY, WEEKLY = "day", "week"


def plain(rows: DataFrame) -> DataFrame:
    """Types every SQL engine prints alike."""
    columns = []
    for field in rows.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, T.DateType):
            column = F.date_format(column, "yyyy-MM-dd")
        elif isinstance(field.dataType, T.TimestampType):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(field.dataType, (T.IntegerType, T.ByteType, T.ShortType)):
            column = column.cast("bigint")
        columns.append(column.alias(field.name))
    return rows.select(*columns)


def query(name: str) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(build(spark, sf_dir))

        _REGISTRY[name] = run
        return build

    return register


def registered() -> dict[str, Query]:
    return dict(_REGISTRY)


def _current_costs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cost.current_costs(fx.costs(spark, sf_dir))


# ------------------------------------------------------------ settlement


def _summary(period: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return settlement.settlement_summary(
        fx.settlement_lines(spark, sf_dir, period), fx.accounts(spark, sf_dir)
    )


query("settlement_daily")(partial(_summary, DAILY))
query("settlement_weekly")(partial(_summary, WEEKLY))


@query("settlement_by_sku")
def settlement_by_sku(spark, sf_dir):
    return settlement.settlement_by_sku(
        fx.settlement_lines(spark, sf_dir),
        fx.accounts(spark, sf_dir),
        _current_costs(spark, sf_dir),
    )


@query("settlement_enriched")
def settlement_enriched(spark, sf_dir):
    enriched = settlement.settlement_enriched(
        fx.settlement_lines(spark, sf_dir), _current_costs(spark, sf_dir)
    )
    return enriched.select(
        "account_id", "report_id", "rrd_id", "sku", "vendor_code", "seller_oper_name", "quantity",
        "for_pay", "unit_cost", "cost", "total_to_pay", "profit",
    )


@query("sku_reference")
def sku_reference(spark, sf_dir):
    return settlement.sku_reference(fx.settlement_lines(spark, sf_dir))


# ------------------------------------------------------------ units and facts


@query("trusted_identifiers")
def trusted_identifiers(spark, sf_dir):
    return identity.trusted_identifiers(fx.settlement_lines(spark, sf_dir, DAILY))


@query("resolved_lines")
def resolved_lines(spark, sf_dir):
    resolved = identity.resolve_lines(fx.settlement_lines_once(spark, sf_dir, DAILY))
    return resolved.withColumnRenamed("_resolved", "kiz")


@query("unit_identity")
def unit_identity(spark, sf_dir):
    return identity.unit_identity(fx.settlement_lines_once(spark, sf_dir, DAILY)).select(
        "account_id", "report_id", "rrd_id", "nm_id", "seller_oper_name", "kiz", "srid", "order_id",
        "order_uid", "shk_id", "restored_kiz", "uniq_product_id",
    )


@query("unit_buyout")
def unit_buyout(spark, sf_dir):
    lines = fx.settlement_lines_once(spark, sf_dir, DAILY)
    totals = facts.unit_totals(facts.resolved_units(lines))
    return totals.withColumn("ratio", F.round("ratio", 10))


def _facts(fan_out: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = fx.settlement_lines_once(spark, sf_dir, DAILY)
    return facts.article_facts(lines, fx.accounts(spark, sf_dir), fact_day(), fan_out)


query("article_facts")(partial(_facts, "articles_squared"))
query("article_facts_per_unit")(partial(_facts, "unit"))


@query("facts_load")
def facts_load(spark, sf_dir):
    """Accounts 1 and 2 have facts for the day, account 3 for the day before."""
    lines = fx.settlement_lines_once(spark, sf_dir, DAILY)
    articles = lines.filter("account_id <= 3").select("account_id", "nm_id").distinct()
    day = F.when(F.col("account_id") == 3, F.date_sub(fact_day(), 1)).otherwise(fact_day())
    stored = articles.withColumn("fact_date", day)
    computed = facts.article_facts(lines, fx.accounts(spark, sf_dir), fact_day())
    fresh = facts.facts_to_store(stored, computed)
    columns = ["fact_date", "account_id", "nm_id"]
    return stored.select(*columns, F.lit(0).cast("bigint").alias("buyout_basis_units")).unionByName(
        fresh.select(*columns, "buyout_basis_units")
    )


# ------------------------------------------------------------ prices


@query("latest_prices")
def latest_prices(spark, sf_dir):
    return prices.latest_prices(fx.price_snapshots(spark, sf_dir), fx.price_sources(spark, sf_dir))


@query("price_snapshots")
def price_snapshots(spark, sf_dir):
    return fx.price_snapshots(spark, sf_dir).select(
        "id", "source_id", "price", "wallet_price", "item_key", "availability", "html_sha256", "raw_payload"
    )


# ------------------------------------------------------------ costs


@query("cost_current")
def cost_current(spark, sf_dir):
    return _current_costs(spark, sf_dir)


@query("cost_ensure")
def cost_ensure(spark, sf_dir):
    """A batch whose codes come padded, and partly new."""
    lines = table_lines(spark, sf_dir)
    code = (
        "case when l_partkey % 10 = 0 then ' ' when l_partkey % 11 = 0 then null "
        "else 'VC' || cast(l_partkey % 71 as string) end"
    )
    batch = lines.selectExpr(
        "cast(l_orderkey % 5 + 1 as bigint) as account_id",
        f"case when l_partkey % 3 = 0 then '\t ' || ({code}) || '  ' else ({code}) end as vendor_code",
    )
    return cost.missing_for_batch(batch, fx.costs(spark, sf_dir), at(NOW))


def table_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.table(spark, sf_dir, "lineitem")


def _coded_lines(spark: SparkSession, sf_dir: str, modulus: int) -> DataFrame:
    code = f"case when l_partkey % 10 = 0 then '' else 'VC' || cast(l_partkey % {modulus} as string) end"
    return table_lines(spark, sf_dir).selectExpr(
        "cast(l_orderkey % 5 + 1 as bigint) as account_id", f"{code} as vendor_code"
    )


@query("cost_backfill")
def cost_backfill(spark, sf_dir):
    both = [_coded_lines(spark, sf_dir, 53), _coded_lines(spark, sf_dir, 67)]
    return cost.missing_for_tables(both, fx.costs(spark, sf_dir), at(NOW))


@query("cost_legacy_fanout")
def cost_legacy_fanout(spark, sf_dir):
    both = [_coded_lines(spark, sf_dir, 53), _coded_lines(spark, sf_dir, 67)]
    return cost.spread_legacy(fx.costs(spark, sf_dir, legacy=True), both)


# ------------------------------------------------------------ normalised feeds


@query("feed_dates")
def feed_dates(spark, sf_dir):
    feed = fx.order_feed(spark, sf_dir)
    return feed.select(
        "position",
        feed_instant(F.col("date")).alias("order_at"),
        feed_instant(F.col("cancelDate")).alias("cancel_at"),
        feed_midnight(feed_instant(F.col("date"))).alias("feed_day_start"),
        week_start(F.to_date(feed_instant(F.col("date")))).alias("week_start"),
        request_text(feed_instant(F.col("date"))).alias("request_text"),
    )


@query("normalized_orders")
def normalized_orders(spark, sf_dir):
    rows = normalize.normalize_orders(fx.order_feed(spark, sf_dir), ["position"])
    return rows.select(
        "position", "account_id", "record_key", "order_date", "last_change_date", "cancel_date",
        "warehouse_name", "nm_id", "total_price", "finished_price", "discount_percent", "spp",
        "is_cancel", "sticker", "g_number", "srid",
    )


@query("normalized_sales")
def normalized_sales(spark, sf_dir):
    rows = normalize.normalize_sales(fx.sale_feed(spark, sf_dir))
    return rows.select(
        "account_id", "record_key", "sale_id", "sale_date", "last_change_date", "nm_id", "total_price",
        "for_pay", "spp", "srid",
    )


_SETTLEMENT_COLUMNS = [name for name, _ in fx.line_mapping(WEEKLY)]


@query("normalized_settlement")
def normalized_settlement(spark, sf_dir):
    return normalize.normalize_settlement(fx.settlement_feed(spark, sf_dir)).select(*_SETTLEMENT_COLUMNS)


@query("settlement_keys")
def settlement_keys(spark, sf_dir):
    feed = fx.settlement_feed(spark, sf_dir)
    return feed.groupBy("account_id", normalize.settlement_key().alias("row_key")).agg(
        F.count("*").alias("landed")
    )


def _said(path: str) -> Column:
    """What the kept source object says, read back from its text."""
    return F.get_json_object("raw_payload", path)


def _undeclared(name: str, column: str) -> list[Column]:
    """An undeclared number of the source object, and whether it is kept as a number and
    an undeclared null as a null."""
    return [
        _said(f"$.{name}").cast("double").alias(column),
        F.col("raw_payload").rlike(f'"{name}":[0-9]').alias("is_number"),
        F.col("raw_payload").contains('"note":null').alias("keeps_null"),
    ]


_SETTLEMENT_SAID = "sellerOperName string, retailPrice string, dateFrom string, more struct<a array<string>>, lineTax string"


@query("settlement_payload")
def settlement_payload(spark, sf_dir):
    rows = normalize.normalize_settlement(fx.settlement_feed(spark, sf_dir))
    # What the kept source object says, read back from its text in one pass.
    said = rows.withColumn("said", F.from_json("raw_payload", _SETTLEMENT_SAID))
    _, *kept = _undeclared("lineTax", "line_tax")
    return said.select(
        "account_id",
        "rrd_id",
        F.col("said.sellerOperName").alias("operation"),
        F.col("said.retailPrice").cast("decimal(18,6)").alias("retail_price"),
        F.to_timestamp("said.dateFrom").alias("date_from"),
        F.get("said.more.a", F.lit(1)).alias("more"),
        F.col("said.lineTax").cast("double").alias("line_tax"),
        *kept,
    )


_STOCK_SAID = (
    "shelf string, warehouse struct<warehouseName string>, warehouses array<struct<warehouseName string>>"
)


@query("stock_payload")
def stock_payload(spark, sf_dir):
    """The stock row, with its one warehouse beside all of them."""
    rows = normalize.normalize_stock(fx.stock_feed(spark, sf_dir))
    # What the kept source object says, read back from its text in one pass.
    said = rows.withColumn("said", F.from_json("raw_payload", _STOCK_SAID))
    _, *kept = _undeclared("shelf", "shelf")
    return said.select(
        "account_id",
        "barcode",
        "warehouse_position",
        F.col("said.warehouse.warehouseName").alias("warehouse"),
        F.get("said.warehouses", F.lit(0))["warehouseName"].alias("first_warehouse"),
        F.col("said.shelf").cast("double").alias("shelf"),
        *kept,
    )


@query("supply_payload")
def supply_payload(spark, sf_dir):
    return _payloads(spark, sf_dir).supplies.select(
        "account_id",
        "supply_key",
        "position",
        F.to_timestamp(_said("$.createDate")).alias("create_date"),
        _said("$.updatedDate").alias("updated"),
        *_undeclared("dock", "dock"),
    )


@query("goods_payload")
def goods_payload(spark, sf_dir):
    return _payloads(spark, sf_dir).goods.select(
        "account_id", "supply_key", "barcode", "quantity", _said("$.nmID").alias("nm"), *_undeclared("layer", "layer")
    )


@query("package_payload")
def package_payload(spark, sf_dir):
    return _payloads(spark, sf_dir).packages.select(
        "account_id",
        "supply_key",
        "position",
        "package_position",
        _said("$.quantity").alias("said_quantity"),
        *_undeclared("weight", "weight"),
    )


@query("normalized_stock")
def normalized_stock(spark, sf_dir):
    rows = normalize.normalize_stock(fx.stock_feed(spark, sf_dir))
    return rows.select(
        "account_id", "brand", "vendor_code", "nm_id", "barcode", "tech_size", "volume",
        "warehouse_name", "quantity", "warehouse_position",
    )


def _payloads(spark: SparkSession, sf_dir: str) -> supplies.Supplies:
    return supplies.normalize_payloads(fx.supply_feed(spark, sf_dir), ["position"])


@query("normalized_supplies")
def normalized_supplies(spark, sf_dir):
    return _payloads(spark, sf_dir).supplies.drop("raw_payload", "updated_at")


@query("normalized_supply_details")
def normalized_supply_details(spark, sf_dir):
    return _payloads(spark, sf_dir).details.select(
        "account_id", "supply_key", "supply_id", "preorder_id", "warehouse_id", "acceptance_cost", "quantity", "position"
    )


@query("normalized_supply_goods")
def normalized_supply_goods(spark, sf_dir):
    return _payloads(spark, sf_dir).goods.select(
        "account_id", "supply_key", "supply_id", "preorder_id", "barcode", "vendor_code", "nm_id", "need_kiz", "quantity"
    )


@query("normalized_supply_packages")
def normalized_supply_packages(spark, sf_dir):
    return _payloads(spark, sf_dir).packages.drop("raw_payload", "updated_at")


@query("normalized_package_barcodes")
def normalized_package_barcodes(spark, sf_dir):
    return _payloads(spark, sf_dir).barcodes.drop("raw_payload", "updated_at")


# ------------------------------------------------------------ loads


@query("upsert_orders")
def upsert_orders(spark, sf_dir):
    batch = normalize.normalize_orders(fx.order_feed(spark, sf_dir), fx.ORDER_ARRIVAL)
    latest = latest_per_key(batch, schemas.KEYS["orders"], fx.ORDER_ARRIVAL)
    return latest.select("account_id", "record_key", "last_change_date", "total_price", "g_number", "position")


@query("upsert_sales")
def upsert_sales(spark, sf_dir):
    batch = normalize.normalize_sales(fx.sale_feed(spark, sf_dir), fx.SALE_ARRIVAL)
    latest = latest_per_key(batch, schemas.KEYS["sales"], fx.SALE_ARRIVAL)
    return latest.select("account_id", "record_key", "last_change_date", "total_price", "for_pay", "nm_id")


@query("upsert_settlement")
def upsert_settlement(spark, sf_dir):
    batch = normalize.normalize_settlement(fx.settlement_feed(spark, sf_dir), fx.LINE_ARRIVAL)
    guarded = checks.require_not_null(batch, ["report_id", "rrd_id"])
    latest = latest_per_key(guarded, schemas.KEYS["settlement_weekly"], fx.LINE_ARRIVAL)
    return latest.select(*_SETTLEMENT_COLUMNS)


def _stock_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.accounts(spark, sf_dir).filter("id <> 5").select(F.col("id").alias("account_id"))


@query("stock_snapshot")
def stock_snapshot(spark, sf_dir):
    """Accounts 1-4 are reloaded, 4 with an empty payload; 5 keeps its rows."""
    feed = normalize.normalize_stock(fx.stock_feed(spark, sf_dir), [*fx.STOCK_ARRIVAL, "l_linestatus"])
    arrival = [*fx.STOCK_ARRIVAL, "warehouse_position"]
    keys = schemas.KEYS["stock"]
    columns = [*keys, "quantity", "brand", "vendor_code"]
    before = feed.filter("l_linestatus = 'F'").select(*columns)
    batch = feed.filter("l_linestatus <> 'F' and account_id <= 3")
    return replace_snapshot(before, batch, _stock_loaded(spark, sf_dir), keys, arrival)


@query("supplies_load")
def supplies_load(spark, sf_dir):
    """Supplies up to 1998 are stored, then those since 1997 are loaded."""
    # None of the tables compared below shows the source object.
    payloads = staged(fx.supply_feed(spark, sf_dir, "o_orderdate").drop("_raw"), "payloads")
    arrival = ["position"]

    def rows(condition: str) -> supplies.Supplies:
        return supplies.normalize_payloads(payloads.filter(condition), arrival)

    def bare(loaded: DataFrame, *extra: str) -> DataFrame:
        return loaded.drop("raw_payload", "updated_at", *extra)

    old = rows("o_orderdate < timestamp '1998-01-01 00:00:00'")
    stored = supplies.Supplies(
        bare(latest_per_key(old.supplies, ["account_id", "supply_key"], arrival), "position"),
        bare(latest_per_key(old.details, ["account_id", "supply_key"], arrival), "position"),
        bare(old.goods),
        bare(
            latest_per_key(old.packages, schemas.KEYS["supply_packages"], ["position", "package_position"]),
            "position", "package_position",
        ),
        bare(
            latest_per_key(
                old.barcodes, schemas.KEYS["supply_package_barcodes"],
                ["position", "package_position", "barcode_position"],
            ),
            "position", "package_position", "barcode_position",
        ),
    )
    return _supply_items(supplies.load_supplies(stored, rows("o_orderdate >= timestamp '1997-01-01 00:00:00'"), arrival))


def _supply_items(loaded: supplies.Supplies) -> DataFrame:
    """The five supply tables as rows of one shape."""
    items = {
        "supplies": F.col("phone"),
        "supply_details": F.col("acceptance_cost").cast("string"),
        "supply_goods": F.concat_ws("/", "barcode", "quantity"),
        "supply_packages": F.concat_ws("/", "package_code", "quantity"),
        "supply_package_barcodes": F.concat_ws("/", "package_code", "barcode", "quantity"),
    }
    parts = [
        table.select(F.lit(name).alias("table_name"), "account_id", "supply_key", items[name].alias("item"))
        for name, table in loaded.tables().items()
    ]
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    return merged


@query("supply_rows_processed")
def supply_rows_processed(spark, sf_dir):
    return supplies.rows_processed(fx.supply_feed(spark, sf_dir))


# ------------------------------------------------------------ incremental

# What an earlier run has seen: all up to a row in the middle of a day, of the
# accounts there were. The next run is offered the whole feed again.
FIRST_LOAD = (
    "account_id <> 5 and (row_at < timestamp '1998-01-01 00:00:00' "
    "or (row_at = timestamp '1998-01-01 00:00:00' and row_key <= 'S5'))"
)


def _feed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = normalize.normalize_orders(fx.order_feed(spark, sf_dir), fx.ORDER_ARRIVAL)
    return rows.withColumns(
        {"api_type": F.lit("orders"), "row_at": F.col("last_change_date"), "row_key": F.col("record_key")}
    )


def _feed_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.accounts(spark, sf_dir).select(
        F.col("id").alias("account_id"),
        F.lit("orders").alias("api_type"),
        F.lit(30).alias("lookback_days"),
        F.lit(10).alias("batch_limit"),
    )


def _cursors_after_first_load(rows: DataFrame) -> DataFrame:
    seen = rows.filter(FIRST_LOAD)
    start = seen.select(*cursor.FEED).distinct().selectExpr(
        "*", "cast(null as timestamp) as cursor_timestamp", "cast(null as string) as cursor_key"
    )
    return cursor.advance_cursor(start, seen, "row_at", "row_key")


@query("initial_cursor")
def initial_cursor(spark, sf_dir):
    return cursor.initial_cursor(fx.configs(spark, sf_dir), fx.feed_states(spark, sf_dir), at(NOW))


@query("cursor_filter")
def cursor_filter(spark, sf_dir):
    rows = _feed_rows(spark, sf_dir)
    later = cursor.rows_after_cursor(rows, _cursors_after_first_load(rows), "row_at", "row_key")
    return later.select("account_id", "row_key", "row_at", "position")


@query("cursor_advance")
def cursor_advance(spark, sf_dir):
    rows = _feed_rows(spark, sf_dir)
    before = _cursors_after_first_load(rows)
    later = cursor.rows_after_cursor(rows, before, "row_at", "row_key")
    return cursor.advance_cursor(before, later, "row_at", "row_key")


@query("load_progress")
def load_progress(spark, sf_dir):
    rows = _feed_rows(spark, sf_dir)
    before = _cursors_after_first_load(rows)
    later = cursor.rows_after_cursor(rows, before, "row_at", "row_key")
    advanced = cursor.advance_cursor(before, later, "row_at", "row_key")
    return cursor.progress_report(rows, advanced, _feed_limits(spark, sf_dir))


@query("incremental_load")
def incremental_load(spark, sf_dir):
    rows = _feed_rows(spark, sf_dir)
    columns = ["account_id", "record_key", "last_change_date", "total_price", "srid"]
    keys = schemas.KEYS["orders"]
    stored = latest_per_key(rows.filter(FIRST_LOAD), keys, fx.ORDER_ARRIVAL).select(*columns)
    later = cursor.rows_after_cursor(rows, _cursors_after_first_load(rows), "row_at", "row_key")
    return upsert(stored, later, keys, fx.ORDER_ARRIVAL)


def _settlement_cursors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Account n reads from May 1997 on, n months later; odd ones resume."""
    return fx.accounts(spark, sf_dir).selectExpr(
        "id as account_id",
        "timestamp'1997-05-03 22:30:00' + make_dt_interval(cast(id * 30 as int)) as cursor_timestamp",
        "case when id % 2 = 1 then '20000' when id = 2 then '' end as cursor_key",
    )


SETTLEMENT_NOW = "1998-03-05 21:30:00"


@query("settlement_window")
def settlement_window(spark, sf_dir):
    """Each line, and whether it lies in the window its account reads."""
    lines = fx.settlement_lines(spark, sf_dir, DAILY)
    first, last = cursor.settlement_window(F.col("cursor_timestamp"), at(SETTLEMENT_NOW))
    windows = _settlement_cursors(spark, sf_dir).select(
        "account_id", first.alias("window_start"), last.alias("window_end")
    )
    inside = F.col("date_from").between(F.col("window_start"), F.col("window_end"))
    return (
        lines.groupBy("account_id", "date_from")
        .agg(F.count("*").alias("lines"))
        .join(windows, "account_id")
        .withColumn("inside", inside)
    )


@query("settlement_resume")
def settlement_resume(spark, sf_dir):
    backlog = cursor.settlement_backlog(
        fx.settlement_lines(spark, sf_dir, DAILY), _settlement_cursors(spark, sf_dir), at(SETTLEMENT_NOW)
    )
    return backlog.select("account_id", "report_id", "rrd_id", "date_from")


@query("settlement_checkpoint")
def settlement_checkpoint(spark, sf_dir):
    cursors = _settlement_cursors(spark, sf_dir)
    lines = fx.settlement_lines(spark, sf_dir, DAILY)
    backlog = cursor.settlement_backlog(lines, cursors, at(SETTLEMENT_NOW))
    after = cursor.settlement_next_cursor(cursors, backlog, at(SETTLEMENT_NOW))
    marks = cursor.checkpoint(backlog).withColumnRenamed("cursor_key", "checkpoint_key")
    return after.join(marks, "account_id", "left")


# ------------------------------------------------------------ weekly reports


def _report_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports as listed: some without a creation date, some without a number."""
    lines = fx.settlement_lines(spark, sf_dir, WEEKLY)
    listed = lines.groupBy("account_id", "report_id").agg(
        F.min("date_from").alias("a"), F.max("date_to").alias("b"), F.max("create_date").alias("c")
    )
    iso = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    return listed.select(
        "account_id",
        F.expr("case when report_id % 37 > 0 then report_id end").alias("reportId"),
        iso("a").alias("dateFrom"),
        F.when(F.expr("report_id % 3 > 0"), iso("b")).alias("dateTo"),
        F.when(F.expr("report_id % 4 > 0"), iso("c")).otherwise(F.lit("")).alias("createDate"),
    )


def _stored_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports up to 1997 are stored; of account 2 none is."""
    lines = fx.settlement_lines(spark, sf_dir, WEEKLY)
    return lines.filter("date_from < timestamp '1997-01-01 00:00:00' and account_id <> 2")


@query("report_list")
def report_list(spark, sf_dir):
    first, last = cursor.lookback_window(at(SETTLEMENT_NOW), F.lit(300))
    return landed.reports_between(_report_list(spark, sf_dir), first, last)


@query("existing_reports")
def existing_reports(spark, sf_dir):
    listed = _report_list(spark, sf_dir).select("account_id", F.col("reportId").alias("report_id"))
    return reports.existing_reports(_stored_reports(spark, sf_dir), listed)


@query("missing_reports")
def missing_reports(spark, sf_dir):
    missing = reports.missing_reports(_report_list(spark, sf_dir), _stored_reports(spark, sf_dir))
    return reports.load_order(missing)


@query("report_lines")
def report_lines(spark, sf_dir):
    feed = fx.settlement_feed(spark, sf_dir)
    wanted = _report_list(spark, sf_dir).filter("dateTo is null")
    lines = landed.report_lines(feed, wanted)
    return lines.groupBy("account_id", "reportId").agg(F.count("*").alias("lines"))


@query("hydrate_reports")
def hydrate_reports(spark, sf_dir):
    """Paged lines, some without a report; whole reports exist from 1996 on."""
    columns = ["account_id", "report_id", "rrd_id"]
    lines = fx.settlement_lines(spark, sf_dir, WEEKLY).select(*columns, "date_from")
    numbered = F.expr("case when rrd_id % 31 > 0 then report_id end")
    pages = lines.select(
        "account_id", numbered.alias("report_id"), "rrd_id", F.expr("rrd_id % 7").alias("page")
    )
    whole = lines.filter("date_from >= timestamp '1996-01-01 00:00:00'").select(*columns)
    return reports.hydrate_reports(pages, whole)


@query("changed_since")
def changed_since(spark, sf_dir):
    changed = landed.changed_since(fx.order_feed(spark, sf_dir), at("1998-01-01 00:00:00"))
    return changed.groupBy("account_id").agg(F.count("*").alias("rows"))


@query("supplies_listed")
def supplies_listed(spark, sf_dir):
    listed = fx.supply_feed(spark, sf_dir).select("account_id", "position", "supply.*")
    days = [F.lit(d).cast("date") for d in ("1996-03-31", "1999-03-31")]
    return landed.supplies_created(listed, *days).select("account_id", "position", "supplyID", "statusID")


@query("supplies_assemble")
def supplies_assemble(spark, sf_dir):
    """First listing of each supply, with how much was fetched for it; nothing is
    found for supplies in state 5."""
    feed = fx.supply_feed(spark, sf_dir).select("account_id", "position", "supply", "details", "goods", "packages")
    feed = staged(feed, "supply-feed")
    listed = feed.select("account_id", "position", "supply.*")
    keyed = normalize.identify_supplies(feed, "supply.")
    fetched = keyed.filter("supply.statusID <> '5'")
    kept, details, goods, packages = supplies.assemble_supplies(
        listed,
        fetched.select("account_id", "supply_key", "details"),
        fetched.select("account_id", "supply_key", F.explode("goods").alias("good")),
        fetched.select("account_id", "supply_key", F.explode("packages").alias("package")),
        ["position"],
    )
    result = kept.select("account_id", "supply_key", "position")
    for name, rows in (("details", details), ("goods", goods), ("packages", packages)):
        counted = rows.groupBy("account_id", "supply_key").agg(F.count("*").alias(name))
        result = result.join(shuffled(counted), ["account_id", "supply_key"], "left").fillna(0, [name])
    return result


@query("first_listing")
def first_listing(spark, sf_dir):
    listed = fx.supply_feed(spark, sf_dir).select("account_id", "position", "supply.*")
    kept = first_per_key(normalize.identify_supplies(listed), ["account_id", "supply_key"], ["position"])
    return kept.select("account_id", "supply_key", "position", "phone")


# ------------------------------------------------------------ control


@query("feed_configs")
def feed_configs(spark, sf_dir):
    return control.feed_configs(fx.configs(spark, sf_dir), fx.shops(spark, sf_dir))


@query("feed_configs_orders")
def feed_configs_orders(spark, sf_dir):
    return control.feed_configs(
        fx.configs(spark, sf_dir), fx.shops(spark, sf_dir), api_type="orders"
    )


@query("feed_state")
def feed_state(spark, sf_dir):
    return control.feed_state(fx.feed_states(spark, sf_dir), 8, "orders")


@query("state_from_events")
def state_from_events(spark, sf_dir):
    return control.state_from_events(fx.run_events(spark, sf_dir))


@query("state_report")
def state_report(spark, sf_dir):
    return control.state_report(control.state_from_events(fx.run_events(spark, sf_dir)))


def _ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = control.run_ledger(fx.run_events(spark, sf_dir))
    return ledger.withColumn("id", F.expr("cast(substring(run_id, 5) as bigint)"))


@query("run_ledger")
def run_ledger(spark, sf_dir):
    return _ledger(spark, sf_dir)


@query("orphan_runs")
def orphan_runs(spark, sf_dir):
    """Runs that nothing has closed, and how the ledger shows them once they are."""
    log = fx.run_events(spark, sf_dir)
    closed = log.unionByName(control.interruptions(log, at(NOW)))
    found = control.run_ledger(closed).join(
        control.run_ledger(log).filter("status = 'running'").select("account_id", "api_type", "run_id"),
        ["account_id", "api_type", "run_id"],
        "left_semi",
    )
    return found.select("account_id", "api_type", "run_id", "started_at", "finished_at", "status", "error_message")


@query("recent_runs")
def recent_runs(spark, sf_dir):
    return control.recent_runs(_ledger(spark, sf_dir))


@query("load_counts")
def load_counts(spark, sf_dir):
    orders = normalize.normalize_orders(fx.order_feed(spark, sf_dir), fx.ORDER_ARRIVAL)
    sales = normalize.normalize_sales(fx.sale_feed(spark, sf_dir), fx.SALE_ARRIVAL)
    return control.load_counts(
        {
            "orders": latest_per_key(orders, schemas.KEYS["orders"], fx.ORDER_ARRIVAL),
            "sales": latest_per_key(sales, schemas.KEYS["sales"], fx.SALE_ARRIVAL),
            "settlement_daily": fx.settlement_lines(spark, sf_dir, DAILY),
        }
    )


@query("constraint_report")
def constraint_report(spark, sf_dir):
    configs = fx.configs(spark, sf_dir)
    shops = fx.shops(spark, sf_dir)
    sources = fx.price_sources(spark, sf_dir)
    orders = normalize.normalize_orders(fx.order_feed(spark, sf_dir))
    lines = normalize.normalize_settlement(fx.settlement_feed(spark, sf_dir))
    # Two checks read the lines: parse them once, keep the columns they need.
    lines = staged(lines.select("account_id", "report_id", "rrd_id", "kiz"), "checked-lines")
    numbers = ["schedule_seconds", "lookback_days", "batch_limit"]
    return checks.constraint_report(
        [
            checks.rule_violations(
                configs, "feed_configs", checks.api_type_rule() | checks.positive_rules(numbers)
            ),
            checks.rule_violations(
                sources,
                "price_sources",
                checks.source_type_rule(["product_page", "category_page"]) | checks.positive_rules(["schedule_seconds"]),
            ),
            checks.rule_violations(
                orders, "orders", checks.not_null_rules(["record_key", "last_change_date"])
            ),
            checks.rule_violations(
                lines, "settlement_weekly", checks.not_null_rules(["report_id", "rrd_id", "kiz"])
            ),
            checks.duplicate_keys(configs, "feed_configs", schemas.KEYS["feed_configs"]),
            checks.duplicate_keys(orders, "orders", schemas.KEYS["orders"]),
            checks.duplicate_keys(lines, "settlement_weekly", schemas.KEYS["settlement_weekly"]),
            checks.orphans(configs, "feed_configs", shops.filter("enabled")),
        ]
    )


# ------------------------------------------------------------ stored tables


@query("stored_orders")
def stored_orders(spark, sf_dir):
    """Two batches upserted into a Parquet table, the second one twice."""
    rows = normalize.normalize_orders(fx.order_feed(spark, sf_dir), fx.ORDER_ARRIVAL)
    path = new_run_dir(spark, "orders-table")
    keys = schemas.KEYS["orders"]
    tables.upsert_table(rows.filter("page <> 1"), path, keys, fx.ORDER_ARRIVAL)
    for _ in range(2):
        tables.upsert_table(rows.filter("page = 1"), path, keys, fx.ORDER_ARRIVAL)
    return tables.read_table(spark, path, "orders").select(
        "account_id", "record_key", "last_change_date", "total_price", "srid"
    )


@query("streamed_orders")
def streamed_orders(spark, sf_dir):
    """The order feed as a stream into an upserted table."""
    source = fx.table(spark, sf_dir, "orders")
    raw = spark.read.parquet(f"{sf_dir}/orders.parquet").schema
    # A pattern, because a stream does not accept the path of a single file.
    unbounded = spark.readStream.schema(raw).parquet(f"{sf_dir}/orders.parquet*")
    casts = {f.name: F.col(f.name).cast(source.schema[f.name].dataType) for f in raw.fields}
    folder = new_run_dir(spark, "orders-stream")
    run = feed_stream.start_load(
        fx.order_feed(spark, sf_dir, unbounded.withColumns(casts)),
        "orders",
        f"{folder}/table",
        f"{folder}/cursor",
        f"{folder}/checkpoint",
    )
    run.awaitTermination()
    return tables.read_table(spark, f"{folder}/table", "orders").select(
        "account_id", "record_key", "last_change_date", "total_price", "srid"
    )


@query("stored_sales")
def stored_sales(spark, sf_dir):
    """Sales in two loads, the first lines of orders last, with a compaction in between."""
    rows = normalize.normalize_sales(fx.sale_feed(spark, sf_dir), fx.SALE_ARRIVAL)
    path = new_run_dir(spark, "sales-table")
    for condition in ("l_linenumber > 1", "l_linenumber = 1"):
        tables.upsert_table(rows.filter(condition), path, schemas.KEYS["sales"], fx.SALE_ARRIVAL)
        if ">" in condition:
            tables.compact(spark, path, "sales")
    return tables.read_table(spark, path, "sales").select(
        "account_id", "record_key", "last_change_date", "total_price", "for_pay", "nm_id"
    )


@query("streamed_pages")
def streamed_pages(spark, sf_dir):
    """Landed JSON as a stream, two files a batch: the last page lands first."""
    folder = new_run_dir(spark, "pages-stream")
    feed = fx.order_feed(spark, sf_dir)
    for page in (2, 0, 1):
        feed.filter(F.col("page") == page).repartition(2).write.mode("append").json(f"{folder}/landed")
    run = feed_stream.start_load(
        landed.stream_feed(spark, f"{folder}/landed", "orders", max_files=2),
        "orders",
        f"{folder}/table",
        f"{folder}/cursor",
        f"{folder}/checkpoint",
    )
    run.awaitTermination()
    return tables.read_table(spark, f"{folder}/table", "orders").select(
        "account_id", "record_key", "last_change_date", "total_price", "srid"
    )


def _streamed_answers(
    spark: SparkSession, lines: DataFrame, feed: str, parts: Callable, folder: str
) -> None:
    """Lands ``lines`` (account_id, answer, value, late) and runs the stream three times: half
    of the second answers first, then the first answers, then the rest."""
    lines = staged(lines, "answer-lines")
    for landing in ("answer = 2 and not late", "answer = 1", "answer = 2 and late"):
        part = lines.filter(landing).select("account_id", "value")
        part.write.mode("append").partitionBy("account_id").text(f"{folder}/landed")
        source = answer_stream.stream_answers(spark, f"{folder}/landed", feed)
        answer_stream.start_answers(source, parts, f"{folder}/tables", f"{folder}/checkpoint").awaitTermination()


@query("streamed_stock")
def streamed_stock(spark, sf_dir):
    """Stock as a stream: the first answers name all accounts, the second 1-4, of which 4 has
    nothing left. They land in three parts, the older ones in the middle."""
    answer = "case when l_linestatus = 'F' then 1 when l_linestatus <> 'F' and l_orderkey % 5 + 1 <= 3 then 2 end"
    lines = fx.stock_lines(spark, sf_dir, answer).select(
        "account_id", "answer", "value", F.expr("answer = 2 and l_linenumber % 2 = 0").alias("late")
    )
    emptied = spark.range(1).select(
        F.lit(4).cast("bigint").alias("account_id"), F.lit(2).alias("answer"),
        F.lit('{"answer":2}').alias("value"), F.lit(True).alias("late"),
    )
    folder = new_run_dir(spark, "stock-stream")
    _streamed_answers(spark, lines.unionByName(emptied), "warehouse_remains", answer_stream.stock_parts, folder)
    return answer_stream.read_stock(spark, f"{folder}/tables").select(
        *schemas.KEYS["stock"], "quantity", "brand", "vendor_code"
    )


@query("streamed_supplies")
def streamed_supplies(spark, sf_dir):
    """Supplies as a stream: those up to 1998 in the first answers, those since 1997 in the
    second, which land in two parts around the first."""
    answers = (
        "filter(array(case when o_orderdate < timestamp '1998-01-01 00:00:00' then 1 end, "
        "case when o_orderdate >= timestamp '1997-01-01 00:00:00' then 2 end), a -> a is not null)"
    )
    lines = fx.supply_lines(spark, sf_dir, answers, "answer = 2 and o_custkey % 2 = 0")
    folder = new_run_dir(spark, "supplies-stream")
    _streamed_answers(spark, lines, "supply_payloads", answer_stream.supply_parts, folder)
    return _supply_items(answer_stream.read_supplies(spark, f"{folder}/tables"))


# ------------------------------------------------------------ runs


def _run_configs(spark: SparkSession, sf_dir: str, api_type: str) -> DataFrame:
    return _feed_limits(spark, sf_dir).withColumns(
        {"api_type": F.lit(api_type), "enabled": F.lit(True), "lookback_days": F.lit(20000)}
    )


def _numbered_runs(store: Store) -> DataFrame:
    """The ledger, with the number of each run of an account."""
    order = Window.partitionBy("account_id").orderBy("started_at")
    return control.run_ledger(store.read("run_events")).withColumn("number", F.row_number().over(order))


def _run_rows(store: Store) -> list[DataFrame]:
    """Ledger and state as rows of one shape: part, account_id, item, status, moment, a, b, c."""
    nothing = F.lit(None).cast("double")
    ledger = _numbered_runs(store).select(
        F.lit("run").alias("part"), "account_id", F.col("number").cast("string").alias("item"), "status",
        F.col("finished_at").alias("moment"), F.col("rows_written").cast("double").alias("a"), nothing.alias("b"), nothing.alias("c"),
    )
    state = runs.current_state(store).select(
        F.lit("state"), "account_id", "cursor_key", "status", "cursor_timestamp", nothing, nothing, nothing
    )
    return [ledger, state]


def _stored_row(part: str, item: Column, status: Column, moment: Column, *amounts: str) -> list[Column]:
    """A stored row in the shape of ``_run_rows``."""
    numbers = [F.col(name).cast("double") for name in amounts]
    return [
        F.lit(part), F.col("account_id"), item, status, moment,
        *numbers, *[F.lit(None).cast("double")] * (3 - len(numbers)),
    ]


def _stored_order() -> list[Column]:
    return _stored_row(
        "order", F.col("record_key"), F.col("srid"), F.col("last_change_date"), "total_price", "finished_price", "nm_id"
    )


def _stored_line() -> list[Column]:
    return _stored_row(
        "line", F.concat_ws(":", "report_id", "rrd_id"), F.col("seller_oper_name"), F.col("date_from"),
        "for_pay", "quantity", "delivery_service",
    )


def _arriving(feed: DataFrame) -> DataFrame:
    """Settlement lines with page and position: of the rows of a key the one that counts
    arrives last."""
    return feed.withColumns(
        {
            "page": F.round(F.col("l_extendedprice") * 100).cast("bigint"),
            "position": F.col("l_partkey") * 1_000_000 + F.col("l_suppkey"),
        }
    )


@query("change_runs")
def change_runs(spark, sf_dir):
    """Three runs over one growing folder: orders before 1997, where every row of account 4
    lacks its date; then all; then nothing new, though far above the batch limit."""
    store = Store(spark, new_run_dir(spark, "change-runs"))
    feed = fx.order_feed(spark, sf_dir)
    dateless = F.expr("if(account_id = 4, null, lastChangeDate)")
    early = feed.filter(feed_instant(F.col("lastChangeDate")) < at("1997-01-01 00:00:00"))
    configs = _run_configs(spark, sf_dir, "orders")
    offered = (early.withColumn("lastChangeDate", dateless), feed, feed)
    for minute, landed_rows in enumerate(offered):
        runs.run_changes(store, landed_rows, configs, "orders", at(f"2026-06-01 12:0{minute}:00"))
    return reduce(DataFrame.unionAll, [*_run_rows(store), store.read("orders").select(*_stored_order())])


@query("weekly_run")
def weekly_run(spark, sf_dir):
    """Reports of even number, then all: the second run loads the others alone."""
    store = Store(spark, new_run_dir(spark, "weekly-run"))
    feed = _arriving(fx.settlement_feed(spark, sf_dir, once=True))
    listed = feed.groupBy("account_id", "reportId").agg(
        F.min("dateFrom").alias("dateFrom"), F.max("dateTo").alias("dateTo"), F.max("createDate").alias("createDate")
    )
    listed = staged(listed, "report-list")
    configs = _run_configs(spark, sf_dir, "finance_sales_report_weekly")
    for minute, reports_listed in enumerate((listed.filter("reportId % 2 = 0"), listed)):
        runs.run_weekly(store, reports_listed, feed, configs, at(f"2026-06-01 12:0{minute}:00"))
    return reduce(DataFrame.unionAll, [*_run_rows(store), store.read("settlement_weekly").select(*_stored_line())])


@query("stock_run")
def stock_run(spark, sf_dir):
    """All accounts are answered once, then accounts 1-4, of which 4 has nothing left."""
    store = Store(spark, new_run_dir(spark, "stock-run"))
    feed = fx.arriving_stock_feed(spark, sf_dir)
    configs = _run_configs(spark, sf_dir, "warehouse_remains")
    everyone = configs.select("account_id")
    runs.run_stock(store, feed.filter("l_linestatus = 'F'"), everyone, configs, at(NOW))
    later = feed.filter("l_linestatus <> 'F' and account_id <= 3")
    runs.run_stock(store, later, everyone.filter("account_id <> 5"), configs, at("2026-06-02 12:00:00"))
    names = F.concat_ws(":", "nm_id", "barcode", "tech_size", "warehouse_name")
    kind = F.concat_ws("/", "brand", "vendor_code")
    stored = _stored_row("stock", names, kind, F.lit(None).cast("timestamp"), "quantity")
    return reduce(DataFrame.unionAll, [*_run_rows(store), store.read("stock").select(*stored)])


@query("supplies_run")
def supplies_run(spark, sf_dir):
    """The supplies of the list since 1995, with what was fetched for each."""
    store = Store(spark, new_run_dir(spark, "supplies-run"))
    feed = fx.supply_feed(spark, sf_dir).withColumn("page", F.lit(0).cast("bigint"))
    arrival = ["account_id", "page", "position"]
    keyed = normalize.identify_supplies(feed, "supply.").select(*arrival, "supply_key", "details", "goods", "packages")
    days = F.datediff(F.lit(NOW).cast("date"), F.lit("1995-01-01").cast("date"))
    configs = _run_configs(spark, sf_dir, "fbw_supplies").withColumn("lookback_days", days)
    runs.run_supplies(
        store,
        feed.select(*arrival, "supply.*"),
        keyed.filter("details is not null").select(*arrival, "supply_key", "details.*"),
        keyed.select(*arrival, "supply_key", F.inline("goods")),
        keyed.select(*arrival, "supply_key", F.inline("packages")),
        configs,
        at(NOW),
    )
    loaded = supplies.Supplies(
        *(store.read(f"supply_{name}" if name else "supplies") for name in ("", "details", "goods", "packages", "package_barcodes"))
    )
    items = _supply_items(loaded).select(
        F.col("table_name").alias("part"), "account_id", "supply_key", "item", F.lit(None).cast("timestamp"),
        *[F.lit(None).cast("double")] * 3,
    )
    return reduce(DataFrame.unionAll, [*_run_rows(store), items])


class _Killed(BaseException):
    """Ends a run as the loss of its driver does: nothing more is logged."""


@query("settlement_run")
def settlement_run(spark, sf_dir):
    """Three runs over one growing folder. The first, over the lower half of the line
    numbers, is killed between lines and facts. The second goes on behind its checkpoint; of
    account 4 it finds a line without a date. The third finds all in order: only account
    4 has lines to read. Ledger, state, stored lines and facts."""
    store = Store(spark, new_run_dir(spark, "settlement-run"))
    fx.accounts(spark, sf_dir).select(
        *(F.col(n) if n in ("id", "account_code", "account_name", "enabled", "token_env_var") else F.lit(None).alias(n)
          for n in schemas.ACCOUNTS.names)
    ).select(*(F.col(f.name).cast(f.dataType) for f in schemas.ACCOUNTS.fields)).write.parquet(store.path("accounts"))
    feed = _arriving(fx.settlement_feed(spark, sf_dir, DAILY, once=True))
    half = fx.table(spark, sf_dir, "lineitem").agg(F.expr("max(l_orderkey) div 2 * 10").alias("half"))
    feed = feed.crossJoin(F.broadcast(half))
    configs = _run_configs(spark, sf_dir, "finance_sales_report_details")
    no_date = F.expr("if(account_id = 4, null, dateFrom)")
    offered = (feed.filter("rrdId <= half"), feed.withColumn("dateFrom", no_date), feed)

    def killed(*_, **__):
        raise _Killed

    for minute, landed_rows in enumerate(offered):
        steps = {"load_facts": killed} if minute == 0 else {}
        with contextlib.suppress(_Killed):
            runs.run_settlement(store, landed_rows.drop("half"), configs, at(f"2026-06-01 12:0{minute}:00"), **steps)
    lines = store.read("settlement_daily").select(*_stored_line())
    nothing = F.lit(None).cast("timestamp")
    amounts = ("buyout_ratio_sum", "logistics_cost_total", "buyout_units")
    fact = _stored_row("fact", F.col("nm_id").cast("string"), F.col("vendor_code"), nothing, *amounts)
    found = store.read("article_facts").select(*fact)
    return reduce(DataFrame.unionAll, [*_run_rows(store), lines, found])


@query("quarantine_runs")
def quarantine_runs(spark, sf_dir):
    """Two runs over a landed folder of orders. In the first, lines of account 2 are cut off
    and lines of account 4 are no objects: these accounts fail, the others are stored. The
    second finds them mended."""
    store = Store(spark, new_run_dir(spark, "quarantine-runs"))
    text = staged(fx.order_lines(spark, sf_dir), "order-lines")
    cut = F.when(F.expr("account_id = 2 and position % 50 = 0"), F.expr("left(value, length(value) - 4)"))
    cut = cut.when(F.expr("account_id = 4 and position % 100 = 1"), F.lit("[7]")).otherwise(F.col("value"))
    configs = _run_configs(spark, sf_dir, "orders")
    for minute, lines in enumerate((text.withColumn("value", cut), text)):
        folder = f"{store.root}-landed-{minute}"
        lines.select("account_id", "value").write.partitionBy("account_id").text(folder)
        feed = landed.read_feed(spark, folder, "orders", keep_broken=True)
        runs.run_changes(store, feed, configs, "orders", at(f"2026-06-01 12:0{minute}:00"))
    return reduce(DataFrame.unionAll, [*_run_rows(store), store.read("orders").select(*_stored_order())])


def _updated_store(spark: SparkSession, sf_dir: str) -> Store:
    """Lines loaded with what is derived from them kept up to date, in three loads: lines 1
    to 5 of orders, of which some carry another code, article and amount; lines 6 and 7;
    those lines as they should be."""
    store = Store(spark, new_run_dir(spark, "updates"))
    lines = fx.settlement_lines(spark, sf_dir, DAILY).withColumns(
        {"page": F.lit(0).cast("bigint"), "position": F.col("rrd_id")}
    )
    lines = staged(lines, "all-lines")
    changing = F.expr("rrd_id div 10 % 3 = 0 and rrd_id % 10 in (1, 2)")
    wrong = {
        "kiz": F.when(changing, F.expr("if(rrd_id % 10 = 1, 'OLD' || rrd_id div 20, null)")).otherwise(F.col("kiz")),
        "nm_id": F.when(changing, F.col("nm_id") + 1).otherwise(F.col("nm_id")),
        "delivery_amount": F.when(changing, F.col("delivery_amount") + 2).otherwise(F.col("delivery_amount")).cast("decimal(18,6)"),
    }
    early = lines.filter("rrd_id % 10 <= 5").withColumns(wrong)
    for batch in (early, lines.filter("rrd_id % 10 > 5"), lines.filter(changing)):
        load_identified_lines(store, batch)
    return store


@query("identity_update")
def identity_update(spark, sf_dir):
    """The units of lines, resolved again only where a load changed an identifier."""
    store = _updated_store(spark, sf_dir)
    found = store.read("settlement_daily").join(store.read("line_units"), identity.LINE_KEY)
    return found.select(
        "account_id", "report_id", "rrd_id", "nm_id", "seller_oper_name", "kiz", "srid", "order_id", "order_uid",
        "shk_id", "restored_kiz", "uniq_product_id",
    )


@query("facts_update")
def facts_update(spark, sf_dir):
    """Article facts from totals of units that three loads kept up to date."""
    store = _updated_store(spark, sf_dir)
    return facts.article_facts(
        store.read("settlement_daily"), fx.accounts(spark, sf_dir), fact_day(), per_article=store.read("article_units")
    )


@query("state_stream")
def state_stream(spark, sf_dir):
    """Feed states from a stream of run events that is stopped and goes on when more came."""
    folder = new_run_dir(spark, "state-stream")
    log = fx.run_events(spark, sf_dir).selectExpr(
        *(f"cast({f.name} as {f.dataType.simpleString()}) as {f.name}" for f in schemas.RUN_EVENTS.fields)
    )
    log = staged(log, "run-events")
    for part in ("seq % 3 = 1", "seq % 3 <> 1"):
        log.filter(part).write.mode("append").parquet(f"{folder}/events")
        events = state_events.event_stream(spark, f"{folder}/events")
        run = state_events.start_state(events, f"{folder}/table", f"{folder}/checkpoint")
        run.awaitTermination()
    return tables.read_table(spark, f"{folder}/table", "feed_state")
