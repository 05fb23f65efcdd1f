"""The test tables, seen as a seller's data.

Every mapping is a list of (column, expression) pairs in SQL that Spark and DuckDB
both read, so queries and their reference SQL start from the same rows. Landed
feeds are built on top as JSON text, the form they arrive in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlens import configure
from marketlens.functions import operations as op
from marketlens.session import staged
from marketlens.sources.landed import WITH_PAYLOAD, parse_payload

Mapping = list[tuple[str, str]]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; its zone-less timestamps are UTC."""
    rows = configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")
    naive = {
        f.name: F.col(f.name).cast("timestamp")
        for f in rows.schema.fields
        if isinstance(f.dataType, T.TimestampNTZType)
    }
    return rows.withColumns(naive) if naive else rows


# Up to 200 tasks a shuffle writes rows as they come and need not hold them.
_ROWS_PER_TASK, _MOST_TASKS = 100_000, 200


def spread(rows: DataFrame, count: int | None = None, by: str | None = None) -> DataFrame:
    """Source rows (``count`` of them) over all cores, since parsing is the cost here and
    a file may be too small to split; over more tasks where there are more rows. ``by`` is a
    column that differs much, where rows are joined by it next; else they go in turn."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    tasks = 1 + (rows.count() if count is None else count) // _ROWS_PER_TASK
    return rows.repartition(max(cores, min(tasks, _MOST_TASKS)), *([by] if by else []))


def project(rows: DataFrame, mapping: Mapping, *keep: str) -> DataFrame:
    return rows.selectExpr(*[f"{expr} as {name}" for name, expr in mapping], *keep)


# ------------------------------------------------------------ settlement lines

# A settlement line with the key of an earlier one replaces it; the last of a
# key in this order is the one that counts.
LINE_KEY = "l_orderkey*10+l_linenumber"
LINE_ARRIVAL = ["l_extendedprice", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax"]


def line_mapping(period: str) -> Mapping:
    """``period`` is week or day: how lines are cut into reports."""
    start = f"date_trunc('{period}', l_shipdate)"
    open_hours = {"week": 158, "day": 14}[period]
    net = "cast(l_extendedprice as decimal(12,2)) * cast(1 - l_discount as decimal(4,2))"

    def money(expr: str) -> str:
        return f"cast({expr} as decimal(18,6))"

    return [
        ("account_id", "cast(l_orderkey % 5 + 1 as bigint)"),
        ("report_id", f"cast(year({start})*10000+month({start})*100+day({start}) as bigint)"),
        ("rrd_id", f"cast({LINE_KEY} as bigint)"),
        ("date_from", f"cast({start} as timestamp)"),
        ("date_to", f"cast({start} as timestamp) + interval '{open_hours}' hour"),
        ("create_date", f"cast({start} as timestamp) + interval '{open_hours + 20}' hour"),
        ("currency", "case when l_orderkey % 23 = 0 then 'KZT' else 'RUB' end"),
        ("report_type", "case when l_orderkey % 23 = 0 then 2 else 1 end"),
        ("nm_id", "cast(o_custkey % 50 + case when l_linenumber = 7 then 2 else 1 end as bigint)"),
        (
            "sku",
            "case when l_partkey % 20 = 0 then '' when l_partkey % 21 = 0 then null "
            "else 'SKU' || cast(l_partkey % 40 as string) end",
        ),
        (
            "vendor_code",
            "case when l_partkey % 10 = 0 then '' else 'VC' || cast(l_partkey % 53 as string) end",
        ),
        ("brand_name", "'B' || cast(l_partkey % 7 as string)"),
        ("title", "'T' || cast(l_partkey % 40 as string)"),
        ("tech_size", "case when l_partkey % 3 = 0 then '' else cast(l_partkey % 5 as string) end"),
        (
            "seller_oper_name",
            f"case when l_returnflag = 'R' then '{op.RETURN}' when l_linenumber <= 3 then '{op.SALE}' "
            "when l_linenumber = 4 then 'Логистика' "
            f"when l_linenumber = 5 then '{op.VOLUNTARY_RETURN_COMPENSATION}' "
            f"when l_linenumber = 6 and l_linestatus = 'F' then '{op.LOYALTY_COMPENSATION}' "
            f"when l_linenumber = 6 then '{op.ACQUIRING_ADJUSTMENT}' "
            f"when l_linestatus = 'F' then '{op.RETURNS_CORRECTION}' "
            f"else '{op.SALES_CORRECTION}' end",
        ),
        ("quantity", "cast(l_quantity as bigint)"),
        ("retail_price", money("l_extendedprice")),
        ("retail_price_with_disc", money(net)),
        ("retail_amount", money(net)),
        ("for_pay", money("cast(l_extendedprice as decimal(12,2)) * cast(0.85 as decimal(4,2))")),
        ("delivery_amount", money("case when l_linenumber <= 4 then 1 else 0 end")),
        ("return_amount", money("case when l_returnflag = 'R' then 1 else 0 end")),
        (
            "delivery_service",
            money("case when l_linenumber in (5,6) then 0 else cast(l_tax as decimal(4,2)) * 1000 end"),
        ),
        ("paid_storage", money("case when l_linenumber = 5 then 10 else 0 end")),
        ("deduction", money("case when l_linenumber = 6 then 5.5 end")),
        ("penalty", money("case when l_orderkey % 17 = 0 then 100 else 0 end")),
        ("additional_payment", money("case when l_orderkey % 19 = 0 then 25 end")),
        ("paid_acceptance", money("case when l_linenumber = 7 then 3 else 0 end")),
        (
            "cashback_amount",
            money("case when l_linenumber = 1 then 1.25 when l_linenumber = 2 then null else 0 end"),
        ),
        ("cashback_discount", money("case when l_linenumber = 6 then 7.75 else 0 end")),
        ("cashback_commission_change", money("case when l_linenumber = 3 then 0.5 else 0 end")),
        ("order_dt", "case when l_linenumber = 5 then null else o_orderdate end"),
        ("sale_dt", "case when l_returnflag = 'N' and l_linenumber > 3 then null else l_shipdate end"),
        ("rr_date", "case when l_linenumber = 2 then null else l_shipdate end"),
        (
            "kiz",
            "case when l_linenumber = 1 and l_orderkey % 2 = 0 then 'KIZ' || cast(l_orderkey as string) "
            "when l_linenumber = 2 and l_orderkey % 10 = 0 "
            "then 'KIZ' || cast(l_orderkey as string) || 'B' when l_linenumber = 3 then '' end",
        ),
        (
            "srid",
            "case when l_linenumber in (1,3,5) then 'S' || cast(l_orderkey as string) "
            "when l_linenumber = 2 then '' when l_linenumber = 6 and l_orderkey % 4 = 0 "
            "then 'S' || cast(l_orderkey + 10 as string) end",
        ),
        ("order_id", "case when l_linenumber in (1,2,4) then l_orderkey end"),
        (
            "order_uid",
            "case when l_linenumber in (1,6) then 'U' || cast(l_orderkey as string) else '' end",
        ),
        ("shk_id", "case when l_linenumber in (3,7) and l_orderkey % 4 <> 0 then l_orderkey * 100 end"),
    ]


_LINE_SOURCE = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]


def _with_orders(spark: SparkSession, sf_dir: str, lines: DataFrame) -> DataFrame:
    heads = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return lines.join(heads, F.col("l_orderkey") == F.col("o_orderkey"))


def _single_lines(spark: SparkSession, sf_dir: str, period: str) -> DataFrame:
    """Source rows of stored lines, one per key, with their orders. Repeats are removed
    on the narrow rows, before the join and before the forty columns exist."""
    source = table(spark, sf_dir, "lineitem").select(*_LINE_SOURCE)
    key = [F.expr(LINE_KEY), F.date_trunc(period, F.col("l_shipdate"))]
    one_digit = F.coalesce(F.col("l_linenumber").between(0, 9), F.lit(False))
    if source.filter(~one_digit).isEmpty():
        # Then rows of one key are of one order, and one shuffle serves grouping and join.
        source, key = source.repartition("l_orderkey"), ["l_orderkey", *key]
    window = Window.partitionBy(*key).orderBy(*[F.desc(c) for c in LINE_ARRIVAL])
    single = source.withColumn("rn", F.row_number().over(window)).filter("rn = 1").drop("rn")
    return _with_orders(spark, sf_dir, single)


def settlement_lines(spark: SparkSession, sf_dir: str, period: str = "week") -> DataFrame:
    """Stored settlement lines, one per key."""
    return project(_single_lines(spark, sf_dir, period), line_mapping(period))


def settlement_lines_once(spark: SparkSession, sf_dir: str, period: str = "week") -> DataFrame:
    """The same for plans that read the lines several times: repeats and orders are seen to
    once and the narrow rows are staged, of which each reader makes the columns it needs."""
    narrow = _single_lines(spark, sf_dir, period).drop("o_orderkey")
    return project(staged(narrow, "settlement-lines"), line_mapping(period))


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project(table(spark, sf_dir, "region"), ACCOUNTS)


ACCOUNTS: Mapping = [
    ("id", "cast(r_regionkey + 1 as bigint)"),
    ("account_code", "'shop_' || cast(r_regionkey + 1 as string)"),
    ("account_name", "'Seller ' || cast(r_regionkey + 1 as string)"),
    ("enabled", "r_regionkey <> 4"),
    ("token_env_var", "'TOKEN_' || cast(r_regionkey + 1 as string)"),
]


def costs(spark: SparkSession, sf_dir: str, legacy: bool = False) -> DataFrame:
    rows = project(table(spark, sf_dir, "part"), LEGACY_COSTS if legacy else COSTS)
    return rows


def _cost_mapping(account: str) -> Mapping:
    start = "cast(date '2000-01-01' + cast(p_partkey % 1000 as int) as timestamp)"
    return [
        ("id", "p_partkey"),
        ("account_id", account),
        ("vendor_code", "'VC' || cast(p_partkey % 53 as string)"),
        ("cost", "cast(p_retailprice as decimal(18,6))"),
        ("valid_from", start),
        ("valid_to", f"case when p_size % 7 = 0 then {start} + interval '240' hour end"),
    ]


COSTS = _cost_mapping("cast(p_partkey % 5 + 1 as bigint)")
LEGACY_COSTS = _cost_mapping(
    "case when p_partkey % 3 = 0 then null else cast(p_partkey % 5 + 1 as bigint) end"
)

# ------------------------------------------------------------ landed feeds


def _iso(column: str) -> str:
    return f"date_format({column}, \"yyyy-MM-dd'T'HH:mm:ss\")"


# What feeds send beyond their declared fields: text put before a declared one.
_UNDECLARED = {
    "finance_sales_report_details": {
        "rrdId": """'"note":null,"lineTax":' || cast(cast(l_tax as decimal(4,2)) as string) || ',"more":{"a":[1,"x"]},'""",
    },
    "warehouse_remains": {"barcode": """'"note":null,"shelf":' || cast(l_linenumber as string) || ','"""},
    "supply_payloads": {
        "statusID": """'"note":null,"dock":' || cast(o_custkey % 9 as string) || ','""",
        "needKiz": """'"note":null,"layer":' || cast(o_custkey % 5 as string) || ','""",
        "packageCode": """'"note":null,"weight":' || cast(o_custkey % 8 as string) || '.5,'""",
    },
}


def landed_text(rows: DataFrame, mapping: Mapping, feed: str, *keep: str) -> DataFrame:
    """Each feed object as JSON text in ``payload``, the form it arrives in."""
    fields = ", ".join(f"'{name}', {expr}" for name, expr in mapping)
    text = f"to_json(named_struct({fields}))"
    for name, more in _UNDECLARED.get(feed, {}).items():
        text = f"replace({text}, '\"{name}\":', {more} || '\"{name}\":')"
    return rows.selectExpr(*keep, f"{text} as payload")


def _landed(rows: DataFrame, mapping: Mapping, feed: str, *keep: str, once: bool = False) -> DataFrame:
    """Build each feed object as JSON text, then parse it as a landed line is. ``rows``
    should be spread: parsing takes place where they are. With ``once`` the text is staged,
    for runs that read the feed several times; each parses what it reads."""
    text = landed_text(rows, mapping, feed, *keep)
    if once:
        text = staged(text, "landed-text")
    # Unfolded as a one-row array: conditions on the fields are then checked after
    # the parse, not by parsing once more below it.
    parsed = F.inline(F.array(parse_payload(F.col("payload"), feed)))
    raw = [F.parse_json("payload").alias("_raw")] if feed in WITH_PAYLOAD else []
    return text.select(*[k.split(" as ")[-1] for k in keep], *raw, parsed)


# The three ways a date may be written, by order number.
_ORDER_FEED: Mapping = [
    (
        "date",
        f"{_iso('o_orderdate')} || case o_orderkey % 3 when 0 then 'Z' when 1 then '' else '+05:00' end",
    ),
    ("lastChangeDate", f"{_iso('o_orderdate')} || 'Z'"),
    ("cancelDate", f"case when o_orderkey % 11 = 0 then {_iso('o_orderdate')} else '0001-01-01T00:00:00' end"),
    ("isCancel", "o_orderkey % 11 = 0"),
    ("nmId", "o_custkey % 50 + 1"),
    ("warehouseName", "'W' || cast(o_custkey % 7 as string)"),
    ("totalPrice", "cast(o_totalprice as decimal(18,2))"),
    ("finishedPrice", "cast(cast(o_totalprice as decimal(18,2)) * 0.905 as decimal(18,5))"),
    ("discountPercent", "case when o_orderkey % 13 = 0 then '' else cast(o_orderkey % 40 as string) end"),
    ("srid", "case when o_orderkey % 7 = 0 then '' else 'S' || cast(o_orderkey as string) end"),
    ("gNumber", "case when o_orderkey % 49 <> 0 then 'G' || cast(o_orderkey % 100 as string) end"),
    ("newField", "'not in the schema'"),
]
ORDER_ARRIVAL = ["page", "position"]


def order_feed(spark: SparkSession, sf_dir: str, rows: DataFrame | None = None) -> DataFrame:
    source = spread(table(spark, sf_dir, "orders")) if rows is None else rows
    return _landed(
        source,
        _ORDER_FEED,
        "orders",
        "cast(o_custkey % 5 + 1 as bigint) as account_id",
        "cast(o_orderkey % 3 as bigint) as page",
        "o_orderkey as position",
    )


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as lines of a landed folder: account_id, position, value."""
    arrival = [("page", "o_orderkey % 3"), ("position", "o_orderkey")]
    keep = ["cast(o_custkey % 5 + 1 as bigint) as account_id", "o_orderkey as position"]
    rows = spread(table(spark, sf_dir, "orders"))
    return landed_text(rows, arrival + _ORDER_FEED, "orders", *keep).withColumnRenamed("payload", "value")


_SALE_FEED: Mapping = [
    ("saleID", "case when l_linenumber <= 4 then 'S' || cast(l_orderkey as string) when l_linenumber = 5 then '' end"),
    ("srid", "'R' || cast(l_orderkey as string)"),
    ("date", f"{_iso('l_shipdate')}"),
    ("lastChangeDate", f"{_iso('l_shipdate')}"),
    ("nmId", "l_partkey"),
    ("forPay", "cast(cast(l_extendedprice as decimal(12,2)) * 0.85 as decimal(14,4))"),
    ("totalPrice", "cast(l_extendedprice as decimal(12,2))"),
    ("spp", "cast(l_discount as decimal(4,2)) * 100"),
]
SALE_ARRIVAL = ["l_linenumber", "l_extendedprice", "l_partkey", "l_suppkey", "l_shipdate"]


def sale_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _landed(
        spread(table(spark, sf_dir, "lineitem")),
        _SALE_FEED,
        "sales",
        "cast(l_orderkey % 5 + 1 as bigint) as account_id",
        *SALE_ARRIVAL,
    )


def settlement_feed(spark: SparkSession, sf_dir: str, period: str = "week", once: bool = False) -> DataFrame:
    """Settlement lines as landed: keys repeat, blanks are blanks. ``once``: see ``_landed``."""
    source = table(spark, sf_dir, "lineitem").select(*_LINE_SOURCE)
    # Spread while rows are narrow, before the forty columns exist, and by the order, so that
    # orders too many to broadcast are joined without moving the lines once more.
    narrow = _with_orders(spark, sf_dir, spread(source, by="l_orderkey"))
    typed = project(narrow, line_mapping(period), *LINE_ARRIVAL)
    words = {name: name.split("_") for name, _ in line_mapping(period)}
    camel = {n: w[0] + "".join(p.capitalize() for p in w[1:]) for n, w in words.items()}
    dates = {"date_from", "date_to", "create_date", "order_dt", "sale_dt", "rr_date"}
    fields = [
        (camel[n], f"{_iso(n)} || 'Z'" if n in dates else n) for n in words if n != "account_id"
    ]
    return _landed(typed, fields, "finance_sales_report_details", "account_id", *LINE_ARRIVAL, once=once)


# The last field of a stock row: none, one or two warehouses, one of them unnamed.
_STOCK_FEED: Mapping = [
    ("brand", "'B' || cast(l_partkey % 7 as string)"),
    ("vendorCode", "'VC' || cast(l_partkey % 53 as string)"),
    ("nmId", "case when l_partkey % 97 <> 0 then l_partkey % 500 end"),
    ("barcode", "'BC' || cast(l_partkey % 500 as string)"),
    ("techSize", "cast(l_partkey % 5 as string)"),
    ("volume", "cast(l_tax as decimal(4,2))"),
    (
        "warehouses",
        "slice(array("
        "named_struct('warehouseName', 'W' || cast(l_suppkey % 7 as string), 'quantity', cast(l_quantity as int)), "
        "named_struct('warehouseName', case when l_suppkey % 3 > 0 then 'W' || cast(l_suppkey % 7 + l_suppkey % 3 - 1 as string) end, "
        "'quantity', case when l_quantity > 5 then cast(l_quantity as int) + 1 end)"
        "), 1, l_linenumber % 3)",
    ),
]
STOCK_ARRIVAL = ["l_orderkey", "l_linenumber", "l_extendedprice", "l_partkey", "l_suppkey", "l_shipdate"]


_STOCK_KEEP = ["cast(l_orderkey % 5 + 1 as bigint) as account_id", "l_linestatus", *STOCK_ARRIVAL]


def stock_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _landed(spread(table(spark, sf_dir, "lineitem")), _STOCK_FEED, "warehouse_remains", *_STOCK_KEEP)


def _stock_arriving(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source rows of the stock feed with page and position, which are numbered while
    rows are narrow."""
    source = table(spark, sf_dir, "lineitem")
    order = Window.partitionBy("l_orderkey").orderBy(*STOCK_ARRIVAL[1:])
    numbered = {"page": F.col("l_orderkey"), "position": F.row_number().over(order).cast("bigint")}
    return spread(source.withColumns(numbered), source.count())


def arriving_stock_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stock feed with page and position."""
    rows = _stock_arriving(spark, sf_dir)
    return _landed(rows, _STOCK_FEED, "warehouse_remains", *_STOCK_KEEP, "page", "position")


def stock_lines(spark: SparkSession, sf_dir: str, answer: str) -> DataFrame:
    """Stock as lines of a landed folder (``value``), each part of the answer that the
    expression ``answer`` gives, with the columns it may name. Lines of no answer are left out."""
    rows = _stock_arriving(spark, sf_dir).withColumn("answer", F.expr(answer)).filter("answer is not null")
    arrival = [(name, name) for name in ("answer", "page", "position")]
    text = landed_text(rows, arrival + _STOCK_FEED, "warehouse_remains", *_STOCK_KEEP, "answer")
    return text.withColumnRenamed("payload", "value")


SUPPLY_NUMBER = "cast(o_orderkey - o_orderkey % 2 as string)"
_SUPPLY_PAYLOAD: Mapping = [
    (
        "supply",
        "named_struct("
        f"'supplyID', case when o_orderkey % 9 = 0 then '' else {SUPPLY_NUMBER} end, "
        "'preorderID', case when o_orderkey % 27 <> 0 and o_orderkey % 9 = 0 then cast(o_orderkey as string) end, "
        f"'createDate', {_iso('o_orderdate')}, "
        "'updatedDate', '', "
        "'statusID', cast(o_orderkey % 8 as string), "
        "'isBoxOnPallet', o_orderkey % 2 = 0, "
        "'phone', '+7' || cast(o_custkey as string))",
    ),
    (
        "details",
        "case when o_orderkey % 4 = 0 then named_struct('warehouseID', cast(null as string), "
        "'acceptanceCost', cast(null as string), 'quantity', cast(null as string)) "
        "else named_struct('warehouseID', cast(o_custkey % 7 as string), "
        "'acceptanceCost', cast(cast(o_totalprice as decimal(18,2)) as string), "
        "'quantity', cast(o_orderkey % 40 as string)) end",
    ),
    (
        "goods",
        "transform(slice(array(0,1,2), 1, cast(o_orderkey % 4 as int)), i -> named_struct("
        "'barcode', 'BC' || cast(o_custkey % 100 + i % 2 as string), 'nmID', cast(o_custkey as string), "
        "'vendorCode', 'VC' || cast(o_custkey % 53 as string), 'quantity', cast(i + 1 as string), "
        "'needKiz', i = 0))",
    ),
    (
        "packages",
        "transform(slice(array(0,1,2), 1, cast(o_orderkey % 3 + 1 as int)), j -> named_struct("
        "'packageCode', case when j = 1 and o_orderkey % 5 = 0 then '' else 'P' || cast(j % 2 as string) end, "
        "'quantity', cast(j + 10 as string), "
        "'barcodes', transform(slice(array(0,1,2), 1, cast(o_custkey % 3 as int)), b -> named_struct("
        "'barcode', case when b = 2 then '' else 'BC' || cast(b as string) end, "
        "'quantity', cast(b + j as string)))))",
    ),
]


def supply_feed(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    """Nested supply payloads; two orders share a supply number."""
    return _landed(
        spread(table(spark, sf_dir, "orders")),
        _SUPPLY_PAYLOAD,
        "supply_payloads",
        "cast(o_orderkey % 10 - o_orderkey % 2 as bigint) as account_id",
        "o_orderkey as position",
        *keep,
    )


def supply_lines(spark: SparkSession, sf_dir: str, answers: str, late: str) -> DataFrame:
    """Supply payloads as lines of a landed folder (``value``), once for each answer in the array
    that the expression ``answers`` gives; ``late`` marks lines and may name their answer."""
    rows = spread(table(spark, sf_dir, "orders")).selectExpr(
        "*", "cast(0 as bigint) as page", "o_orderkey as position", f"explode({answers}) as answer"
    )
    arrival = [(name, name) for name in ("answer", "page", "position")]
    keep = ["cast(o_orderkey % 10 - o_orderkey % 2 as bigint) as account_id", "answer", f"{late} as late"]
    text = landed_text(rows, arrival + _SUPPLY_PAYLOAD, "supply_payloads", *keep)
    return text.withColumnRenamed("payload", "value")


# ------------------------------------------------------------ control tables

API_BY_NUMBER = (
    "case {n} % 6 when 0 then 'orders' when 1 then 'sales' when 2 then 'finance_sales_report_details' "
    "when 3 then 'finance_sales_report_weekly' when 4 then 'warehouse_remains' else 'fbw_supplies' end"
)

SHOPS: Mapping = [
    ("id", "c_custkey"),
    ("account_code", "'shop_' || cast(c_custkey as string)"),
    ("account_name", "c_name"),
    ("token_env_var", "'TOKEN_' || cast(c_custkey as string)"),
    ("enabled", "c_acctbal > 0"),
]


def shops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project(table(spark, sf_dir, "customer"), SHOPS)


def configs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feeds of a shop: one per kind found among its orders."""
    return (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("account_id"), F.expr(API_BY_NUMBER.format(n="o_orderkey")).alias("api_type"))
        .agg(
            F.min("o_orderkey").alias("id"),
            (F.max(F.expr("o_orderkey % 4")) > 0).alias("enabled"),
            F.expr("cast(min(o_orderkey) % 600 as int)").alias("schedule_seconds"),
            F.expr("cast(min(o_orderkey) % 40 + 1 as int)").alias("lookback_days"),
            F.expr("cast(80000 as int)").alias("batch_limit"),
            F.expr("cast(count(*) as int)").alias("revision"),
        )
    )


def feed_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cursors left by finished orders; one shop in four has no key."""
    return (
        table(spark, sf_dir, "orders")
        .filter("o_orderstatus = 'F'")
        .groupBy(F.col("o_custkey").alias("account_id"), F.expr(API_BY_NUMBER.format(n="o_orderkey")).alias("api_type"))
        .agg(
            F.max("o_orderdate").alias("cursor_timestamp"),
            F.expr("case when o_custkey % 4 <> 0 then max('S' || cast(o_orderkey as string)) end").alias("cursor_key"),
        )
    )


# Each event is one run: it starts, may checkpoint, and ends in one or two ways.
def run_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = """
        inline(filter(array(
            named_struct('seq', 0L, 'delay', 0, 'kind', 'started'),
            named_struct('seq', 1L, 'delay', 20, 'kind', case when event_id % 3 = 0 then 'checkpoint' end),
            named_struct('seq', 2L, 'delay', 40, 'kind', case event_id % 4 when 0 then 'error' when 1 then 'interrupted' when 2 then 'success' end),
            named_struct('seq', 3L, 'delay', 60, 'kind', case event_id % 5 when 0 then 'success' when 1 then 'interrupted' end)
        ), s -> s.kind is not null))
    """
    return (
        table(spark, sf_dir, "events")
        .selectExpr("*", steps)
        .selectExpr(
            "user_id as account_id",
            f"{API_BY_NUMBER.format(n='event_id')} as api_type",
            "'run-' || cast(event_id as string) as run_id",
            "event_id * 10 + seq as seq",
            "timestampadd(second, delay, ts) as at",
            "kind",
            "case when kind = 'success' then cast(event_id % 1000 as int) end as rows_written",
            "case when kind in ('checkpoint', 'success') then date_trunc('day', ts) end as cursor_timestamp",
            "case when kind in ('checkpoint', 'success') and event_id % 7 > 0 then 'K' || cast(event_id as string) end as cursor_key",
            "case when kind in ('error', 'interrupted') then repeat(event_type, 1000) end as message",
        )
    )


# ------------------------------------------------------------ prices

SNAPSHOTS: Mapping = [
    ("id", "event_id"),
    ("source_id", "user_id"),
    ("observed_at", "ts"),
    ("requested_url", "url"),
    ("final_url", "url"),
    ("page_title", "cast(null as string)"),
    ("item_key", "event_type"),
    ("item_name", "cast(null as string)"),
    ("price", "cast(value as decimal(18,2))"),
    ("wallet_price", "cast(cast(value as decimal(18,2)) * 0.95 as decimal(18,2))"),
    ("old_price", "cast(null as decimal(18,2))"),
    ("currency", "'RUB'"),
    ("availability", "case when event_id % 9 = 0 then 'out' else 'in' end"),
    ("raw_payload", "props"),
]
PRICE_SOURCES: Mapping = [
    ("id", "page_id"),
    ("source_code", "'page_' || cast(page_id as string)"),
    ("source_name", "'Page ' || cast(page_id as string)"),
    ("source_type", "case when page_id % 10 = 0 then 'unlisted' else 'product_page' end"),
    ("url", "url"),
    ("enabled", "page_id % 6 > 0"),
    ("schedule_seconds", "cast(page_id % 50 as int)"),
]


def price_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project(table(spark, sf_dir, "pages"), PRICE_SOURCES)


def price_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marketlens.plans.prices import page_fingerprint

    pages = table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("user_id"), "url", page_fingerprint(F.col("html")).alias("html_sha256")
    )
    return project(table(spark, sf_dir, "events").join(pages, "user_id"), SNAPSHOTS, "html_sha256")
