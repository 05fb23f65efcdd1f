"""Reference SQL for the queries, run by DuckDB on the same tables.

Written from the definition of each result, apart from the Spark code: set
operations and correlated conditions where the Spark side groups or joins.
"""

from __future__ import annotations

from marketlens.functions import operations as op
from workload import fixtures as fx
from workload.queries import FIRST_LOAD

_REGISTRY: dict[str, str] = {}


def registered() -> dict[str, str]:
    return dict(_REGISTRY)


# ------------------------------------------------------------ building blocks

MONEY, DAY, AT, INT, AS_IS = "money", "day", "at", "int", "as_is"


def _shown(name: str, kind: str) -> str:
    return {
        MONEY: f"cast({name} as double) as {name}",
        DAY: f"strftime({name}, '%Y-%m-%d') as {name}",
        AT: f"strftime({name}, '%Y-%m-%d %H:%M:%S') as {name}",
        INT: f"cast({name} as bigint) as {name}",
        AS_IS: name,
    }[kind]


def _columns(**kinds: str) -> str:
    """``money="a b"`` -> the output columns in their plain types."""
    return ", ".join(_shown(n, kind) for kind, names in kinds.items() for n in names.split())


def add(name: str, ctes: list[str], source: str, **kinds: str) -> None:
    text = f"select {_columns(**kinds)} from {source}"
    _REGISTRY[name] = ("with " + ",\n".join(ctes) + "\n" if ctes else "") + text


def _select(mapping: fx.Mapping, source: str, *keep: str) -> str:
    fields = [f"{expr} as {name}" for name, expr in mapping] + list(keep)
    return f"select {', '.join(fields)} from {source}"


def _lines(period: str, name: str = "lines") -> str:
    newest = ", ".join(f"{c} desc" for c in fx.LINE_ARRIVAL)
    ranked = (
        "select *, row_number() over (partition by l_orderkey % 5 + 1, "
        f"date_trunc('{period}', l_shipdate), {fx.LINE_KEY} order by {newest}) as rn "
        "from lineitem join orders on l_orderkey = o_orderkey"
    )
    return f"{name} as ({_select(fx.line_mapping(period), f'({ranked}) where rn = 1')})"


ACCOUNTS = f"accounts as ({_select(fx.ACCOUNTS, 'region')})"
COSTS = f"costs as ({_select(fx.COSTS, 'part')})"
LEGACY = f"legacy_costs as ({_select(fx.LEGACY_COSTS, 'part')})"
CURRENT = """current_costs as (
    select * from costs c where valid_to is null and not exists (
        select 1 from costs later
        where later.valid_to is null and later.account_id = c.account_id
          and later.vendor_code = c.vendor_code
          and (later.valid_from > c.valid_from
               or (later.valid_from = c.valid_from and later.id > c.id))))"""


def _local(column: str) -> str:
    return f"cast(timezone('Europe/Moscow', timezone('UTC', {column})) as date)"


def _sign(signs: dict[str, int]) -> str:
    cases = " ".join(f"when '{name}' then {sign}" for name, sign in signs.items())
    return f"case seller_oper_name {cases} else 0 end"


TURN, PAY = _sign(op.TURNOVER_SIGNS), _sign(op.PAYOUT_SIGNS)


def _sum(expr: str) -> str:
    return f"coalesce(sum({expr}), 0)"


LINE_PAYOUT = f"""(coalesce(for_pay, 0) * {PAY} - coalesce(delivery_service, 0)
    - coalesce(paid_storage, 0) - coalesce(paid_acceptance, 0) - coalesce(deduction, 0)
    - coalesce(penalty, 0) - coalesce(cashback_commission_change, 0)
    + coalesce(cashback_amount, 0) + coalesce(additional_payment, 0))"""

MEASURES = f"""
    cast(date_trunc('week', min({_local('date_from')})) as date) as week_start,
    min({_local('date_from')}) as period_from,
    max({_local('date_to')}) as period_to,
    max({_local('create_date')}) as report_created_date,
    case when max(report_type) = 1 then '{op.MAIN_REPORT}' else cast(max(report_type) as string) end
        as report_type_name,
    {_sum(f'retail_amount * {TURN}')} as sale_amount,
    {_sum('cashback_amount')} + case
        when count(*) filter (seller_oper_name = '{op.VOLUNTARY_RETURN_COMPENSATION}') > 0
        then {_sum(f"case when seller_oper_name = '{op.LOYALTY_COMPENSATION}' then cashback_discount end")}
        else 0 end as loyalty_discount_compensation,
    {_sum(f'for_pay * {PAY}')} as to_transfer_for_goods,
    case when {_sum(f'retail_price * {TURN}')} = 0 then 0 else
        round(cast((1 - sum(retail_price_with_disc * {TURN}) / sum(retail_price * {TURN})) * 100
                   as decimal(18,9)), 2) end as agreed_discount_percent,
    {_sum('delivery_service')} as logistics_cost,
    {_sum('paid_storage')} as storage_cost,
    {_sum('paid_acceptance')} as acceptance_cost,
    {_sum('deduction')} as other_deductions_payouts,
    {_sum('penalty')} as penalties_total,
    {_sum('additional_payment')} as reward_adjustment,
    {_sum('cashback_commission_change')} as loyalty_points_withheld,
    0 as loyalty_program_cost,
    {_sum(LINE_PAYOUT)} as total_to_pay"""

MONEY_NAMES = (
    "sale_amount loyalty_discount_compensation to_transfer_for_goods agreed_discount_percent "
    "logistics_cost storage_cost acceptance_cost other_deductions_payouts penalties_total "
    "reward_adjustment loyalty_points_withheld loyalty_program_cost total_to_pay"
)
DAY_NAMES = "week_start period_from period_to report_created_date"

# ------------------------------------------------------------ settlement

for _name, _period in (("settlement_daily", "day"), ("settlement_weekly", "week")):
    add(
        _name,
        [
            _lines(_period),
            ACCOUNTS,
            f"""summary as (
    select account_id, account_code, account_name as legal_entity_name, report_id, currency, {MEASURES}
    from lines join accounts on id = account_id
    group by all)""",
        ],
        "summary",
        as_is="account_id account_code legal_entity_name report_id currency report_type_name",
        day=DAY_NAMES,
        money=MONEY_NAMES,
    )

_NA = op.NOT_AVAILABLE


def _best(column: str, blank: str) -> str:
    return f"case when {blank} then '{_NA}' else coalesce(max(case when {column} <> '' then {column} end), '{_NA}') end as {column}"


_ATTRIBUTES = ("brand_name", "vendor_code", "title", "tech_size")

add(
    "settlement_by_sku",
    [
        _lines("week"),
        ACCOUNTS,
        COSTS,
        CURRENT,
        f"""by_sku as (
    select account_id, account_code, account_name as legal_entity_name, report_id, sku, currency,
        case when sku = '' then 0 else coalesce(max(nm_id), 0) end as nm_id,
        {', '.join(_best(c, "sku = ''") for c in _ATTRIBUTES)},
        {_sum(f'quantity * {TURN}')} as quantity, {MEASURES}
    from lines join accounts on id = account_id
    group by account_id, account_code, account_name, report_id, sku, currency)""",
        f"""priced as (
    select s.*, case when s.vendor_code = '{_NA}' then 0 else quantity * coalesce(
        (select c.cost from current_costs c
         where c.account_id = s.account_id and c.vendor_code = s.vendor_code), {op.UNKNOWN_COST}) end as cost
    from by_sku s)""",
        "result as (select *, total_to_pay - cost as profit from priced)",
    ],
    "result",
    as_is="account_id account_code legal_entity_name report_id sku currency report_type_name "
    + " ".join(_ATTRIBUTES),
    int="nm_id quantity",
    day=DAY_NAMES,
    money=MONEY_NAMES + " cost profit",
)

_ENRICHED = f"""enriched as (
    select l.*, case when coalesce(l.vendor_code, '') = '' then 0
                     else coalesce(c.cost, {op.UNKNOWN_COST}) end as unit_cost
    from lines l left join current_costs c
      on c.account_id = l.account_id and c.vendor_code = l.vendor_code)"""

add(
    "settlement_enriched",
    [
        _lines("week"),
        COSTS,
        CURRENT,
        _ENRICHED,
        f"""result as (
    select *, coalesce(quantity, 0) * {TURN} * unit_cost as cost, {LINE_PAYOUT} as total_to_pay,
        {LINE_PAYOUT} - coalesce(quantity, 0) * {TURN} * unit_cost as profit from enriched)""",
    ],
    "result",
    as_is="account_id report_id rrd_id sku vendor_code seller_oper_name",
    int="quantity",
    money="for_pay unit_cost cost total_to_pay profit",
)

add(
    "sku_reference",
    [
        _lines("week"),
        f"named as (select * replace (case when sku <> '' then sku else '{_NA}' end as sku) from lines)",
        f"""result as (
    select sku, case when sku = '{_NA}' then 0 else coalesce(max(nm_id), 0) end as nm_id,
        {', '.join(_best(c, f"sku = '{_NA}'") for c in _ATTRIBUTES)}
    from named group by sku)""",
    ],
    "result",
    as_is="sku " + " ".join(_ATTRIBUTES),
    int="nm_id",
)

# ------------------------------------------------------------ units and facts

_TAGS = """tags as (
    select account_id, report_id, rrd_id, case when kiz <> '' then kiz end as kiz,
           unnest(['srid', 'order_id', 'order_uid', 'shk_id']) as match_type,
           unnest([case when srid <> '' then srid end, cast(order_id as string),
                   case when order_uid <> '' then order_uid end, cast(shk_id as string)]) as match_value
    from lines)"""
_TRUSTED = """trusted as (
    select account_id, match_type, match_value, any_value(kiz) as kiz from tags
    where kiz is not null and match_value is not null
    group by account_id, match_type, match_value having count(distinct kiz) = 1)"""
_RESOLVED = """resolved as (
    select t.account_id, t.report_id, t.rrd_id, any_value(m.kiz) as kiz
    from tags t join trusted m using (account_id, match_type, match_value)
    where t.kiz is null
    group by t.account_id, t.report_id, t.rrd_id having count(distinct m.kiz) = 1)"""
_UNITS = """units as (
    select l.*, coalesce(case when l.kiz <> '' then l.kiz end, r.kiz) as restored_kiz,
        case
            when l.kiz <> '' or r.kiz is not null
                then 'kiz:' || coalesce(case when l.kiz <> '' then l.kiz end, r.kiz)
            when l.shk_id is not null then 'shk_id:' || cast(l.shk_id as string)
            when l.srid <> '' then 'srid:' || l.srid
            when l.order_id is not null then 'order_id:' || cast(l.order_id as string)
            when l.order_uid <> '' then 'order_uid:' || l.order_uid
            else concat('finance_row:', l.account_id, ':', l.report_id, ':', l.rrd_id)
        end as uniq_product_id
    from lines l left join resolved r using (account_id, report_id, rrd_id))"""
_IDENTITY = [_lines("day"), _TAGS, _TRUSTED, _RESOLVED, _UNITS]

add(
    "trusted_identifiers",
    _IDENTITY[:3],
    "trusted",
    as_is="account_id match_type match_value kiz",
)
add("resolved_lines", _IDENTITY[:4], "resolved", as_is="account_id report_id rrd_id kiz")
add(
    "unit_identity",
    _IDENTITY,
    "units",
    as_is="account_id report_id rrd_id nm_id seller_oper_name kiz srid order_id order_uid shk_id "
    "restored_kiz uniq_product_id",
)

_MOVED = "(coalesce(delivery_amount, 0) <> 0 or coalesce(return_amount, 0) <> 0 or coalesce(delivery_service, 0) <> 0)"
_FACT_STEPS = [
    *_IDENTITY,
    "moves as (select *, coalesce(rr_date, sale_dt, order_dt, date_from, create_date) as event_at "
    "from units where nm_id is not null)",
    f"""pairs as (
    select account_id, nm_id, uniq_product_id, bool_or(order_dt is not null) as has_order,
           bool_or({_MOVED}) as has_logistics
    from moves group by all having bool_or(order_dt is not null) or bool_or({_MOVED}))""",
    """runs as (
    select account_id, uniq_product_id, sum(coalesce(delivery_amount, 0)) as deliveries,
           sum(coalesce(return_amount, 0)) as returns, sum(coalesce(delivery_service, 0)) as service
    from moves group by all)""",
    f"""sold as (
    select distinct account_id, uniq_product_id from moves where seller_oper_name = '{op.SALE}')""",
    f"""last_status as (
    select account_id, uniq_product_id, seller_oper_name as latest from moves
    where seller_oper_name in ('{op.SALE}', '{op.RETURN}')
    qualify row_number() over (partition by account_id, uniq_product_id
        order by event_at desc nulls last, rrd_id desc, report_id desc) = 1)""",
    "listings as (select account_id, uniq_product_id, count(*) as articles from pairs group by all)",
    f"""unit_facts as (
    select r.*, s.uniq_product_id is not null as has_sale, latest, coalesce(articles, 0) as articles,
        cast(case
            when s.uniq_product_id is null then 0
            when latest = '{op.SALE}' and deliveries > 0 then 1 / deliveries
            when deliveries + returns > 0 then 1 / (deliveries + returns)
            else 0 end as decimal(23,16)) as ratio
    from runs r
    left join sold s using (account_id, uniq_product_id)
    left join last_status using (account_id, uniq_product_id)
    left join listings using (account_id, uniq_product_id))""",
]
add(
    "unit_buyout",
    [
        *_FACT_STEPS,
        """result as (select * exclude (ratio, has_sale), round(ratio, 10) as ratio,
        -- a unit without any named operation has no sale flag at all
        case when has_sale then true else (select bool_or(seller_oper_name is not null) and false
            from moves m where m.account_id = u.account_id and m.uniq_product_id = u.uniq_product_id)
        end as has_sale from unit_facts u)""",
    ],
    "result",
    as_is="account_id uniq_product_id has_sale latest",
    int="articles",
    money="deliveries returns service ratio",
)


def _facts(copies: str) -> list[str]:
    """``copies``: one row per copy of a unit that an article counts."""
    return [
        *_FACT_STEPS,
        ACCOUNTS,
        f"""copies as (
    select p.account_id, p.nm_id, f.latest, f.ratio, f.deliveries, f.returns
    from pairs p join unit_facts f using (account_id, uniq_product_id) {copies})""",
        f"""counted as (
    select account_id, nm_id, count(*) as buyout_basis_units, count(*) filter (has_order) as ordered_units,
           count(*) filter (has_logistics) as logistics_basis_units, sum(deliveries) as delivery_runs,
           sum(returns) as return_runs, sum(service) as logistics_cost_total
    from pairs join runs using (account_id, uniq_product_id) group by all)""",
        f"""outcome as (
    select account_id, nm_id, count(*) filter (latest = '{op.SALE}') as buyout_units,
           count(*) filter (latest = '{op.RETURN}') as returned_units,
           count(*) filter (latest is null) as no_final_status_units,
           sum(ratio) as ratio_sum, cast(sum(ratio) / count(*) as decimal(18,12)) as ratio_avg,
           sum(deliveries) as delivery_iterations, sum(returns) as return_iterations
    from copies group by all)""",
        f"""articles as (
    select account_id, nm_id, {', '.join(_best(c, 'false') for c in _ATTRIBUTES)}
    from lines where nm_id is not null group by account_id, nm_id)""",
        f"""result as (
    select date '2026-06-01' as fact_date, r.*, account_code, account_name as legal_entity_name,
        {', '.join(f'coalesce({c}, 0) as {c}' for c in (
            'buyout_basis_units', 'ordered_units', 'logistics_basis_units', 'buyout_units',
            'returned_units', 'no_final_status_units', 'delivery_iterations', 'return_iterations',
            'delivery_runs', 'return_runs', 'logistics_cost_total'))},
        coalesce(buyout_basis_units, 0) as logistics_cost_units,
        coalesce(delivery_iterations + return_iterations, 0) as logistics_iterations,
        coalesce(delivery_runs + return_runs, 0) as logistics_runs,
        round(coalesce(ratio_sum, 0), 6) as buyout_ratio_sum,
        round(coalesce(ratio_avg, 0), 4) as buyout_ratio_avg,
        round(coalesce(ratio_avg, 0) * 100, 2) as buyout_percent,
        case when buyout_units > 0
             then round(cast(logistics_cost_total / buyout_units as decimal(18,9)), 2) end as avg_logistics_cost
    from articles r join accounts on id = r.account_id
    left join counted using (account_id, nm_id) left join outcome using (account_id, nm_id))""",
    ]


_FACT_OUTPUT = {
    "as_is": "account_id account_code legal_entity_name nm_id " + " ".join(_ATTRIBUTES),
    "day": "fact_date",
    "int": "buyout_basis_units ordered_units logistics_basis_units buyout_units returned_units "
    "no_final_status_units logistics_cost_units",
    "money": "buyout_ratio_sum buyout_ratio_avg buyout_percent delivery_iterations return_iterations "
    "logistics_iterations delivery_runs return_runs logistics_runs logistics_cost_total avg_logistics_cost",
}
# Copies are made for real here: once for each run total, once for each sale flag.
_SQUARED = (
    "join pairs a on a.account_id = p.account_id and a.uniq_product_id = p.uniq_product_id "
    "join pairs b on b.account_id = p.account_id and b.uniq_product_id = p.uniq_product_id"
)
add("article_facts", _facts(_SQUARED), "result", **_FACT_OUTPUT)
add("article_facts_per_unit", _facts(""), "result", **_FACT_OUTPUT)
add(
    "facts_load",
    [
        *_facts(_SQUARED),
        """stored as (
    select distinct case when account_id = 3 then date '2026-05-31' else date '2026-06-01' end as fact_date,
           account_id, nm_id, 0 as buyout_basis_units
    from lines where account_id <= 3)""",
        """loaded as (
    select * from stored union all
    select fact_date, account_id, nm_id, buyout_basis_units from result
    where (fact_date, account_id) not in (select fact_date, account_id from stored))""",
    ],
    "loaded",
    as_is="account_id nm_id",
    day="fact_date",
    int="buyout_basis_units",
)

# ------------------------------------------------------------ prices

_SNAPSHOTS = f"snapshots as ({_select(fx.SNAPSHOTS, 'events join pages on user_id = page_id', 'sha256(html) as html_sha256')})"
_SOURCES = f"sources as ({_select(fx.PRICE_SOURCES, 'pages')})"
add(
    "latest_prices",
    [
        _SNAPSHOTS,
        _SOURCES,
        """result as (
    select distinct on (source_id) s.*, source_code, source_name, source_type
    from snapshots s join sources p on p.id = s.source_id
    order by source_id, observed_at desc, s.id desc)""",
    ],
    "result",
    as_is="source_id source_code source_name source_type item_key item_name currency availability "
    "final_url page_title",
    at="observed_at",
    money="price wallet_price old_price",
)
add(
    "price_snapshots",
    [_SNAPSHOTS],
    "snapshots",
    as_is="id source_id item_key availability html_sha256 raw_payload",
    money="price wallet_price",
)

# ------------------------------------------------------------ costs

add(
    "cost_current",
    [COSTS, CURRENT],
    "current_costs",
    as_is="account_id vendor_code",
    money="cost",
    at="valid_from valid_to",
)


def _coded(modulus: int) -> str:
    return (
        "select l_orderkey % 5 + 1 as account_id, "
        f"'VC' || cast(l_partkey % {modulus} as string) as vendor_code from lineitem where l_partkey % 10 <> 0"
    )


_NOT_COSTED = f"""missing as (
    select account_id, vendor_code, {op.UNKNOWN_COST} as cost, timestamp '2026-06-01 12:00:00' as valid_from
    from (select distinct * from codes)
    where (account_id, vendor_code) not in (select account_id, vendor_code from costs where valid_to is null))"""
_ENTRY = {"as_is": "account_id vendor_code", "money": "cost", "at": "valid_from"}
add(
    "cost_ensure",
    [
        COSTS,
        "codes as (select l_orderkey % 5 + 1 as account_id, 'VC' || cast(l_partkey % 71 as string) as vendor_code "
        "from lineitem where l_partkey % 10 <> 0 and l_partkey % 11 <> 0)",
        _NOT_COSTED,
    ],
    "missing",
    **_ENTRY,
)
add(
    "cost_backfill",
    [COSTS, f"codes as ({_coded(53)} union all {_coded(67)})", _NOT_COSTED],
    "missing",
    **_ENTRY,
)
add(
    "cost_legacy_fanout",
    [
        LEGACY,
        f"codes as ({_coded(53)} union {_coded(67)})",
        """copies as (
    select l.* replace (c.account_id as account_id) from legacy_costs l join codes c using (vendor_code)
    where l.account_id is null and not exists (
        select 1 from legacy_costs o where o.account_id = c.account_id
          and o.vendor_code = l.vendor_code and o.valid_from = l.valid_from)
    qualify row_number() over (partition by c.account_id, l.vendor_code, l.valid_from order by l.id) = 1)""",
        "result as (select * from legacy_costs where account_id is not null union all by name select * from copies)",
    ],
    "result",
    as_is="id account_id vendor_code",
    money="cost",
    at="valid_from valid_to",
)

# ------------------------------------------------------------ normalised feeds

_YEAR_ONE = "timestamp '0001-01-01 00:00:00'"
_ORDER_SHIFT = "to_hours(case o_orderkey % 3 when 0 then 0 when 1 then 3 else 5 end)"
_ORDER_ROWS = f"""order_rows as (
    select o_orderkey as position, o_custkey % 5 + 1 as account_id, o_orderkey % 3 as page,
        case when o_orderkey % 7 > 0 then 'S' || cast(o_orderkey as string)
             when o_orderkey % 49 > 0 then 'G' || cast(o_orderkey % 100 as string)
             else 'None' end as record_key,
        o_orderdate - {_ORDER_SHIFT} as order_date,
        o_orderdate as last_change_date,
        -- a cancel date is local time; year one cannot be shifted back
        case when o_orderkey % 11 = 0 then o_orderdate - interval 3 hour else {_YEAR_ONE} end as cancel_date,
        'W' || cast(o_custkey % 7 as string) as warehouse_name, o_custkey % 50 + 1 as nm_id,
        cast(o_totalprice as decimal(18,2)) as total_price,
        round(cast(o_totalprice as decimal(18,2)) * 0.905, 2) as finished_price,
        case when o_orderkey % 13 > 0 then o_orderkey % 40 end as discount_percent,
        null as spp, o_orderkey % 11 = 0 as is_cancel, cast(null as string) as sticker,
        case when o_orderkey % 49 > 0 then 'G' || cast(o_orderkey % 100 as string) end as g_number,
        case when o_orderkey % 7 = 0 then '' else 'S' || cast(o_orderkey as string) end as srid
    from orders)"""
add(
    "feed_dates",
    [
        _ORDER_ROWS,
        """result as (
    select position, order_date as order_at, cancel_date as cancel_at,
        date_trunc('day', order_date + interval 3 hour) - interval 3 hour as feed_day_start,
        date_trunc('week', order_date) as week_start,
        strftime(order_date, '%Y-%m-%dT%H:%M:%S') as request_text
    from order_rows)""",
    ],
    "result",
    as_is="position request_text",
    at="order_at cancel_at feed_day_start",
    day="week_start",
)
add(
    "normalized_orders",
    [_ORDER_ROWS],
    "order_rows",
    as_is="position account_id record_key warehouse_name is_cancel sticker g_number srid",
    at="order_date last_change_date cancel_date",
    int="nm_id",
    money="total_price finished_price discount_percent spp",
)

_SALE_ROWS = """sale_rows as (
    select l_orderkey % 5 + 1 as account_id,
        case when l_linenumber <= 4 then 'S' else 'R' end || cast(l_orderkey as string) as record_key,
        case when l_linenumber <= 4 then 'S' || cast(l_orderkey as string) when l_linenumber = 5 then '' end as sale_id,
        l_shipdate - interval 3 hour as sale_date, l_shipdate - interval 3 hour as last_change_date,
        l_partkey as nm_id, cast(l_extendedprice as decimal(12,2)) as total_price,
        round(cast(l_extendedprice as decimal(12,2)) * 0.85, 2) as for_pay,
        cast(l_discount as decimal(4,2)) * 100 as spp, 'R' || cast(l_orderkey as string) as srid,
        l_linenumber, l_extendedprice, l_partkey, l_suppkey, l_shipdate
    from lineitem)"""
add(
    "normalized_sales",
    [_SALE_ROWS],
    "sale_rows",
    as_is="account_id record_key sale_id nm_id srid",
    at="sale_date last_change_date",
    money="total_price for_pay spp",
)

_RAW_LINES = f"raw_lines as ({_select(fx.line_mapping('week'), 'lineitem join orders on l_orderkey = o_orderkey')})"
_LINE_OUTPUT = {
    "as_is": "account_id report_id rrd_id currency nm_id sku vendor_code brand_name title tech_size "
    "seller_oper_name kiz srid order_id order_uid shk_id",
    "int": "report_type quantity",
    "at": "date_from date_to create_date order_dt sale_dt rr_date",
    "money": "retail_price retail_price_with_disc retail_amount for_pay delivery_amount return_amount "
    "delivery_service paid_storage deduction penalty additional_payment paid_acceptance "
    "cashback_amount cashback_discount cashback_commission_change",
}
add("normalized_settlement", [_RAW_LINES], "raw_lines", **_LINE_OUTPUT)
add("upsert_settlement", [_lines("week")], "lines", **_LINE_OUTPUT)
add(
    "settlement_keys",
    [
        _RAW_LINES,
        "result as (select account_id, concat(report_id, ':', rrd_id) as row_key, count(*) as landed "
        "from raw_lines group by all)",
    ],
    "result",
    as_is="account_id row_key",
    int="landed",
)
_UNDECLARED = "true as is_number, true as keeps_null"
add(
    "settlement_payload",
    [
        _RAW_LINES.replace(" from lineitem", ", l_tax from lineitem"),
        "result as (select *, seller_oper_name as operation, 'x' as more, "
        f"cast(l_tax as decimal(4,2)) as line_tax, {_UNDECLARED} from raw_lines)",
    ],
    "result",
    as_is="account_id rrd_id operation more is_number keeps_null",
    money="retail_price line_tax",
    at="date_from",
)

_STOCK_ROWS = """stock_rows as (
    select l_orderkey % 5 + 1 as account_id, 'B' || cast(l_partkey % 7 as string) as brand,
        'VC' || cast(l_partkey % 53 as string) as vendor_code,
        case when l_partkey % 97 > 0 then l_partkey % 500 end as nm_id,
        'BC' || cast(l_partkey % 500 as string) as barcode, cast(l_partkey % 5 as string) as tech_size,
        cast(l_tax as decimal(4,2)) as volume, i as warehouse_position,
        case when i = 0 then 'W' || cast(l_suppkey % 7 as string)
             when l_suppkey % 3 > 0 then 'W' || cast(l_suppkey % 7 + l_suppkey % 3 - 1 as string)
             else '' end as warehouse_name,
        case when i = 0 then cast(l_quantity as bigint)
             when l_quantity > 5 then cast(l_quantity as bigint) + 1 else 0 end as quantity,
        l_linestatus, l_orderkey, l_linenumber, l_extendedprice, l_partkey, l_suppkey, l_shipdate
    from lineitem, range(0, 2) w(i) where i < l_linenumber % 3)"""
add(
    "normalized_stock",
    [_STOCK_ROWS],
    "stock_rows",
    as_is="account_id brand vendor_code nm_id barcode tech_size warehouse_name",
    int="quantity warehouse_position",
    money="volume",
)

add(
    "stock_payload",
    [
        _STOCK_ROWS,
        f"""result as (select *, {_UNDECLARED}, cast(l_linenumber as double) as shelf,
        case when warehouse_position = 0 or l_suppkey % 3 > 0 then warehouse_name end as warehouse,
        'W' || cast(l_suppkey % 7 as string) as first_warehouse from stock_rows)""",
    ],
    "result",
    as_is="account_id barcode warehouse first_warehouse is_number keeps_null",
    int="warehouse_position",
    money="shelf",
)

_SUPPLY_ROWS = """supply_rows as (
    select o.*, o_orderkey as position, o_orderkey % 10 - o_orderkey % 2 as account_id,
        case when o_orderkey % 9 > 0 then o_orderkey - o_orderkey % 2 end as supply_id,
        case when o_orderkey % 9 = 0 then o_orderkey end as preorder_id,
        case when o_orderkey % 9 > 0 then 'supply:' || cast(o_orderkey - o_orderkey % 2 as string)
             else 'preorder:' || cast(o_orderkey as string) end as supply_key,
        '+7' || cast(o_custkey as string) as phone
    from orders o where o_orderkey % 27 > 0)"""
_HEADS = """heads as (
    select *, o_orderdate - interval 3 hour as create_date, cast(null as timestamp) as supply_date,
        cast(null as timestamp) as fact_date, cast(null as timestamp) as updated_date,
        o_orderkey % 8 as status_id, cast(null as bigint) as box_type_id, o_orderkey % 2 = 0 as is_box_on_pallet
    from supply_rows)"""
_DETAILS = """details as (
    select *, o_custkey % 7 as warehouse_id, cast(o_totalprice as decimal(18,2)) as acceptance_cost,
        o_orderkey % 40 as quantity
    from supply_rows where o_orderkey % 4 > 0)"""
_GOODS = """goods as (
    select *, 'BC' || cast(o_custkey % 100 + i % 2 as string) as barcode,
        'VC' || cast(o_custkey % 53 as string) as vendor_code, o_custkey as nm_id, i = 0 as need_kiz,
        i + 1 as quantity
    from supply_rows, range(0, 3) g(i) where i < o_orderkey % 4)"""
_PACKAGES = """packages as (
    select *, 'P' || cast(j % 2 as string) as package_code, j + 10 as quantity, j as package_position
    from supply_rows, range(0, 3) p(j)
    where j < o_orderkey % 3 + 1 and not (j = 1 and o_orderkey % 5 = 0))"""
_BARCODES = """barcodes as (
    select * exclude (quantity), 'BC' || cast(b as string) as barcode, b + package_position as quantity,
        b as barcode_position
    from packages, range(0, 2) c(b) where b < o_custkey % 3)"""
_SUPPLY_KEYS = "account_id supply_key supply_id"
add(
    "normalized_supplies",
    [_SUPPLY_ROWS, _HEADS],
    "heads",
    as_is=f"{_SUPPLY_KEYS} preorder_id phone is_box_on_pallet position",
    int="status_id box_type_id",
    at="create_date supply_date fact_date updated_date",
)
add(
    "normalized_supply_details",
    [_SUPPLY_ROWS, _DETAILS],
    "details",
    as_is=f"{_SUPPLY_KEYS} preorder_id position",
    int="warehouse_id quantity",
    money="acceptance_cost",
)
add(
    "normalized_supply_goods",
    [_SUPPLY_ROWS, _GOODS],
    "goods",
    as_is=f"{_SUPPLY_KEYS} preorder_id barcode vendor_code nm_id need_kiz",
    int="quantity",
)
add(
    "normalized_supply_packages",
    [_SUPPLY_ROWS, _PACKAGES],
    "packages",
    as_is=f"{_SUPPLY_KEYS} package_code position",
    int="quantity package_position",
)
add(
    "normalized_package_barcodes",
    [_SUPPLY_ROWS, _PACKAGES, _BARCODES],
    "barcodes",
    as_is=f"{_SUPPLY_KEYS} package_code barcode position",
    int="quantity package_position barcode_position",
)

add(
    "supply_payload",
    [_SUPPLY_ROWS, _HEADS, f"result as (select *, '' as updated, o_custkey % 9 as dock, {_UNDECLARED} from heads)"],
    "result",
    as_is="account_id supply_key position updated is_number keeps_null",
    at="create_date",
    money="dock",
)
add(
    "goods_payload",
    [_SUPPLY_ROWS, _GOODS, f"result as (select *, cast(nm_id as string) as nm, o_custkey % 5 as layer, {_UNDECLARED} from goods)"],
    "result",
    as_is="account_id supply_key barcode nm is_number keeps_null",
    int="quantity",
    money="layer",
)
add(
    "package_payload",
    [
        _SUPPLY_ROWS,
        _PACKAGES,
        "result as (select *, cast(quantity as string) as said_quantity, o_custkey % 8 + 0.5 as weight, "
        f"{_UNDECLARED} from packages)",
    ],
    "result",
    as_is="account_id supply_key position said_quantity is_number keeps_null",
    int="package_position",
    money="weight",
)

# ------------------------------------------------------------ loads


def _newest(source: str, keys: str, arrival: str, name: str) -> str:
    order = ", ".join(f"{c} desc" for c in arrival.split())
    return (
        f"{name} as (select * from {source} "
        f"qualify row_number() over (partition by {', '.join(keys.split())} order by {order}) = 1)"
    )


_ORDER_LATEST = _newest("order_rows", "account_id record_key", "page position", "latest_orders")
add(
    "upsert_orders",
    [_ORDER_ROWS, _ORDER_LATEST],
    "latest_orders",
    as_is="account_id record_key g_number position",
    at="last_change_date",
    money="total_price",
)
_SALE_LATEST = _newest("sale_rows", "account_id record_key", " ".join(fx.SALE_ARRIVAL), "latest_sales")
add(
    "upsert_sales",
    [_SALE_ROWS, _SALE_LATEST],
    "latest_sales",
    as_is="account_id record_key nm_id",
    at="last_change_date",
    money="total_price for_pay",
)
_STOCK_ORDER = ", ".join(f"{c} desc" for c in [*fx.STOCK_ARRIVAL, "warehouse_position"])
add(
    "stock_snapshot",
    [
        _STOCK_ROWS,
        f"""result as (
    select * from stock_rows where account_id = 5 and l_linestatus = 'F'
    union all
    select * from stock_rows where account_id <= 3 and l_linestatus <> 'F' and nm_id is null
    union all
    (select * from stock_rows where account_id <= 3 and l_linestatus <> 'F' and nm_id is not null
     qualify row_number() over (partition by account_id, nm_id, barcode, tech_size, warehouse_name
                                order by {_STOCK_ORDER}) = 1))""",
    ],
    "result",
    as_is="account_id nm_id barcode tech_size warehouse_name brand vendor_code",
    int="quantity",
)
_CURRENT_STOCK = f"""current as (
    select * from stock_rows where if(account_id = 5, l_linestatus = 'F', account_id <= 3 and l_linestatus <> 'F')),
result as (
    select * from current where nm_id is null
    union all
    (select * from current where nm_id is not null
     qualify row_number() over (partition by account_id, nm_id, barcode, tech_size, warehouse_name
                                order by {_STOCK_ORDER}) = 1))"""
add(
    "streamed_stock",
    [
        _STOCK_ROWS,
        _CURRENT_STOCK,
    ],
    "result",
    as_is="account_id nm_id barcode tech_size warehouse_name brand vendor_code",
    int="quantity",
)

_OLD, _NEW = "year(o_orderdate) < 1998", "year(o_orderdate) >= 1997"


def _replaced(table: str, keys: str, arrival: str, item: str, label: str) -> list[str]:
    """Old rows of untouched supplies, and the new rows; the last of a key stays."""

    def part(condition: str, name: str) -> str:
        source = f"(select * from {table} where {condition})"
        return _newest(source, keys, arrival, name) if keys else f"{name} as (select * from {source})"

    return [
        part(_OLD, f"old_{table}"),
        part(_NEW, f"new_{table}"),
        f"""out_{table} as (
    select '{label}' as table_name, account_id, supply_key, {item} as item from old_{table}
    where (account_id, supply_key) not in (select account_id, supply_key from touched)
    union all
    select '{label}', account_id, supply_key, {item} from new_{table})""",
    ]


def _upserted(table: str, item: str, label: str) -> list[str]:
    ranked = f"(select *, {_NEW} as is_new from {table} where {_OLD} or {_NEW})"
    # A supply may come in both loads; the loaded row counts, then the later one.
    both = (
        f"(select * replace (true as is_new) from {ranked} where {_NEW} "
        f"union all select * replace (false as is_new) from {ranked} where {_OLD})"
    )
    return [
        _newest(both, "account_id supply_key", "is_new position", f"last_{table}"),
        f"out_{table} as (select '{label}' as table_name, account_id, supply_key, {item} as item from last_{table})",
    ]


for _name in ("supplies_load", "streamed_supplies"):
    add(
        _name,
        [
            _SUPPLY_ROWS,
            _HEADS,
            _DETAILS,
            _GOODS,
            _PACKAGES,
            _BARCODES,
            f"touched as (select distinct account_id, supply_key from supply_rows where {_NEW})",
            *_upserted("heads", "phone", "supplies"),
            *_upserted("details", "cast(cast(acceptance_cost as decimal(18,6)) as string)", "supply_details"),
            *_replaced("goods", "", "", "concat(barcode, '/', quantity)", "supply_goods"),
            *_replaced(
                "packages",
                "account_id supply_key package_code",
                "position package_position",
                "concat(package_code, '/', quantity)",
                "supply_packages",
            ),
            *_replaced(
                "barcodes",
                "account_id supply_key package_code barcode",
                "position package_position barcode_position",
                "concat(package_code, '/', barcode, '/', quantity)",
                "supply_package_barcodes",
            ),
            "result as (from out_heads union all from out_details union all from out_goods "
            "union all from out_packages union all from out_barcodes)",
        ],
        "result",
        as_is="table_name account_id supply_key item",
    )
add(
    "supply_rows_processed",
    [
        _SUPPLY_ROWS,
        _DETAILS,
        _GOODS,
        _PACKAGES,
        _BARCODES,
        "result as (select (select count(*) from supply_rows) + (select count(*) from details) "
        "+ (select count(*) from goods) + (select count(*) from packages) + (select count(*) from barcodes) "
        "as rows_written)",
    ],
    "result",
    int="rows_written",
)

# ------------------------------------------------------------ incremental

_API = fx.API_BY_NUMBER.format(n="o_orderkey")
_CONFIGS = f"""configs as (
    select o_custkey as account_id, {_API} as api_type, min(o_orderkey) as id,
        max(o_orderkey % 4) > 0 as enabled, min(o_orderkey) % 600 as schedule_seconds,
        min(o_orderkey) % 40 + 1 as lookback_days, 80000 as batch_limit, count(*) as revision
    from orders group by 1, 2)"""
_STATES = f"""states as (
    select o_custkey as account_id, {_API} as api_type, max(o_orderdate) as cursor_timestamp,
        case when o_custkey % 4 > 0 then max('S' || cast(o_orderkey as string)) end as cursor_key
    from orders where o_orderstatus = 'F' group by o_custkey, 2)"""
add(
    "initial_cursor",
    [
        _CONFIGS,
        _STATES,
        """result as (
    select c.account_id, c.api_type, s.cursor_key,
        case when s.cursor_timestamp is null then timestamp '2026-06-01 12:00:00' - to_days(cast(lookback_days as int))
             else s.cursor_timestamp end as cursor_timestamp
    from configs c left join states s on s.account_id = c.account_id and s.api_type = c.api_type)""",
    ],
    "result",
    as_is="account_id api_type cursor_key",
    at="cursor_timestamp",
)

_FEED_ROWS = "feed_rows as (select *, last_change_date as row_at, record_key as row_key from order_rows)"
_BEFORE = f"""before as (
    select account_id, row_at as at, row_key as key from feed_rows f where {FIRST_LOAD}
    qualify row_number() over (partition by account_id order by row_at desc, row_key desc) = 1)"""
_LATER = """later as (
    select f.* from feed_rows f left join before b using (account_id)
    where b.at is null or row_at > b.at or (row_at = b.at and row_key > b.key))"""
_INCREMENTAL = [_ORDER_ROWS, _FEED_ROWS, _BEFORE, _LATER]
add("cursor_filter", _INCREMENTAL, "later", as_is="account_id row_key position", at="row_at")
_AFTER = """after as (
    select b.account_id, 'orders' as api_type, coalesce(t.row_at, b.at) as cursor_timestamp,
        coalesce(t.row_key, b.key) as cursor_key,
        (select count(*) from later l where l.account_id = b.account_id) as rows_kept,
        t.row_at is not null as moved
    from before b left join (
        select * from later qualify row_number() over (
            partition by account_id order by row_at desc, row_key desc) = 1) t
    on t.account_id = b.account_id)"""
add(
    "cursor_advance",
    [*_INCREMENTAL, _AFTER],
    "after",
    as_is="account_id api_type cursor_key moved",
    int="rows_kept",
    at="cursor_timestamp",
)
add(
    "load_progress",
    [
        *_INCREMENTAL,
        _AFTER,
        """result as (
    select account_id, api_type, rows_kept,
        (select count(*) from feed_rows f where f.account_id = a.account_id) as rows_read,
        case when rows_kept > 0 then 'success' else 'noop' end as status,
        (select count(*) from feed_rows f where f.account_id = a.account_id) >= 10
            and not moved as stuck
    from after a)""",
    ],
    "result",
    as_is="account_id api_type status stuck",
    int="rows_read rows_kept",
)
add(
    "incremental_load",
    [
        *_INCREMENTAL,
        f"""both_loads as (
    select *, 0 as load from feed_rows where {FIRST_LOAD} union all select *, 1 from later)""",
        _newest("both_loads", "account_id record_key", "load page position", "result"),
    ],
    "result",
    as_is="account_id record_key srid",
    at="last_change_date",
    money="total_price",
)

_WINDOWS = """windows as (
    select id as account_id,
        date_trunc('day', timestamp '1997-05-03 22:30:00' + to_days(cast(id * 30 as int)) + interval 3 hour)
            - interval 3 hour as window_start,
        timestamp '1998-03-06 20:59:59' as window_end,
        case when id % 2 = 1 then 20000 else 0 end as after_line
    from accounts)"""
add(
    "settlement_window",
    [
        _lines("day"),
        ACCOUNTS,
        _WINDOWS,
        """result as (
    select l.account_id, date_from, count(*) as lines, window_start, window_end,
        date_from >= window_start and date_from <= window_end as inside
    from lines l join windows w on w.account_id = l.account_id group by all)""",
    ],
    "result",
    as_is="account_id inside",
    int="lines",
    at="date_from window_start window_end",
)
_BACKLOG = """backlog as (
    select l.* from lines l join windows w on w.account_id = l.account_id
    where date_from >= window_start and date_from <= window_end and rrd_id > after_line)"""
add(
    "settlement_resume",
    [_lines("day"), ACCOUNTS, _WINDOWS, _BACKLOG],
    "backlog",
    as_is="account_id report_id rrd_id",
    at="date_from",
)
add(
    "settlement_checkpoint",
    [
        _lines("day"),
        ACCOUNTS,
        _WINDOWS,
        _BACKLOG,
        """result as (
    select w.account_id, timestamp '1998-03-05 21:00:00' as cursor_timestamp, cast(null as string) as cursor_key,
        count(rrd_id) as rows_written, case when count(rrd_id) > 0 then 'success' else 'noop' end as status,
        cast(max(rrd_id) as string) as checkpoint_key
    from windows w left join backlog b on b.account_id = w.account_id group by w.account_id)""",
    ],
    "result",
    as_is="account_id cursor_key status checkpoint_key",
    int="rows_written",
    at="cursor_timestamp",
)

# ------------------------------------------------------------ weekly reports

_ISO = "'%Y-%m-%dT%H:%M:%S'"
_LIST = f"""listed as (
    select account_id, case when report_id % 37 > 0 then report_id end as reportId,
        min(date_from) as starts, case when report_id % 3 > 0 then max(date_to) end as ends,
        strftime(min(date_from), {_ISO}) as dateFrom,
        case when report_id % 3 > 0 then strftime(max(date_to), {_ISO}) end as dateTo,
        case when report_id % 4 > 0 then strftime(max(create_date), {_ISO}) else '' end as createDate
    from lines group by account_id, report_id)"""
_HAVE = (
    "have as (select distinct account_id, report_id from lines "
    "where year(date_from) < 1997 and account_id <> 2)"
)
add(
    "report_list",
    [
        _lines("week"),
        _LIST,
        """result as (
    select * from listed
    where coalesce(ends, starts) - interval 3 hour >= timestamp '1997-05-09 21:00:00'
      and starts - interval 3 hour <= timestamp '1998-03-06 20:59:59')""",
    ],
    "result",
    as_is="account_id reportId dateFrom dateTo createDate",
)
add(
    "existing_reports",
    [
        _lines("week"),
        _LIST,
        _HAVE,
        "result as (select h.* from have h where (account_id, report_id) in "
        "(select account_id, reportId from listed where reportId is not null))",
    ],
    "result",
    as_is="account_id report_id",
)
add(
    "missing_reports",
    [
        _lines("week"),
        _LIST,
        _HAVE,
        """result as (
    select account_id, reportId as report_id,
        case when createDate <> '' then createDate else coalesce(dateTo, dateFrom) end as listed_at
    from listed l where reportId is not null
      and not exists (select 1 from have h where h.account_id = l.account_id and h.report_id = reportId))""",
    ],
    "result",
    as_is="account_id report_id listed_at",
)
add(
    "report_lines",
    [
        _RAW_LINES,
        "result as (select account_id, report_id as reportId, count(*) as lines from raw_lines "
        "where report_id % 37 > 0 and report_id % 3 = 0 group by all)",
    ],
    "result",
    as_is="account_id reportId",
    int="lines",
)
add(
    "hydrate_reports",
    [
        _lines("week"),
        """paged as (
    select account_id, case when rrd_id % 31 > 0 then report_id end as report_id, rrd_id, rrd_id % 7 as page
    from lines)""",
        """first_seen as (
    select account_id, report_id, min(page) as page from paged where report_id is not null group by all)""",
        "whole as (select account_id, report_id, rrd_id from lines where year(date_from) >= 1996)",
        """result as (
    select w.* from whole w where (account_id, report_id) in (select account_id, report_id from first_seen)
    union all
    select p.account_id, p.report_id, rrd_id from paged p join first_seen f
        on f.account_id = p.account_id and f.report_id = p.report_id and f.page = p.page
    where (p.account_id, p.report_id) not in (select account_id, report_id from whole)
    union all
    select account_id, report_id, rrd_id from paged
    where (account_id, page) not in (select account_id, page from first_seen))""",
    ],
    "result",
    as_is="account_id report_id rrd_id",
)
add(
    "changed_since",
    [
        _ORDER_ROWS,
        "result as (select account_id, count(*) as rows from order_rows "
        "where last_change_date >= timestamp '1998-01-01' group by account_id)",
    ],
    "result",
    as_is="account_id",
    int="rows",
)
_REGISTRY["supplies_listed"] = """
select o_orderkey % 10 - o_orderkey % 2 as account_id, o_orderkey as position,
    case when o_orderkey % 9 = 0 then '' else cast(o_orderkey - o_orderkey % 2 as string) end as "supplyID",
    cast(o_orderkey % 8 as string) as "statusID"
from orders where o_orderkey % 8 between 1 and 6
  and cast(o_orderdate as date) between date '1996-03-31' and date '1999-03-31'"""
_FIRST = """firsts as (
    select * from supply_rows qualify row_number() over (partition by account_id, supply_key order by position) = 1)"""
add(
    "first_listing",
    [_SUPPLY_ROWS, _FIRST],
    "firsts",
    as_is="account_id supply_key position phone",
)
add(
    "supplies_assemble",
    [
        _SUPPLY_ROWS,
        _FIRST,
        """fetched as (
    select account_id, supply_key, count(*) as details, sum(least(o_orderkey % 4, 3)) as goods,
        sum(case when supply_id is not null then o_orderkey % 3 + 1 else 0 end) as packages
    from supply_rows where o_orderkey % 8 <> 5 group by all)""",
        """result as (
    select f.account_id, f.supply_key, f.position, coalesce(details, 0) as details,
        coalesce(goods, 0) as goods, coalesce(packages, 0) as packages
    from firsts f left join fetched using (account_id, supply_key))""",
    ],
    "result",
    as_is="account_id supply_key position",
    int="details goods packages",
)

# ------------------------------------------------------------ control

_SHOPS = f"shops as ({_select(fx.SHOPS, 'customer')})"
_FEED_LIST = """feeds as (
    select c.* exclude (enabled), account_code, account_name, token_env_var,
        c.enabled and s.enabled as enabled
    from configs c join shops s on s.id = c.account_id)"""
_FEED_OUTPUT = {
    "as_is": "id account_id account_code account_name token_env_var api_type enabled",
    "int": "schedule_seconds lookback_days batch_limit revision",
}
add("feed_configs", [_CONFIGS, _SHOPS, _FEED_LIST], "feeds", **_FEED_OUTPUT)
add(
    "feed_configs_orders",
    [_CONFIGS, _SHOPS, _FEED_LIST],
    "feeds where api_type = 'orders'",
    **_FEED_OUTPUT,
)
add(
    "feed_state",
    [_STATES],
    "states where account_id = 8 and api_type = 'orders'",
    as_is="account_id api_type cursor_key",
    at="cursor_timestamp",
)

_EVENTS = f"""log as (
    select user_id as account_id, {fx.API_BY_NUMBER.format(n='event_id')} as api_type,
        'run-' || cast(event_id as string) as run_id, event_id as id, event_id * 10 + step as seq,
        ts + to_seconds(step * 20) as at, kind,
        case when kind = 'success' then event_id % 1000 end as rows_written,
        case when kind in ('checkpoint', 'success') then date_trunc('day', ts) end as cursor_timestamp,
        case when kind in ('checkpoint', 'success') and event_id % 7 > 0
             then 'K' || cast(event_id as string) end as cursor_key,
        case when kind in ('error', 'interrupted') then left(repeat(event_type, 1000), 4000) end as message
    from (
        select *, 0 as step, 'started' as kind from events
        union all select *, 1, 'checkpoint' from events where event_id % 3 = 0
        union all select *, 2, ['error', 'interrupted', 'success'][event_id % 4 + 1] from events where event_id % 4 < 3
        union all select *, 3, ['success', 'interrupted'][event_id % 5 + 1] from events where event_id % 5 < 2))"""


def _last_of(kinds: str, value: str) -> str:
    return f'(max_by({value}, row("at", seq)) filter (kind in ({kinds})))'


_STATE = f"""state as (
    select account_id, api_type,
        {_last_of("'checkpoint', 'success'", "{'v': cursor_timestamp}")}.v as cursor_timestamp,
        {_last_of("'checkpoint', 'success'", "{'v': cursor_key}")}.v as cursor_key,
        max("at") filter (kind = 'started') as last_started_at,
        max("at") filter (kind in ('success', 'error', 'interrupted')) as last_finished_at,
        max("at") filter (kind = 'success') as last_success_at,
        {_last_of("'success', 'error', 'interrupted'", "{'v': case when kind <> 'success' then l.at end}")}.v as last_error_at,
        {_last_of("'success', 'error', 'interrupted'", "{'v': message}")}.v as last_error_message,
        max("at") as heartbeat_at, max_by(run_id, row("at", seq)) as run_id,
        case max_by(kind, row("at", seq)) when 'success' then 'idle' when 'error' then 'error'
            when 'interrupted' then 'stopped' else 'running' end as status
    from log l group by all)"""
_STATE_TIMES = "cursor_timestamp last_started_at last_finished_at last_success_at last_error_at heartbeat_at"
add(
    "state_from_events",
    [_EVENTS, _STATE],
    "state",
    as_is="account_id api_type cursor_key last_error_message run_id status",
    at=_STATE_TIMES,
)
add(
    "state_report",
    [_EVENTS, _STATE],
    "state",
    as_is="account_id api_type status last_error_message",
    at="cursor_timestamp last_success_at last_error_at",
)
# A run has at most one event per step, so its outcome can be read step by step.
_RUNS = """runs as (
    select s.account_id, s.api_type, s.run_id, s.id, s.at as started_at,
        case when b.kind in ('success', 'error') then b.at when a.kind is not null then a.at else b.at end as finished_at,
        case when b.kind = 'success' then 'success' when a.kind = 'interrupted' then 'stopped'
             when a.kind is not null then a.kind when b.kind is not null then 'stopped' else 'running' end as status,
        coalesce(b.rows_written, a.rows_written, 0) as rows_written,
        coalesce(a.message, case when a.kind is null then b.message end) as error_message
    from log s
    left join (select * from log where seq % 10 = 2) a on a.run_id = s.run_id
    left join (select * from log where seq % 10 = 3) b on b.run_id = s.run_id
    where s.kind = 'started')"""
_RUN_OUTPUT = {
    "as_is": "account_id api_type status error_message",
    "int": "rows_written",
    "at": "started_at finished_at",
}
add(
    "run_ledger",
    [_EVENTS, _RUNS],
    "runs",
    as_is="account_id api_type run_id id status error_message",
    int="rows_written",
    at="started_at finished_at",
)
add(
    "orphan_runs",
    [
        _EVENTS,
        """result as (select account_id, api_type, run_id, s.at as started_at, timestamp '2026-06-01 12:00:00' as finished_at,
        'stopped' as status, 'run did not end' as error_message from log s
    where kind = 'started' and not exists (
        select 1 from log e where e.run_id = s.run_id and e.kind in ('success', 'error', 'interrupted')))""",
    ],
    "result",
    as_is="account_id api_type run_id status error_message",
    at="started_at finished_at",
)
add(
    "recent_runs",
    [_EVENTS, _RUNS, "newest as (select * from runs order by id desc limit 20)"],
    "newest",
    **_RUN_OUTPUT,
)
add(
    "load_counts",
    [
        _ORDER_ROWS,
        _SALE_ROWS,
        _lines("day"),
        """result as (
    select 'orders' as table_name, count(distinct (account_id, record_key)) as rows from order_rows
    union all select 'sales', count(distinct (account_id, record_key)) from sale_rows
    union all select 'settlement_daily', count(*) from lines)""",
    ],
    "result",
    as_is="table_name",
    int="rows",
)
_REGISTRY["constraint_report"] = f"""
with {_CONFIGS}, {_ORDER_ROWS}, {_RAW_LINES}, {_SHOPS},
sources as ({_select(fx.PRICE_SOURCES, 'pages')}),
report(table_name, check_name, violations) as (
    select 'feed_configs', 'api_type is known', 0
    union all select 'feed_configs', 'schedule_seconds is positive', count(*) from configs where schedule_seconds <= 0
    union all select 'feed_configs', 'lookback_days is positive', count(*) from configs where lookback_days <= 0
    union all select 'feed_configs', 'batch_limit is positive', count(*) from configs where batch_limit <= 0
    union all select 'price_sources', 'source_type is known', count(*) from sources where source_type <> 'product_page'
    union all select 'price_sources', 'schedule_seconds is positive', count(*) from sources where schedule_seconds <= 0
    union all select 'orders', 'record_key is not null', count(*) from order_rows where record_key is null
    union all select 'orders', 'last_change_date is not null', count(*) from order_rows where last_change_date is null
    union all select 'settlement_weekly', 'report_id is not null', count(*) from raw_lines where report_id is null
    union all select 'settlement_weekly', 'rrd_id is not null', count(*) from raw_lines where rrd_id is null
    union all select 'settlement_weekly', 'kiz is not null', count(*) from raw_lines where kiz is null
    union all select 'feed_configs', 'key is unique', 0
    union all select 'orders', 'key is unique', count(*) from (
        select 1 from order_rows group by account_id, record_key having count(*) > 1)
    union all select 'settlement_weekly', 'key is unique', count(*) from (
        select 1 from raw_lines group by account_id, report_id, rrd_id having count(*) > 1)
    union all select 'feed_configs', 'account exists', count(*) from configs
        where account_id not in (select id from shops where enabled))
select table_name, check_name, cast(violations as bigint) as violations from report"""

# ------------------------------------------------------------ stored tables

for _name in ("stored_orders", "streamed_orders", "streamed_pages"):
    # Pages 0 and 2, then page 1; a stream's batches count as one load.
    _load = "case when page = 1 then 1 else 0 end" if _name == "stored_orders" else "0"
    add(
        _name,
        [
            _ORDER_ROWS,
            f"loads as (select *, {_load} as load from order_rows)",
            _newest("loads", "account_id record_key", "load page position", "result"),
        ],
        "result",
        as_is="account_id record_key srid",
        at="last_change_date",
        money="total_price",
    )

add(
    "stored_sales",
    [
        _SALE_ROWS,
        "loads as (select *, l_linenumber = 1 as load from sale_rows)",
        _newest("loads", "account_id record_key", "load " + " ".join(fx.SALE_ARRIVAL), "result"),
    ],
    "result",
    as_is="account_id record_key nm_id",
    at="last_change_date",
    money="total_price for_pay",
)

# ------------------------------------------------------------ runs

_RUN_ROWS = {"as_is": "part account_id item status", "at": "moment", "money": "a b c"}
_STORED_ORDER = "select 'order', account_id, record_key, srid, last_change_date, total_price, finished_price, nm_id"


def _idle(moment: str) -> str:
    """The states after runs whose cursor is a time."""
    return f"select 'state', id, null, 'idle', {moment}, null, null, null from accounts"


add(
    "change_runs",
    [
        ACCOUNTS,
        _ORDER_ROWS,
        """loads as (select *, case when account_id <> 4 and last_change_date < timestamp '1997-01-01 00:00:00'
        then 1 else 2 end as load from order_rows)""",
        _newest("loads", "account_id record_key", "load page position", "kept"),
        f"""all_rows as (
    select 'run' as part, id as account_id, cast(number as string) as item,
        case when id = 4 and number = 1 then 'error' else 'success' end as status,
        timestamp '2026-06-01 11:59:00' + to_minutes(number) as moment,
        (select count(*) from loads l where l.account_id = id and l.load = number) as a, null as b, null as c
    from accounts, unnest([1, 2, 3]) n(number)
    union all
    select 'state', id, (select arg_max(record_key, row(last_change_date, record_key)) from order_rows r where r.account_id = id),
        'idle', (select max(last_change_date) from order_rows r where r.account_id = id), null, null, null
    from accounts
    union all
    {_STORED_ORDER} from kept)""",
    ],
    "all_rows",
    **_RUN_ROWS,
)
add(
    "weekly_run",
    [
        ACCOUNTS,
        _RAW_LINES,
        _lines("week"),
        f"""all_rows as (
    select 'run' as part, id as account_id, cast(number as string) as item, 'success' as status,
        timestamp '2026-06-01 11:59:00' + to_minutes(number) as moment,
        (select count(*) from raw_lines l where l.account_id = id and l.report_id % 2 = number - 1) as a,
        null as b, null as c
    from accounts, unnest([1, 2]) n(number)
    union all
    {_idle("timestamp '2026-06-01 20:59:59'")}
    union all
    select 'line', account_id, report_id || ':' || rrd_id, seller_oper_name, date_from, for_pay, quantity, delivery_service
    from lines)""",
    ],
    "all_rows",
    **_RUN_ROWS,
)
add(
    "stock_run",
    [
        ACCOUNTS,
        _STOCK_ROWS,
        _CURRENT_STOCK,
        f"""all_rows as (
    select 'run' as part, id as account_id, cast(number as string) as item, 'success' as status,
        timestamp '2026-05-31 12:00:00' + to_days(number) as moment,
        (select count(*) from stock_rows s where s.account_id = id and (s.l_linestatus = 'F') = (number = 1)
            and (number = 1 or id <= 3)) as a, null as b, null as c
    from accounts, unnest([1, 2]) n(number) where id <> 5 or number = 1
    union all
    {_idle("case when id = 5 then timestamp '2026-06-01 12:00:00' else timestamp '2026-06-02 12:00:00' end")}
    union all
    select 'stock', account_id, concat_ws(':', nm_id, barcode, tech_size, warehouse_name), brand || '/' || vendor_code,
        null, quantity, null, null from result)""",
    ],
    "all_rows",
    **_RUN_ROWS,
)
_OF_KEPT = "where (account_id, supply_key) in (select account_id, supply_key from kept)"
add(
    "supplies_run",
    [
        ACCOUNTS,
        _SUPPLY_ROWS,
        _HEADS,
        _DETAILS,
        _GOODS,
        _PACKAGES,
        _BARCODES,
        # Of two orders that share a supply number the first listed counts.
        """kept as (select * from heads
    where o_orderkey % 8 between 1 and 6 and o_orderdate >= timestamp '1995-01-01 00:00:00'
        and account_id in (select id from accounts)
    qualify row_number() over (partition by account_id, supply_key order by position) = 1)""",
        f"own_details as (from details {_OF_KEPT})",
        f"own_goods as (from goods {_OF_KEPT})",
        f"own_packages as (from packages {_OF_KEPT} and supply_id is not null)",
        f"own_barcodes as (from barcodes {_OF_KEPT} and supply_id is not null)",
        _newest("own_details", "account_id supply_key", "position", "last_details"),
        _newest("own_packages", "account_id supply_key package_code", "position package_position", "last_packages"),
        _newest(
            "own_barcodes",
            "account_id supply_key package_code barcode",
            "position package_position barcode_position",
            "last_barcodes",
        ),
        """handled as (
    select account_id from kept union all select account_id from own_details union all select account_id from own_goods
    union all select account_id from own_packages union all select account_id from own_barcodes)""",
        """stored as (
    select 'supplies' as part, account_id, supply_key, phone as item from kept
    union all select 'supply_details', account_id, supply_key, cast(cast(acceptance_cost as decimal(18,6)) as string)
        from last_details
    union all select 'supply_goods', account_id, supply_key, concat(barcode, '/', quantity) from own_goods
    union all select 'supply_packages', account_id, supply_key, concat(package_code, '/', quantity) from last_packages
    union all select 'supply_package_barcodes', account_id, supply_key, concat(package_code, '/', barcode, '/', quantity)
        from last_barcodes)""",
        f"""all_rows as (
    select 'run' as part, id as account_id, '1' as item, 'success' as status, timestamp '2026-06-01 12:00:00' as moment,
        (select count(*) from handled h where h.account_id = id) as a, null as b, null as c
    from accounts
    union all
    {_idle("timestamp '2026-06-01 20:59:59'")}
    union all
    select part, account_id, supply_key, item, null, null, null, null from stored)""",
    ],
    "all_rows",
    **_RUN_ROWS,
)

_HALF = "(select max(l_orderkey) // 2 * 10 from lineitem)"
add(
    "settlement_run",
    [
        *_facts(_SQUARED),
        # What lies behind each account's checkpoint, the highest line of the lower half.
        f"""landed_lines as ({_select(fx.line_mapping('day'), 'lineitem join orders on l_orderkey = o_orderkey')})""",
        f"""marks as (select account_id, max(rrd_id) as reached, count(*) as first_rows
    from landed_lines where rrd_id <= {_HALF} group by account_id)""",
        """behind as (select account_id, count(*) as later_rows
    from landed_lines join marks using (account_id) where rrd_id > reached group by account_id)""",
        """all_rows as (
    select 'run' as part, a.id as account_id, number as item,
        case when number = '1' then 'stopped' when a.id = 4 and number = '2' then 'error' else 'success' end as status,
        case number when '1' then timestamp '2026-06-01 12:01:00' when '2' then timestamp '2026-06-01 12:01:00'
            else timestamp '2026-06-01 12:02:00' end as moment,
        case when number = (case when a.id = 4 then '3' else '2' end) then later_rows else 0 end as a,
        null as b, null as c
    from accounts a join behind on behind.account_id = a.id, unnest(['1', '2', '3']) n(number)
    union all
    select 'state', id, null, 'idle', timestamp '2026-05-31 21:00:00', null, null, null from accounts
    union all
    select 'line', account_id, report_id || ':' || rrd_id, seller_oper_name, date_from, for_pay, quantity, delivery_service
    from lines
    union all
    select 'fact', account_id, cast(nm_id as string), vendor_code, null, buyout_ratio_sum, logistics_cost_total, buyout_units
    from result)""",
    ],
    "all_rows",
    **_RUN_ROWS,
)
add(
    "quarantine_runs",
    [
        ACCOUNTS,
        _ORDER_ROWS,
        """broken as (select o_custkey % 5 + 1 as account_id from orders
    where (o_custkey % 5 + 1 = 2 and o_orderkey % 50 = 0) or (o_custkey % 5 + 1 = 4 and o_orderkey % 100 = 1)
    group by all)""",
        f"""all_rows as (
    select 'run' as part, id as account_id, number as item,
        case when number = '1' and id in (select account_id from broken) then 'error' else 'success' end as status,
        case number when '1' then timestamp '2026-06-01 12:00:00' else timestamp '2026-06-01 12:01:00' end as moment,
        case when (number = '1') = (id not in (select account_id from broken))
            then (select count(*) from order_rows r where r.account_id = id) else 0 end as a, null as b, null as c
    from accounts, unnest(['1', '2']) n(number)
    union all
    select 'state', id, (select arg_max(record_key, row(last_change_date, record_key)) from order_rows r where r.account_id = id),
        'idle', (select max(last_change_date) from order_rows r where r.account_id = id), null, null, null
    from accounts
    union all
    {_STORED_ORDER} from (
        select * from order_rows
        qualify row_number() over (partition by account_id, record_key order by page desc, position desc) = 1))""",
    ],
    "all_rows",
    **_RUN_ROWS,
)
_REGISTRY["identity_update"] = _REGISTRY["unit_identity"]
_REGISTRY["facts_update"] = _REGISTRY["article_facts"]
_REGISTRY["state_stream"] = _REGISTRY["state_from_events"]
