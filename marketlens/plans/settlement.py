"""Settlement reports: per report, per SKU, per line, and the SKU reference."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.functions import operations as op
from marketlens.functions.dates import local_date, week_start
from marketlens.functions.operations import or_zero, signed
from marketlens.functions.values import blank_to_null
from marketlens.operators.lookup import lookup

# Measure name -> line column it sums.
_PLAIN_SUMS = {
    "logistics_cost": "delivery_service",
    "storage_cost": "paid_storage",
    "acceptance_cost": "paid_acceptance",
    "other_deductions_payouts": "deduction",
    "penalties_total": "penalty",
    "reward_adjustment": "additional_payment",
    "loyalty_points_withheld": "cashback_commission_change",
}
_CHARGES = (
    "delivery_service",
    "paid_storage",
    "paid_acceptance",
    "deduction",
    "penalty",
    "cashback_commission_change",
)
_CREDITS = ("cashback_amount", "additional_payment")


def line_total_to_pay() -> Column:
    """What one settlement line adds to the payout."""
    total = signed(F.col("for_pay"), op.PAYOUT_SIGNS)
    for name in _CHARGES:
        total = total - or_zero(name)
    for name in _CREDITS:
        total = total + or_zero(name)
    return total


def _total_to_pay() -> Column:
    """The sum of ``line_total_to_pay``, put together from sums the other measures
    need anyway: no arithmetic per line, and the planner keeps one buffer each."""
    total = F.sum(signed(F.col("for_pay"), op.PAYOUT_SIGNS))
    for name in _CHARGES:
        total = total - F.sum(or_zero(name))
    for name in _CREDITS:
        total = total + F.sum(or_zero(name))
    return total


def _money(column: Column) -> Column:
    return column.cast("decimal(38,6)")


def _loyalty_compensation() -> Column:
    """Cashback, plus the loyalty discount when the group has a voluntary return
    compensation at all. Not additive over groups."""
    operation = F.col("seller_oper_name")
    discount = F.when(operation == op.LOYALTY_COMPENSATION, or_zero("cashback_discount"))
    has_voluntary = F.bool_or(operation == op.VOLUNTARY_RETURN_COMPENSATION)
    extra = F.when(has_voluntary, F.coalesce(F.sum(discount), F.lit(0))).otherwise(F.lit(0))
    return F.sum(or_zero("cashback_amount")) + extra


def _discount_percent() -> Column:
    """Share of the list price given away, in percent; 0 when nothing was sold.

    The operands are narrowed so that the quotient keeps 14 digits before the
    one rounding to 2.
    """
    listed = F.sum(signed(F.col("retail_price"), op.TURNOVER_SIGNS)).cast("decimal(24,6)")
    charged = F.sum(signed(F.col("retail_price_with_disc"), op.TURNOVER_SIGNS)).cast("decimal(24,6)")
    quotient = charged / F.nullif(listed, F.lit(0).cast("decimal(24,6)"))
    return F.coalesce(F.round((1 - quotient) * 100, 2), F.lit(0)).cast("decimal(18,2)")


def _report_type_name() -> Column:
    code = F.max("report_type")
    return F.when(code == 1, F.lit(op.MAIN_REPORT)).otherwise(code.cast("string"))


def _report_measures() -> list[Column]:
    # Per-line signs make every measure one sum, so the map side keeps a single
    # buffer per measure. Days are localised after the min / max over instants,
    # once per group: local days follow the order of instants (the zone last set
    # its clock back across midnight in 1984).
    first_day = local_date(F.min("date_from"))
    measures = [
        week_start(first_day).alias("week_start"),
        first_day.alias("period_from"),
        local_date(F.max("date_to")).alias("period_to"),
        local_date(F.max("create_date")).alias("report_created_date"),
        _report_type_name().alias("report_type_name"),
        _money(F.sum(signed(F.col("retail_amount"), op.TURNOVER_SIGNS))).alias("sale_amount"),
        _money(_loyalty_compensation()).alias("loyalty_discount_compensation"),
        _money(F.sum(signed(F.col("for_pay"), op.PAYOUT_SIGNS))).alias("to_transfer_for_goods"),
        _discount_percent().alias("agreed_discount_percent"),
    ]
    measures += [_money(F.sum(or_zero(c))).alias(name) for name, c in _PLAIN_SUMS.items()]
    measures.append(F.lit(0).cast("decimal(38,6)").alias("loyalty_program_cost"))
    measures.append(_money(_total_to_pay()).alias("total_to_pay"))
    return measures


def _with_account(grouped: DataFrame, accounts: DataFrame) -> DataFrame:
    """Attach the seller's names. Done after grouping, where there is one row per
    report and not one per line; the names depend on the account alone."""
    names = accounts.select(
        F.col("id").alias("account_id"),
        "account_code",
        F.col("account_name").alias("legal_entity_name"),
    )
    return grouped.join(names, "account_id")


def settlement_summary(lines: DataFrame, accounts: DataFrame) -> DataFrame:
    """One row per report and currency (daily or weekly lines)."""
    grouped = lines.groupBy("account_id", "report_id", "currency").agg(*_report_measures())
    return _with_account(grouped, accounts)


def _attribute(name: str) -> Column:
    """Largest filled value of an attribute, N/A when there is none."""
    return F.coalesce(F.max(blank_to_null(F.col(name))), F.lit(op.NOT_AVAILABLE))


_ATTRIBUTES = ("brand_name", "vendor_code", "title", "tech_size")


def _unless(blank: Column, value: Column, default) -> Column:
    return F.when(blank, F.lit(default)).otherwise(value)


# Rows without a vendor code look up no cost. They may be a large share of all
# rows, so the join spreads them over this many codes that match nothing: no
# stored text contains a NUL.
_BLANK_SPREAD = 1009
_BLANK_PREFIX = "\x00"


def _with_unit_cost(
    rows: DataFrame, vendor: Column, current_costs: DataFrame, row_key: list[str]
) -> DataFrame:
    """Add unit_cost: 0 without a vendor code, the current cost, or the value
    that stands for a cost nobody has entered."""
    spread = F.pmod(F.xxhash64(*row_key), F.lit(_BLANK_SPREAD)).cast("string")
    code = F.coalesce(vendor, F.concat(F.lit(_BLANK_PREFIX), spread))
    costs = current_costs.select(
        "account_id", F.col("vendor_code").alias("_code"), F.col("cost").alias("_cost")
    )
    unit_cost = F.when(F.col("_code").startswith(_BLANK_PREFIX), F.lit(0)).otherwise(
        F.coalesce("_cost", F.lit(op.UNKNOWN_COST))
    )
    return (
        lookup(rows.withColumn("_code", code), costs, ["account_id", "_code"])
        .withColumn("unit_cost", unit_cost.cast("decimal(18,6)"))
        .drop("_code", "_cost")
    )


def settlement_by_sku(
    lines: DataFrame, accounts: DataFrame, current_costs: DataFrame
) -> DataFrame:
    """One row per report, SKU and currency, with cost and profit.

    An empty SKU collects lines without a product: its attributes are N/A. A
    null SKU is a different group and keeps its attributes.
    """
    # coalesce: comparing a null SKU with '' is unknown, which means "keep".
    blank_sku = F.coalesce(F.col("sku") == "", F.lit(False))
    quantity = F.sum(signed(F.col("quantity").cast("bigint"), op.TURNOVER_SIGNS))
    grouped = lines.groupBy("account_id", "report_id", "sku", "currency").agg(
        F.max("nm_id").alias("nm_id"),
        *[_attribute(name).alias(name) for name in _ATTRIBUTES],
        quantity.cast("bigint").alias("quantity"),
        *_report_measures(),
    )
    described = grouped.withColumns(
        {
            "nm_id": _unless(blank_sku, F.coalesce("nm_id", F.lit(0)), 0),
            **{n: _unless(blank_sku, F.col(n), op.NOT_AVAILABLE) for n in _ATTRIBUTES},
        }
    )
    vendor = F.nullif(F.col("vendor_code"), F.lit(op.NOT_AVAILABLE))
    priced = (
        _with_unit_cost(described, vendor, current_costs, ["report_id", "sku", "currency"])
        .withColumn("cost", _money(F.col("unit_cost") * F.col("quantity")))
        .drop("unit_cost")
        .withColumn("profit", _money(F.col("total_to_pay") - F.col("cost")))
    )
    return _with_account(priced, accounts)


def settlement_enriched(lines: DataFrame, current_costs: DataFrame) -> DataFrame:
    """Every line with unit_cost, cost, total_to_pay and profit.

    Today's open cost is used, not the cost at the time of the sale.
    """
    vendor = blank_to_null(F.col("vendor_code"))
    sold = signed(F.col("quantity"), op.TURNOVER_SIGNS)
    return (
        _with_unit_cost(lines, vendor, current_costs, ["report_id", "rrd_id"])
        .withColumn("cost", _money(sold * F.col("unit_cost")))
        .withColumn("total_to_pay", _money(line_total_to_pay()))
        .withColumn("profit", _money(F.col("total_to_pay") - F.col("cost")))
    )


def sku_reference(lines: DataFrame) -> DataFrame:
    """Attributes of each SKU over all accounts; null and empty SKU are both N/A."""
    sku = F.coalesce(blank_to_null(F.col("sku")), F.lit(op.NOT_AVAILABLE))
    missing = F.col("sku") == op.NOT_AVAILABLE
    grouped = (
        lines.select(sku.alias("sku"), "nm_id", *_ATTRIBUTES)
        .groupBy("sku")
        .agg(F.max("nm_id").alias("nm_id"), *[_attribute(n).alias(n) for n in _ATTRIBUTES])
    )
    return grouped.withColumns(
        {
            "nm_id": _unless(missing, F.coalesce("nm_id", F.lit(0)), 0),
            **{n: _unless(missing, F.col(n), op.NOT_AVAILABLE) for n in _ATTRIBUTES},
        }
    )
