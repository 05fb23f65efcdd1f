"""Settlement operation names and the signs they carry in each money measure."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Operation names as they appear in the feed.
SALE = "Продажа"
RETURN = "Возврат"
VOLUNTARY_RETURN_COMPENSATION = "Добровольная компенсация при возврате"
LOYALTY_COMPENSATION = "Компенсация скидки по программе лояльности"
ACQUIRING_ADJUSTMENT = "Корректировка эквайринга"
RETURNS_CORRECTION = "Коррекция возвратов"
SALES_CORRECTION = "Коррекция продаж"

# Label of report type 1, placeholder for a missing attribute,
# and the unit cost that stands for "nobody has entered a cost yet".
MAIN_REPORT = "Основной"
NOT_AVAILABLE = "N/A"
UNKNOWN_COST = 999999999

# +1 adds to the seller's turnover, -1 takes from it, absent does not count.
TURNOVER_SIGNS = {SALE: 1, RETURN: -1}
PAYOUT_SIGNS = {
    SALE: 1,
    RETURN: -1,
    VOLUNTARY_RETURN_COMPENSATION: 1,
    RETURNS_CORRECTION: 1,
    SALES_CORRECTION: -1,
    ACQUIRING_ADJUSTMENT: 1,
}


def signed(amount: Column, signs: dict[str, int], operation: Column | None = None) -> Column:
    """``amount`` with the sign its operation carries; null and unlisted count 0.

    The type of ``amount`` is kept, so a sum over the result is exact.
    """
    operation = F.col("seller_oper_name") if operation is None else operation
    plus = [name for name, sign in signs.items() if sign > 0]
    minus = [name for name, sign in signs.items() if sign < 0]
    value = F.when(operation.isin(plus), amount).when(operation.isin(minus), -amount)
    return F.coalesce(value, F.lit(0))


def or_zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0))
