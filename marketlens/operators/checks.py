"""Table constraints as counts of violations, and as a guard before a write."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.functions.values import all_of
from marketlens.schemas import API_TYPES

def _row(violations: DataFrame, table: str, check: str) -> DataFrame:
    return violations.select(
        F.lit(table).alias("table_name"), F.lit(check).alias("check_name"), "violations"
    )


def _failing(condition: Column) -> Column:
    # An unknown condition passes, as a check constraint does.
    return F.count_if(F.coalesce(~condition, F.lit(False)))


def rule_violations(rows: DataFrame, table: str, rules: dict[str, Column]) -> DataFrame:
    """Rows breaking each rule. One scan of the table for all its rules."""
    # There is one result row, so unfolding it costs nothing.
    counted = rows.agg(*[_failing(rule).alias(name) for name, rule in rules.items()])
    pairs = [F.struct(F.lit(n).alias("check_name"), F.col(n).alias("violations")) for n in rules]
    return counted.select(F.lit(table).alias("table_name"), F.inline(F.array(*pairs)))


def not_null_rules(columns: Iterable[str]) -> dict[str, Column]:
    return {f"{name} is not null": F.col(name).isNotNull() for name in columns}


def api_type_rule() -> dict[str, Column]:
    return {"api_type is known": F.col("api_type").isin(*API_TYPES)}


def positive_rules(columns: Iterable[str]) -> dict[str, Column]:
    return {f"{name} is positive": F.col(name) > 0 for name in columns}


def source_type_rule(kinds: Iterable[str]) -> dict[str, Column]:
    """``kinds`` of observed price sources are for the deployment to name."""
    return {"source_type is known": F.col("source_type").isin(*kinds)}


def duplicate_keys(rows: DataFrame, table: str, keys: list[str]) -> DataFrame:
    """Keys held by more than one row; a null in a key never equals anything."""
    complete = rows.filter(all_of([F.col(k).isNotNull() for k in keys]))
    repeated = complete.groupBy(*keys).count().filter("count > 1")
    return _row(repeated.agg(F.count("*").alias("violations")), table, "key is unique")


def orphans(rows: DataFrame, table: str, accounts: DataFrame) -> DataFrame:
    """Rows of accounts that do not exist, counted per account before the join."""
    per_account = rows.filter("account_id is not null").groupBy("account_id").count()
    known = accounts.select(F.col("id").alias("account_id"))
    lost = per_account.join(known, "account_id", "left_anti")
    total = lost.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("violations"))
    return _row(total, table, "account exists")


def constraint_report(parts: list[DataFrame]) -> DataFrame:
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report.withColumn("violations", F.col("violations").cast("bigint"))


def require_not_null(rows: DataFrame, columns: Iterable[str]) -> DataFrame:
    """The same rows; a null in any of ``columns`` fails the job that writes them."""
    guarded = {}
    for name in columns:
        failure = F.raise_error(F.lit(f"null in required column {name}"))
        guarded[name] = F.when(F.col(name).isNull(), failure.cast("string")).otherwise(F.col(name))
    types = dict(rows.dtypes)
    return rows.withColumns({n: c.cast(types[n]) for n, c in guarded.items()})
