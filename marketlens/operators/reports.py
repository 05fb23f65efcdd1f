"""Weekly settlement reports: which to load, and from which of two sources."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.functions.values import blank_to_null
from marketlens.operators.lookup import lookup

REPORT = ["account_id", "report_id"]


def existing_reports(stored_lines: DataFrame, candidates: DataFrame) -> DataFrame:
    """Candidate reports that already have stored lines."""
    # Distinct first: a report of any size is one row per task from here on.
    stored = stored_lines.select(*REPORT).distinct()
    return stored.join(candidates.select(*REPORT).distinct(), REPORT, "left_semi")


def missing_reports(report_list: DataFrame, stored_lines: DataFrame) -> DataFrame:
    """Listed reports without stored lines, with ``listed_at`` to order them by:
    the first filled of createDate, dateTo, dateFrom. Report numbers are unique
    in a list, rows without one are skipped."""
    listed_at = F.coalesce(*[blank_to_null(F.col(c)) for c in ("createDate", "dateTo", "dateFrom")])
    listed = report_list.filter(F.col("reportId").isNotNull()).select(
        "account_id", F.col("reportId").alias("report_id"), listed_at.alias("listed_at")
    )
    return listed.join(existing_reports(stored_lines, listed), REPORT, "left_anti")


def load_order(missing: DataFrame) -> DataFrame:
    return missing.orderBy("account_id", "listed_at", F.coalesce("report_id", F.lit(0)))


def hydrate_reports(page_lines: DataFrame, full_lines: DataFrame, page: str = "page") -> DataFrame:
    """Lines to store for paged settlement lines.

    A report is decided on the first page it shows up on: all its lines from
    ``full_lines`` if there are any, else its lines on that page. Its lines on
    later pages are ignored, as are lines without a report number. A page on
    which no report is decided is stored as it is.

    ``full_lines`` has the columns of ``page_lines`` but for ``page``.
    """
    columns = [c for c in page_lines.columns if c != page]
    first_page = (
        page_lines.filter(F.col("report_id").isNotNull())
        .groupBy(*REPORT)
        .agg(F.min(page).alias("_first"))
    )
    full = full_lines.select(*columns)
    authoritative = lookup(full, first_page, REPORT, "left_semi")

    decided = first_page.join(full.select(*REPORT).distinct(), REPORT, "left_anti")
    fallback = (
        lookup(page_lines.filter(F.col("report_id").isNotNull()), decided, REPORT, "inner")
        .filter(F.col(page) == F.col("_first"))
        .select(*columns)
    )
    deciding_pages = first_page.select("account_id", F.col("_first").alias(page)).distinct()
    untouched = lookup(page_lines, deciding_pages, ["account_id", page], "left_anti")
    return authoritative.unionByName(fallback).unionByName(untouched.select(*columns))
