"""Purchase-order level summaries: receipts, approvals, totals per currency, worklists."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyweave.functions.amounts import line_amount
from tallyweave.functions.texts import SHOWN
from tallyweave.operators.checks import unique_rows
from tallyweave.operators.hot_keys import HOT_ROWS, lookup

# Fixed value: the status that takes a line or header out of the summary.
CANCELLED = "CANCELLED"


def live_headers(headers: DataFrame) -> DataFrame:
    """Headers that are not cancelled; a header without a status is dropped. A repeated id is an error, whatever its status."""
    return unique_rows(headers, "header_id", "status", what="order headers", where=F.col("status") != CANCELLED).select("header_id")


def receipt_summary(lines: DataFrame, headers: DataFrame) -> DataFrame:
    """Per order number: supplier, ordered value, received flag, suspended flag.

    Lines are summed per header before the join, so an order with very many lines reaches the
    join as one row. A line without a status counts as cancelled. An order whose lines are all
    cancelled is received; one whose open quantities are all unknown is not.
    """
    live = F.col("status") != CANCELLED
    value = F.coalesce("unit_cost", F.lit(0)) * F.col("qty_ordered")
    per_header = lines.groupBy("header_id", "header_number").agg(
        F.max("partner_name").alias("supplier_name"),
        F.sum(F.when(live, value).otherwise(0)).alias("total_amount"),
        F.max(F.coalesce(live & F.col("is_suspended"), F.lit(False))).alias("has_suspended_line"),
        F.sum(F.when(live, F.col("qty_ordered") - F.col("qty_completed")).otherwise(0)).alias("open_qty"),
    )
    return (
        per_header.join(live_headers(headers), "header_id")
        .groupBy(F.col("header_number").alias("po_number"))
        .agg(
            F.max("supplier_name").alias("supplier_name"),
            F.sum("total_amount").alias("total_amount"),
            F.max("has_suspended_line").alias("has_suspended_line"),
            F.coalesce(F.sum("open_qty") <= 0, F.lit(False)).alias("is_fully_received"),
        )
    )


def approvals_by_po(approvals: DataFrame, issues: DataFrame, *, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Per order number: the authorised amount over all approvals that cite it, and their highest status."""
    written = [name for name in approvals.columns if name == f"po_number{SHOWN}"]
    cited = approvals.filter(F.col("po_number").isNotNull()).select("issue_id", "po_number", "total_cost", *written)
    known = unique_rows(issues, "issue_id", "status", what="issues")
    with_status = lookup(cited, known, ["issue_id"], ["issue_id", "po_number"], how="inner", hot_rows=hot_rows)
    return with_status.groupBy("po_number").agg(
        F.sum("total_cost").alias("authorized_amount"),
        F.max("status").alias("approval_status"), *[F.min(name).alias(name) for name in written],
    )


HEADER_COLUMNS = ("purchase_order_id", "order_number", "site_code", "partner_code", "partner_name")


def totals_by_currency(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Per order and currency: line value and line count. Lines without a currency form their own row.

    Lines are summed before the join; the join then meets one row per order and currency.
    """
    per_currency = lines.groupBy("purchase_order_id", "currency_code").agg(
        F.sum("line_amount").alias("total_amount"), F.count("*").alias("line_count"),
    )
    return (
        orders.select(*HEADER_COLUMNS).join(per_currency, "purchase_order_id")
        .groupBy(*HEADER_COLUMNS, "currency_code")
        .agg(F.sum("total_amount").cast("decimal(28,4)").alias("total_amount"),
             F.sum("line_count").alias("line_count"))
    )


def site_directory(work_centers: DataFrame) -> DataFrame:
    """Known (site_code, site_id) pairs."""
    return work_centers.select("site_code", "site_id").dropna().distinct()


def order_worklist(known: DataFrame, discovered: DataFrame | None = None, sites: DataFrame | None = None) -> DataFrame:
    """Distinct (site_code, order_number) pairs to pull: landed before, or newly discovered.

    Discovered orders without a number, with an empty one, or without a site are ignored, and with a directory of ``sites``
    those of a site that it does not list.
    """
    pairs = known.select("site_code", "order_number").dropna()
    if discovered is not None:
        found = discovered.select("site_code", "order_number").filter("order_number <> '' and site_code is not null")
        if sites is not None:
            found = found.join(sites.select("site_code").distinct(), "site_code", "left_semi")
        pairs = pairs.unionByName(found)
    return pairs.distinct()


def require_rows(df: DataFrame, message: str) -> DataFrame:
    """``df`` itself; an error when it has no rows."""
    if df.isEmpty():
        raise ValueError(message)
    return df


def with_line_amount(lines: DataFrame, quantity: str = "quantity_ordered", unit_cost: str = "unit_cost") -> DataFrame:
    return lines.withColumn("line_amount", line_amount(F.col(quantity), F.col(unit_cost)))
