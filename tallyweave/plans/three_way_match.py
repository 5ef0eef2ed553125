"""Three-way match: is each vendor bill approved, within the approved amount, and received?

Shape of the job:

1. Bills are filtered, parsed and reduced to the newest record in one pass; the raw JSON does
   not travel through the shuffle. The result is staged, because three consumers read it.
2. Billed total, approval and receipt are brought to one row per order number and staged.
3. Bills look that row up. Orders approved but never billed are the rows of step 2 without a
   bill count, so finding them needs no further join.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from decimal import Decimal
from functools import cached_property

from pyspark.sql import Column, DataFrame, functions as F

from tallyweave.functions import texts
from tallyweave.functions.amounts import money
from tallyweave.functions.times import instant_literal, to_millis
from tallyweave.operators import bills as bill_ops, checks, classify
from tallyweave.operators.hot_keys import HOT_ROWS, heavy_keys, hot_keys, is_small, lookup
from tallyweave.operators.purchase_orders import approvals_by_po, receipt_summary
from tallyweave.sources.staging import Stages
from tallyweave.sources.versioned import VersionedStore

# The output columns in order, their length limits, and the key prefix of rows
# that stand for an order without a bill.
COLUMNS = (
    "bill_id", "po_number", "memo", "invoice_number", "supplier", "bill_amount", "bill_status",
    "payment_status", "bill_submitted_at", "authorized_amount", "approval_status",
    "is_fully_received", "has_suspended_line", "match_flag", "amount_variance", "status_bucket",
    "matched_at",
)
MAX_LENGTH = {
    "bill_id": 64, "po_number": 64, "memo": 500, "invoice_number": 255, "supplier": 255,
    "bill_status": 50, "payment_status": 50, "approval_status": 100, "match_flag": 10,
    "status_bucket": 32,
}
REQUIRED = ("bill_id", "match_flag", "status_bucket", "matched_at")
NO_BILL_PREFIX = "NOINVOICE:"


@dataclass(frozen=True)
class MatchInputs:
    bills: DataFrame
    vendors: DataFrame
    approvals: DataFrame
    issues: DataFrame
    po_lines: DataFrame
    po_headers: DataFrame

    def folded(self) -> MatchInputs:
        """The same inputs with keys and statuses made comparable without case and trailing blanks."""
        return MatchInputs(
            texts.fold_case(self.bills, "bill_type", "status"),
            texts.fold_case(self.vendors, "vendor_id"),
            texts.fold_case(self.approvals, "po_number"),
            self.issues,
            texts.fold_case(self.po_lines, "header_number", "status"),
            texts.fold_case(self.po_headers, "status"),
        )


@dataclass(frozen=True)
class MatchOptions:
    tolerance: Decimal = classify.TOLERANCE
    overrun: Decimal = classify.OVERRUN
    token_prefix: str = "PO_"
    token_length: int = 10
    require_amount: bool = False
    case_insensitive: bool = False
    as_of: dt.datetime | None = None
    hot_rows: int = HOT_ROWS

    def batch_time(self) -> Column:
        """One time for all rows of a run, to the second."""
        now = self.as_of or dt.datetime.now(dt.timezone.utc)
        rounded = (now + dt.timedelta(microseconds=500_000)).replace(microsecond=0)
        return instant_literal(rounded)


def parsed_bills(bills: DataFrame, options: MatchOptions = MatchOptions()) -> DataFrame:
    """The newest record of every bill with the fields of its raw JSON."""
    newest = bill_ops.with_order_number(
        bill_ops.latest(bill_ops.read_texts(bill_ops.only_bills(bills))),
        options.token_prefix, options.token_length, options.case_insensitive,
    )
    if not options.case_insensitive:
        return newest
    written = texts.written_token(F.col("memo"), options.token_prefix, options.token_length, True)
    return texts.fold_case(newest, "vendor_id").withColumn(f"po_number{texts.SHOWN}", written)


def order_facts(parsed: DataFrame, inputs: MatchInputs, options: MatchOptions = MatchOptions()) -> DataFrame:
    """One row per order number that is billed or approved: totals, approval and receipt."""
    billed = bill_ops.billed_totals(parsed)
    approved = approvals_by_po(inputs.approvals, inputs.issues, hot_rows=options.hot_rows).withColumn(
        "is_approved", F.lit(True),
    )
    received = receipt_summary(inputs.po_lines, inputs.po_headers).select(
        "po_number", F.col("supplier_name"), "is_fully_received", "has_suspended_line",
    )
    # Receipts are joined to both sides, which lie by order number already; what a full join gives would be shuffled once more.
    left, right = billed.join(received, "po_number", "left"), approved.join(received, "po_number", "left")
    receipt = [name for name in received.columns if name != "po_number"]
    renamed = right.withColumnsRenamed({name: f"_{name}" for name in receipt})
    facts = left.join(renamed, "po_number", "full").withColumns({name: F.coalesce(name, f"_{name}") for name in receipt})
    return facts.select(
        "po_number", *[name for name in approved.columns if name.endswith(texts.SHOWN)], "bills", "billed_amount", "is_approved", "authorized_amount", "approval_status",
        "supplier_name", "is_fully_received", "has_suspended_line",
    )


def bill_statuses(parsed: DataFrame, facts: DataFrame, options: MatchOptions = MatchOptions()) -> DataFrame:
    """One row per bill with its status, still with the id of its vendor."""
    busy = heavy_keys(facts, ["po_number"], "bills", options.hot_rows)
    per_order = facts.filter("bills is not null").select(
        "po_number", "billed_amount", "authorized_amount", "approval_status", "is_fully_received",
        "has_suspended_line",
    )
    # Bills without an order number have nothing to look up; they and those of busy orders pass no shuffle.
    joined = lookup(parsed, per_order, ["po_number"], ["bill_id"], hot=busy, read_again=True)
    bucket = classify.status_bucket(
        F.col("po_number"), F.col("billed_amount"), F.col("authorized_amount"), F.col("is_fully_received"),
        options.tolerance, options.overrun,
    )
    return joined.select(
        "bill_id", texts.shown(joined, "po_number").alias("po_number"), "memo", "invoice_number", "vendor_id", money(F.col("amount")).alias("bill_amount"),
        texts.shown(joined, "status").alias("bill_status"), "payment_status", to_millis(F.col("submitted_at")).alias("bill_submitted_at"),
        money(F.col("authorized_amount")).alias("authorized_amount"), "approval_status", "is_fully_received",
        "has_suspended_line", bucket.alias("status_bucket"),
        classify.amount_variance(F.col("billed_amount"), F.col("authorized_amount")).alias("amount_variance"),
    ).withColumn("match_flag", classify.match_flag(F.col("status_bucket")))


def billed_rows(parsed: DataFrame, facts: DataFrame, vendors: DataFrame,
                options: MatchOptions = MatchOptions()) -> DataFrame:
    """One row per bill with its status and its vendor's name. Busy vendors are counted in the bills, before their facts are looked up; that
    matters only where the vendors are too many to be sent to every task."""
    known = checks.unique_rows(vendors.select("vendor_id", F.col("vendor_name").alias("supplier")), "vendor_id", "supplier", what="vendors")
    statuses = bill_statuses(parsed, facts, options)
    return lookup(
        statuses, known, ["vendor_id"], ["bill_id"], hot=hot_keys(parsed, ["vendor_id"], options.hot_rows),
        few=is_small(vendors.select("vendor_id", "vendor_name")),
    ).drop("vendor_id")


def awaiting_rows(facts: DataFrame, options: MatchOptions = MatchOptions()) -> DataFrame:
    """One row per approved order that no bill cites. A VOID bill counts as citing it.

    Approvals without an amount are included unless ``require_amount`` is set.
    """
    waiting = facts.filter(F.col("is_approved") & F.col("bills").isNull())
    if options.require_amount:
        waiting = waiting.filter(F.col("authorized_amount").isNotNull())
    return waiting.select(
        texts.concat_empty(F.lit(NO_BILL_PREFIX), texts.shown(facts, "po_number")).alias("bill_id"),
        texts.shown(facts, "po_number").alias("po_number"),
        F.col("supplier_name").alias("supplier"), money(F.col("authorized_amount")).alias("authorized_amount"),
        "approval_status", "is_fully_received", "has_suspended_line",
        F.lit(classify.AWAITING).alias("status_bucket"), F.lit(classify.PENDING).alias("match_flag"),
    )


class Match:
    """The match of the given inputs. Each part is computed when it is first asked for; the parsed bills and the facts per order,
    which several parts read, are staged once. ``release`` (or leaving a ``with`` block) deletes them.

    ``rows``, ``rejects`` (bills whose raw record is not JSON; they stay in the match, without an order number) and ``rollup``.
    """

    def __init__(self, inputs: MatchInputs, options: MatchOptions = MatchOptions()) -> None:
        self.inputs = inputs.folded() if options.case_insensitive else inputs
        self.options = options
        self._stages = Stages()

    @cached_property
    def parsed(self) -> DataFrame:
        return self._stages.stage(bill_ops.matched_columns(parsed_bills(self.inputs.bills, self.options)), "parsed-bills", "zstd")

    @cached_property
    def facts(self) -> DataFrame:
        return self._stages.stage(order_facts(self.parsed, self.inputs, self.options), "order-facts", "zstd")

    @cached_property
    def rows(self) -> DataFrame:
        """All bills and all unbilled approvals, 17 columns."""
        billed = billed_rows(self.parsed, self.facts, self.inputs.vendors, self.options)
        both = billed.unionByName(awaiting_rows(self.facts, self.options), allowMissingColumns=True)
        return both.withColumn("matched_at", self.options.batch_time()).select(*COLUMNS)

    @cached_property
    def rejects(self) -> DataFrame:
        return bill_ops.malformed(self.parsed)

    @cached_property
    def rollup(self) -> DataFrame:
        """``status_rollup`` of the rows, without looking up what it does not show."""
        billed = bill_statuses(self.parsed, self.facts, self.options)
        return status_rollup(billed.unionByName(awaiting_rows(self.facts, self.options), allowMissingColumns=True))

    def release(self) -> None:
        self._stages.release()
        for name in ("parsed", "facts", "rows", "rejects", "rollup"):
            self.__dict__.pop(name, None)

    def __enter__(self) -> Match:
        return self

    def __exit__(self, *error) -> None:
        self.release()


def three_way_match(inputs: MatchInputs, options: MatchOptions = MatchOptions()) -> DataFrame:
    """All bills and all unbilled approvals, 17 columns."""
    return Match(inputs, options).rows


def status_rollup(match: DataFrame) -> DataFrame:
    """Rows and billed money per status."""
    return match.groupBy("status_bucket", "match_flag").agg(
        F.count("*").alias("rows"), F.sum("bill_amount").alias("bill_amount"),
    )


def refresh_match_results(store: VersionedStore, inputs: MatchInputs, options: MatchOptions = MatchOptions(),
                          table: str = "match_results") -> int:
    """Rebuild the match table and the list of unreadable bills. The new version is written once,
    checked, and published only then; on failure the old one stays."""
    with Match(inputs, options) as match, store.commit() as change:
        written = change.replace(table, match.rows)
        new = change.read(table)
        checks.assert_key(new, "bill_id", what=table)
        checks.assert_rows(new, checks.row_violations(REQUIRED, MAX_LENGTH), what=table)
        change.replace(f"{table}_rejects", match.rejects)
    return written


def publish(source: VersionedStore, target: VersionedStore, table: str = "match_results",
            as_table: str = "match_results") -> int:
    """Copy the match table, column for column, to a reporting store; the row counts must agree."""
    rows = source.read(table).select(*COLUMNS)
    expected = rows.count()
    with target.commit() as change:
        written = change.replace(as_table, rows)
        if written != expected:
            raise checks.IntegrityError(f"{as_table}: {written} rows written, {expected} read")
    return written
