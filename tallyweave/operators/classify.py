"""The status of a bill against its approval and receipt."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F

from tallyweave.functions.amounts import money

# The status labels in priority order, and the flags derived from them.
NO_PO = "No PO in memo"
NO_APPROVAL = "No approval found"
WITHIN = "Within 10% of approved amount"
OVER = "Over Authorized Amount"
NOT_RECEIVED = "Not yet received"
VALIDATED = "Fully validated"
AWAITING = "Awaiting Invoice"
MATCH, MISMATCH, PENDING = "Match", "Mismatch", "Pending"

# A bill this much over the approval still counts as within it, and the factor up
# to which an overrun is reported as small.
TOLERANCE = Decimal("1.00")
OVERRUN = Decimal("1.10")


def status_bucket(po_number: Column, billed: Column, authorized: Column, received: Column,
                  tolerance: Decimal = TOLERANCE, overrun: Decimal = OVERRUN) -> Column:
    """The first rule that holds. A NULL billed total exceeds nothing, so it passes the amount rules."""
    exceeds = billed > authorized + F.lit(tolerance)
    return (
        F.when(po_number.isNull(), NO_PO)
        .when(authorized.isNull(), NO_APPROVAL)
        .when(exceeds & (billed <= authorized * F.lit(overrun)), WITHIN)
        .when(exceeds, OVER)
        .when(~F.coalesce(received, F.lit(False)), NOT_RECEIVED)
        .otherwise(VALIDATED)
    )


def match_flag(bucket: Column) -> Column:
    return F.when(bucket == VALIDATED, MATCH).when(bucket == AWAITING, PENDING).otherwise(MISMATCH)


def amount_variance(billed: Column, authorized: Column) -> Column:
    return money(billed - authorized)
