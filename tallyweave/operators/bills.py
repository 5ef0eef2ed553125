"""Vendor bills: latest record per bill, fields read from the raw JSON, totals per purchase order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tallyweave.functions import texts, variants
from tallyweave.functions.amounts import money

# The bill type that takes part in matching and the status that never counts as billed.
BILL_TYPE = "BILLPAY"
VOID = "VOID"

# Where the fields of a bill are in its raw record.
FIELDS = {
    "memo": ("memo",),
    "payment_status": ("payment_status",),
    "invoice_number": ("bill_extension", "invoice_number"),
    "vendor_id": ("vendor_id",),
}


def only_bills(bills: DataFrame, bill_type: str = BILL_TYPE) -> DataFrame:
    return bills.filter(F.col("bill_type") == bill_type)


def latest(bills: DataFrame) -> DataFrame:
    """The newest record per bill id; of records ingested at the same time, the highest key.

    Filter by type first: a newer record of another type does not replace a bill. Spark keeps
    one row per key on the map side (WindowGroupLimit), so a bill copied any number of times
    sends one row per task through the shuffle.
    """
    newest = Window.partitionBy("bill_id").orderBy(F.desc("ingested_at"), F.desc("bill_key"))
    return bills.withColumn("_rn", F.row_number().over(newest)).filter(F.col("_rn") == 1).drop("_rn")


def read_fields(bills: DataFrame, *, token_prefix: str = "PO_", token_length: int = 10,
                case_insensitive: bool = False) -> DataFrame:
    """Replace ``raw_json`` by the fields the match needs, and find the order number in the memo."""
    return with_order_number(read_texts(bills), token_prefix, token_length, case_insensitive)


def read_texts(bills: DataFrame) -> DataFrame:
    """Replace ``raw_json`` by the fields the match needs."""
    kept = [name for name in bills.columns if name != "raw_json"]
    parsed = bills.select(*kept, variants.parse(F.col("raw_json")).alias("_raw"),
                          F.col("raw_json").isNotNull().alias("_present"))
    return variants.read_scalars(parsed, "_raw", FIELDS).select(
        *kept, *FIELDS, (F.col("_present") & F.col("_raw").isNull()).alias("is_malformed"),
    )


def with_order_number(fields: DataFrame, token_prefix: str = "PO_", token_length: int = 10, case_insensitive: bool = False) -> DataFrame:
    """The order number in the memo. It repeats a part of the memo, so it is read after the shuffle that finds the newest records."""
    return fields.withColumn("po_number", texts.reference_token(F.col("memo"), token_prefix, token_length, case_insensitive))


def matched_columns(parsed_bills: DataFrame) -> DataFrame:
    """The columns that a match reads more than once. The key of a record is read of malformed ones only."""
    return parsed_bills.withColumn("bill_key", F.when(F.col("is_malformed"), F.col("bill_key"))).drop("bill_type", "ingested_at")


def malformed(parsed_bills: DataFrame) -> DataFrame:
    """Bills whose raw record is not JSON; they stay in the match with empty fields."""
    return parsed_bills.filter("is_malformed").select("bill_key", "bill_id")


def billed_totals(parsed_bills: DataFrame) -> DataFrame:
    """Per order number: the billed total without VOID bills, and how many bills of any kind cite it.

    A bill without a status counts. The total is NULL when no counted bill has an amount.
    """
    counted = ~F.col("status").eqNullSafe(VOID)
    return (
        parsed_bills.filter(F.col("po_number").isNotNull())
        .groupBy("po_number")
        .agg(
            F.sum(F.when(counted, F.col("amount"))).alias("billed_amount"),
            F.sum(counted.cast("long")).alias("counted_bills"),
            F.count("*").alias("bills"),
        )
    )


def billed_by_po(parsed_bills: DataFrame) -> DataFrame:
    """Order numbers with at least one bill that is not VOID, and their billed total."""
    return billed_totals(parsed_bills).filter("counted_bills > 0").select(
        "po_number", money(F.col("billed_amount")).alias("billed_amount"),
    )


def billed_po_numbers(parsed_bills: DataFrame) -> DataFrame:
    """Order numbers cited by any bill, VOID or not."""
    return parsed_bills.filter(F.col("po_number").isNotNull()).select("po_number").distinct()
