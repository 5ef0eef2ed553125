"""Parts: which product a part code means, its header, and its demand, supply and blocked stock."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyweave.functions.amounts import QUANTITY
from tallyweave.functions.texts import shown
from tallyweave.functions.times import as_date, safe_date
from tallyweave.operators.hot_keys import HOT_ROWS, heavy_keys, lookup
from tallyweave.operators.ordered import sequence

# The planning rows that are demand, the statuses of stock and order lines that
# decide what is supply, the supply labels, and the note on a demand's revision.
DEMAND_TYPES = ("MasterSchedule", "PlannedWorkOrder")
AVAILABLE = "AVAILABLE"
BLOCKED = ("BLOCKED", "ON_HOLD")
CLOSED_LINES = ("CANCELLED", "COMPLETED")
STOCK_SOURCE, ORDER_SOURCE = "Inventory", "Open PO"
REVISION_NOTE = " (best-effort - not tracked per demand line)"


def planning_counts(planning: DataFrame) -> DataFrame:
    return planning.groupBy("product_id").agg(F.count("*").alias("planning_rows"))


def resolve_codes(products: DataFrame, planning: DataFrame) -> DataFrame:
    """One product per part code: the one with most planning rows, then the lowest id."""
    counted = products.join(planning_counts(planning), "product_id", "left").withColumn(
        "planning_rows", F.coalesce("planning_rows", F.lit(0).cast("long")),
    )
    best = Window.partitionBy("code").orderBy(F.desc("planning_rows"), F.asc("product_id"))
    return (
        counted.filter(F.col("code").isNotNull())
        .withColumn("_rn", F.row_number().over(best)).filter("_rn = 1").drop("_rn")
    )


def default_revisions(revisions: DataFrame) -> DataFrame:
    """One active default revision per product: the lowest."""
    return (
        revisions.filter(F.col("is_default") & F.col("active"))
        .groupBy("product_id").agg(F.min("revision").alias("default_revision"))
    )


def make_buy(is_make: Column, is_buy: Column) -> Column:
    return (
        F.when(is_make & is_buy, "Make/Buy").when(is_make, "Make").when(is_buy, "Buy").otherwise("Neither")
    )


HEADER_FLAGS = ("is_serial_tracked", "is_lot_tracked", "is_inspection_required")


def part_headers(resolved: DataFrame, names: DataFrame, revisions: DataFrame) -> DataFrame:
    """Header of every resolved part. Tracking flags the source lacks come out as NULL."""
    flags = [
        (F.col(name) if name in resolved.columns else F.lit(None).cast("boolean")).alias(name.removeprefix("is_"))
        for name in HEADER_FLAGS
    ]
    return (
        resolved.join(names.select("product_id", "name"), "product_id", "left")
        .join(default_revisions(revisions), "product_id", "left")
        .select(
            "product_id", shown(resolved, "code").alias("part_number"), F.col("name").alias("description"),
            make_buy(F.col("is_make"), F.col("is_buy")).alias("make_buy"), "active", *flags,
            F.col("lead_time").alias("lead_time_days"), "default_revision",
        )
    )


def revision_label(revision: Column) -> Column:
    """The note that the revision is only the part's default; NULL without a default."""
    return F.concat(revision, F.lit(REVISION_NOTE))


def demand_pool(planning: DataFrame) -> DataFrame:
    """Planning rows that are demand. The need date is the day of the due time."""
    return planning.filter(F.col("type").isin(*DEMAND_TYPES) & F.col("product_id").isNotNull()).select(
        "product_id", F.col("line_id").alias("demand_id"), "due_at",
        F.col("due_at").cast("date").alias("need_date"), F.col("qty").cast(QUANTITY).alias("qty"),
    )


def demand_order() -> list[Column]:
    return [F.asc_nulls_first("need_date"), F.asc_nulls_first("due_at"), F.asc("demand_id")]


def numbered_demand(demand: DataFrame, *, hot_rows: int = HOT_ROWS) -> DataFrame:
    return sequence(demand, ["product_id"], demand_order(), "demand_seq", hot_rows=hot_rows)


def label_demand(demand: DataFrame, revisions: DataFrame, *, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Add the revision label of the product to each demand row."""
    labels = default_revisions(revisions).select(
        "product_id", revision_label(F.col("default_revision")).alias("demand_rev"),
    )
    return lookup(demand, labels, ["product_id"], ["demand_id"], hot_rows=hot_rows)


def stock_reference(*, with_id: bool) -> Column:
    names = ["serial", "lot", "tag"] + (["inventory_id"] if with_id else [])
    return F.coalesce(*[F.col(name).cast("string") for name in names])


def available_stock(stock: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """Stock that can be allocated; it is there today."""
    return stock.filter((F.col("status") == AVAILABLE) & F.col("product_id").isNotNull()).select(
        "product_id", F.col("inventory_id").cast("string").alias("supply_id"), F.lit(0).alias("source_rank"),
        as_date(as_of).alias("ecd_date"), shown(stock, "revision").alias("supply_rev"),
        F.lit(STOCK_SOURCE).alias("source_type"), stock_reference(with_id=True).alias("reference"),
        "pedigree", F.col("qty").cast(QUANTITY).alias("qty"),
    )


def open_order_supply(details: DataFrame, lines: DataFrame) -> DataFrame:
    """Order lines with something left to come. Lines without a status are left out.

    The join key is the line id, so no key has many rows.
    """
    still_open = details.filter(
        ~F.col("status").isin(*CLOSED_LINES) & (F.col("qty_remaining") > 0) & F.col("product_id").isNotNull()
    ).select("line_id", "product_id", F.col("qty_remaining").cast(QUANTITY).alias("qty"))
    described = lines.select("line_id", "due_text", "revision", "header_number", "line_number", "pedigree")
    return still_open.join(described, "line_id").select(
        "product_id", F.col("line_id").cast("string").alias("supply_id"), F.lit(1).alias("source_rank"),
        safe_date(F.col("due_text")).alias("ecd_date"), F.col("revision").alias("supply_rev"),
        F.lit(ORDER_SOURCE).alias("source_type"),
        F.concat("header_number", F.lit(" / line "), F.col("line_number").cast("string")).alias("reference"),
        "pedigree", "qty",
    )


def supply_pool(stock: DataFrame, details: DataFrame, lines: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    return available_stock(stock, as_of).unionByName(open_order_supply(details, lines))


def pool_products(planning: DataFrame, stock: DataFrame, details: DataFrame) -> DataFrame:
    """The product of every row that may enter the pools, without the join that describes order lines."""
    return (
        demand_pool(planning).select("product_id")
        .unionByName(stock.filter(F.col("status") == AVAILABLE).select("product_id"))
        .unionByName(details.filter(F.col("qty_remaining") > 0).select("product_id"))
    )


def supply_order() -> list[Column]:
    """By date; without a readable date first, stock before order lines of the same day."""
    return [F.asc_nulls_first("ecd_date"), F.asc("source_rank"), F.asc_nulls_first("reference"), F.asc("supply_id")]


def numbered_supply(supply: DataFrame, *, hot_rows: int = HOT_ROWS) -> DataFrame:
    return sequence(supply, ["product_id"], supply_order(), "supply_seq", hot_rows=hot_rows)


def blocked_stock(stock: DataFrame, nonconformances: DataFrame, product_key: str = "product_code", *,
                  hot_rows: int = HOT_ROWS) -> DataFrame:
    """Blocked and held stock with the newest non-conformance of its product and revision.

    Products are matched by code, which may live on several sites; ``product_key`` names another column to match by.

    A non-conformance without a revision fits every revision. The newest one that fits is the
    newer of two: the newest of the same revision and the newest without one. Both are
    aggregated first and looked up once per distinct (product, revision) of the stock, so no
    stock row ever meets more than one non-conformance.
    """
    newest = F.max(F.struct("created_at", "nc_number", "status", *_optional(nonconformances, "reject_category")))
    best = nonconformances.filter(F.col(product_key).isNotNull()).groupBy(product_key, "revision").agg(
        newest.alias("nc")
    )
    same_revision = best.filter(F.col("revision").isNotNull()).withColumnRenamed("nc", "nc_same")
    any_revision = best.filter(F.col("revision").isNull()).select(product_key, F.col("nc").alias("nc_any"))

    blocked = stock.filter(F.col("status").isin(*BLOCKED)).select(
        "inventory_id", "product_id", *([] if product_key == "product_id" else [product_key]), shown(stock, "status").alias("status"),
        shown(stock, "revision").alias("rev"), stock_reference(with_id=False).alias("reference"), "pedigree", "qty",
        # An unknown revision needs a value of its own, because a NULL key would never be found.
        F.struct(F.col("revision").isNull().alias("none"), F.coalesce("revision", F.lit("")).alias("code")).alias("_rev"),
    )
    wanted = blocked.groupBy(product_key, "_rev").agg(F.count("*").alias("_rows"))
    hot = heavy_keys(wanted, [product_key, "_rev"], "_rows", hot_rows)
    found = (
        wanted.withColumn("revision", F.when(~F.col("_rev.none"), F.col("_rev.code")))
        .join(same_revision, [product_key, "revision"], "left")
        .join(any_revision, product_key, "left")
        .select(product_key, "_rev", F.greatest("nc_same", "nc_any").alias("nc"))
    )
    linked = lookup(blocked, found, [product_key, "_rev"], ["inventory_id"], hot=hot)
    return linked.select(
        *[name for name in blocked.columns if name not in ("_rev", "product_code")],
        "nc.nc_number", F.col("nc.status").alias("nc_status"),
        *[F.col(f"nc.{name}").alias(name) for name in _optional(nonconformances, "reject_category")],
    )


def _optional(df: DataFrame, *names: str) -> list[str]:
    return [name for name in names if name in df.columns]
