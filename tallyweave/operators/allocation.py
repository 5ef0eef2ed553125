"""First-in-first-out allocation of supply to demand, for all products at once.

Put end to end in their order, the demands of a product cut the quantity axis into intervals,
and so do its supplies. Between two neighbouring borders of either kind exactly one demand and
one supply are in force, so each such segment is one allocation. A segment past the last supply
is a shortage, one past the last demand is left-over supply. This needs running totals and one
sweep over the borders; no pairs are formed and nothing is looped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyweave.functions.amounts import QUANTITY
from tallyweave.operators.hot_keys import HOT_ROWS, split_hot
from tallyweave.operators.ordered import CHUNK, chunk_count, chunked_running_sum, ordered_chunks

# Fixed value: the source shown on a shortage row.
SHORTAGE = "SHORTAGE - no supply available"

DEMAND, SUPPLY = 0, 1
DEMAND_FIELDS = ("demand_id", "need_date")
SUPPLY_FIELDS = ("supply_id", "ecd_date", "supply_rev", "source_type", "reference", "pedigree")


def allocation_pool(demand: DataFrame, supply: DataFrame) -> DataFrame:
    """Both pools in one frame, so that one shuffle by product serves the whole allocation.

    Rows without a positive quantity take no part.
    """
    demands = demand.select(
        "product_id", F.lit(DEMAND).alias("side"), F.col("qty").cast(QUANTITY).alias("qty"),
        F.col("need_date").alias("o_date"), F.col("due_at").cast("timestamp_ntz").alias("o_at"),
        F.lit(0).alias("o_rank"), F.lit(None).cast("string").alias("o_reference"),
        F.col("demand_id").cast("string").alias("o_id"),
        F.struct(*DEMAND_FIELDS).alias("demand"),
    )
    supplies = supply.select(
        "product_id", F.lit(SUPPLY).alias("side"), F.col("qty").cast(QUANTITY).alias("qty"),
        F.col("ecd_date").alias("o_date"), F.lit(None).cast("timestamp_ntz").alias("o_at"),
        F.col("source_rank").alias("o_rank"), F.col("reference").alias("o_reference"),
        F.col("supply_id").cast("string").alias("o_id"),
        F.struct(*SUPPLY_FIELDS).alias("supply"),
    )
    return demands.unionByName(supplies, allowMissingColumns=True).filter(F.col("qty") > 0)


def _pool_order() -> list[Column]:
    return [F.col(name).asc_nulls_first() for name in ("o_date", "o_at", "o_rank", "o_reference", "o_id")]


def _borders_windowed(pool: DataFrame) -> DataFrame:
    so_far = (
        Window.partitionBy("product_id").orderBy("side", *_pool_order())
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return pool.withColumns({
        f"sum_{side}": F.sum(F.when(F.col("side") == side, F.col("qty"))).over(so_far)
        for side in (DEMAND, SUPPLY)
    }).select(
        "product_id", "side", "demand", "supply",
        F.when(F.col("side") == DEMAND, F.col(f"sum_{DEMAND}")).otherwise(F.col(f"sum_{SUPPLY}")).alias("border"),
    )


def _sweep_windowed(borders: DataFrame) -> DataFrame:
    """Walk the borders from the far end, so the demand and supply in force are the last ones seen.

    Where a demand and a supply end at the same border, the row met first has no length.
    """
    walk = Window.partitionBy("product_id").orderBy(F.desc("border"), "side")
    seen = walk.rowsBetween(Window.unboundedPreceding, 0)
    return borders.select(
        "product_id",
        F.last("demand", ignorenulls=True).over(seen).alias("demand"),
        F.last("supply", ignorenulls=True).over(seen).alias("supply"),
        (F.col("border") - F.coalesce(F.lead("border").over(walk), F.lit(0))).alias("length"),
    )


def _borders_chunked(pool: DataFrame, chunks: int) -> DataFrame:
    by, order = ["product_id", "side"], _pool_order()
    chunked = ordered_chunks(pool, by, order, "allocation-pool", chunks)
    return chunked_running_sum(chunked, by, order, F.col("qty"), "border").select(
        "product_id", "side", "demand", "supply", "border",
    )


def _sweep_chunked(borders: DataFrame, chunks: int) -> DataFrame:
    """The same walk over contiguous chunks of the borders, each chunk starting with the demand
    and supply its predecessors left in force and ending at its successor's first border."""
    order = [F.desc("border")]
    chunked = ordered_chunks(borders, ["product_id"], order, "allocation-borders", chunks)
    edges = chunked.groupBy("product_id", CHUNK).agg(
        F.min_by("demand", F.when(F.col("demand").isNotNull(), F.col("border"))).alias("last_demand"),
        F.min_by("supply", F.when(F.col("supply").isNotNull(), F.col("border"))).alias("last_supply"),
        F.max("border").alias("first_border"),
    )
    along = Window.partitionBy("product_id").orderBy(CHUNK)
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    carried = edges.select(
        "product_id", CHUNK,
        F.last("last_demand", ignorenulls=True).over(before).alias("from_demand"),
        F.last("last_supply", ignorenulls=True).over(before).alias("from_supply"),
        F.lead("first_border").over(along).alias("to_border"),
    ).filter("from_demand is not null or from_supply is not null or to_border is not null")

    walk = Window.partitionBy(CHUNK, "product_id").orderBy(F.desc("border"), "side")
    seen = walk.rowsBetween(Window.unboundedPreceding, 0)
    # A chunk continues at most one product and is continued by at most one: two rows per chunk.
    return chunked.join(F.broadcast(carried), ["product_id", CHUNK], "left").select(
        "product_id",
        F.coalesce(F.last("demand", ignorenulls=True).over(seen), "from_demand").alias("demand"),
        F.coalesce(F.last("supply", ignorenulls=True).over(seen), "from_supply").alias("supply"),
        (F.col("border") - F.coalesce(F.lead("border").over(walk), F.col("to_border"), F.lit(0))).alias("length"),
    )


def allocate(pool: DataFrame, *, hot_rows: int = HOT_ROWS, chunks: int | None = None,
             counted: DataFrame | None = None, keys: DataFrame | None = None) -> DataFrame:
    """Segments of (product_id, demand, supply, qty); ``demand`` or ``supply`` is NULL where none is in force.

    ``counted`` may name a cheaper frame than the pool to count rows per product in, ``keys`` the hot products
    where they are known.
    """
    cold, hot = split_hot(pool, ["product_id"], hot_rows, counted=counted, keys=keys)
    segments = _sweep_windowed(_borders_windowed(cold))
    if hot is not None:
        chunks = chunks or chunk_count(hot, hot_rows)
        segments = segments.unionByName(_sweep_chunked(_borders_chunked(hot, chunks), chunks))
    return segments.filter(F.col("length") > 0).select(
        "product_id", "demand", "supply", F.col("length").cast(QUANTITY).alias("qty"),
    )


def allocations(segments: DataFrame) -> DataFrame:
    """One row per allocated or short piece of a demand."""
    short = F.col("supply").isNull()
    return segments.filter(F.col("demand").isNotNull()).select(
        "product_id", "demand.demand_id", "demand.need_date", F.col("qty").alias("demand_qty"),
        "supply.supply_id", "supply.ecd_date", "supply.supply_rev",
        F.when(short, F.lit(SHORTAGE)).otherwise(F.col("supply.source_type")).alias("source_type"),
        "supply.reference", "supply.pedigree",
        F.when(short, F.lit(0)).otherwise(F.col("qty")).cast(QUANTITY).alias("allocated_qty"),
    )


def excess(segments: DataFrame) -> DataFrame:
    """Supply left over after all demand. A supply is cut by demand only, so it appears once."""
    return segments.filter(F.col("demand").isNull()).select(
        "product_id", "supply.supply_id", "supply.ecd_date", F.col("supply.supply_rev").alias("rev"),
        "supply.source_type", "supply.reference", "supply.pedigree", F.col("qty").alias("excess_qty"),
    )
