"""Keyed upsert: a source row replaces the target row of its key, or is added; nothing is deleted."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

SYNCED_AT = "synced_at"
BUCKET = "bucket"
NEW = "is_new"
MOST_BUCKETS = 1 << 15  # what a bitmap of buckets holds


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias(BUCKET)


def merged(target: DataFrame | None, source: DataFrame, key: str, buckets: int, *, splits: int = 1, arrival: Sequence[str] = (),
           on_duplicate: str = "error", what: str = "source") -> DataFrame:
    """The target's rows with the source's in their place or added, and the column ``bucket``.

    Target and source pass one exchange, by bucket and a split of its keys; what is sorted there serves the choice of the last
    copy (``on_duplicate="last"``, by ``arrival``), the refusal of NULL and repeated keys as rows are written, and the write
    itself. ``splits`` cuts large buckets over several tasks. ``is_new`` tells source rows from kept ones.
    """
    if on_duplicate not in ("error", "last"):
        raise ValueError(f"on_duplicate is error or last, not {on_duplicate}")
    rows = source.withColumn(NEW, F.lit(True))
    if target is not None:
        rows = rows.unionByName(target.withColumn(NEW, F.lit(False)), allowMissingColumns=True)
    split = F.pmod(F.xxhash64(F.col(key), F.lit("split")), F.lit(splits)).cast("int")
    dealt = rows.withColumns({BUCKET: bucket_of(key, buckets), "_split": split}).repartition(BUCKET, "_split")
    last_first = Window.partitionBy(BUCKET, "_split", key).orderBy(F.desc(NEW), *[F.desc(name) for name in arrival])
    chosen = dealt.withColumns({"_nth": F.row_number().over(last_first), "_next": F.lead(NEW).over(last_first)}).filter("_nth = 1")
    repeated = F.col("_next") if on_duplicate == "error" else F.lit(False)
    refused = F.col(NEW) & (F.col(key).isNull() | F.coalesce(repeated, F.lit(False)))
    message = F.concat(F.lit(f"{what}: key ({key}) is NULL or not unique, e.g. "), F.coalesce(F.col(key).cast("string"), F.lit("NULL")))
    checked = F.when(refused, F.raise_error(message)).otherwise(F.col(key))
    return chosen.withColumn(key, checked).drop("_split", "_nth", "_next", *[name for name in arrival if target is None or name not in target.columns])


def buckets_in(bitmap: bytes) -> list[int]:
    """The bucket numbers in a bitmap that ``F.bitmap_construct_agg`` has made."""
    return [8 * i + bit for i, byte in enumerate(bitmap) for bit in range(8) if byte >> bit & 1]


def merge_into(source: DataFrame, table: str, key: str) -> None:
    """The same upsert for a table of a catalog with row-level operations, by the catalog's own means."""
    source.alias("source").mergeInto(table, F.col(f"source.{key}") == F.col(f"{table}.{key}")).whenMatched().updateAll().whenNotMatched().insertAll().merge()


def upsert(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Target rows whose key the source does not have, and all source rows. Keys are unique on both
    sides. NULLs in the source overwrite; a column the source lacks (``synced_at`` before stamping) is NULL."""
    kept = target.join(source.select(key), key, "left_anti")
    return kept.select(*target.columns).unionByName(source, allowMissingColumns=True)


def stamped(source: DataFrame, synced_at: Column) -> DataFrame:
    return source.withColumn(SYNCED_AT, synced_at)
