"""Joins and splits that hold when one key owns a large share of the rows.

A key is hot when it owns at least ``hot_rows`` rows, about what one task can hold. There are at most rows / ``hot_rows``
such keys, fewer than the tasks that read the rows, which is what makes broadcasting their list safe at any data size. No
key that is hot is left whole.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructField, StructType

from tallyweave.sources.staging import stage

log = logging.getLogger(__name__)

HOT_ROWS = 2_000_000
MANY_KEYS = 50_000
TRACKED = 1 << 14  # keys that a sketch keeps
SALTS = 1 << 20
SMALL_BYTES = 32 << 20  # of a right side that is sent to every task as a whole


def hot_keys(df: DataFrame, on: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """The hot keys of ``df``. A single key column is put through a frequent-items sketch, so no key is shuffled: each task sends at
    most ``TRACKED`` of them. The sketch finds every key that owns more than one of ``TRACKED`` / 7 of all rows, which holds for all keys
    of ``hot_rows`` rows while there are fewer than ``hot_rows`` * ``TRACKED`` / 7 rows. Beyond, and for several columns, keys
    are counted, with map-side combine."""
    if len(on) == 1:
        key = F.col(on[0])
        top = F.call_function("approx_top_k", key, F.lit(TRACKED // 7), F.lit(TRACKED))
        found = df.agg(F.count("*").alias("rows"), top.alias("top"), F.count_if(key.isNull()).alias("nulls")).first()
        if found["rows"] * 7 <= hot_rows * TRACKED:
            hot = [item["item"] for item in found["top"] if item["count"] >= hot_rows and item["item"] is not None]
            schema = StructType([StructField(on[0], df.schema[on[0]].dataType)])
            return df.sparkSession.createDataFrame([(item,) for item in hot + [None] * (found["nulls"] >= hot_rows)], schema)
    return heavy_keys(df.groupBy(*on).agg(F.count("*").alias("_rows")), on, "_rows", hot_rows)


def heavy_keys(counts: DataFrame, on: Sequence[str], weight: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """The hot keys of a frame that already carries one row per key and its row count."""
    return counts.filter(F.col(weight) >= hot_rows).select(*on)


def collected(keys: DataFrame) -> DataFrame | None:
    """The hot keys as a local frame, or None when there are none. Plans without hot keys stay as
    simple as if skew did not exist."""
    found = keys.collect()  # at most rows / hot_rows keys
    if len(found) > MANY_KEYS:
        log.warning("%d hot keys; raise hot_rows to about what a task can hold", len(found))
    return keys.sparkSession.createDataFrame(found, keys.schema) if found else None


def is_small(df: DataFrame) -> bool:
    """Whether the rows, measured as texts with 32 bytes each besides, take at most ``SMALL_BYTES``."""
    width = F.lit(32).cast("long")
    for name in df.columns:
        width = width + F.coalesce(F.octet_length(F.col(name).cast("string")), F.lit(0))
    return (df.agg(F.sum(width).alias("bytes")).first()["bytes"] or 0) <= SMALL_BYTES


def lookup(left: DataFrame, right: DataFrame, on: Sequence[str], spread_by: Sequence[str], *,
           how: str = "left", hot: DataFrame | None = None, hot_rows: int = HOT_ROWS,
           read_again: bool = False, few: bool = False) -> DataFrame:
    """Equi join of many rows to one row per key, with the load of hot and NULL keys spread.

    Rows with a hot key take their match from a broadcast of the hot keys alone. They, and rows
    without a key, then pass through the shuffle join under a salt made from ``spread_by``,
    which no right-hand row carries, so they neither match twice nor meet in one task. Every
    other row is joined by key; Spark still broadcasts the right side there if it is small.

    ``hot`` gives the hot keys where the caller has counted them already. The right side must have one row per
    key, which callers assert where it comes from outside; that bounds the broadcast to one row per hot key.

    ``read_again`` says that ``left`` is cheap to read more than once, such as a staged table. Rows with a hot key and rows without a key
    then pass no shuffle at all. ``few`` says that the right side ``is_small``: it is broadcast, and no row of the left side is shuffled.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"lookup joins are left or inner, not {how}")
    on = list(on)
    payload = [name for name in right.columns if name not in on]
    matches = right.select(*on, F.struct(*payload, F.lit(True).alias("_found")).alias("_match"))
    if few:
        return _unpacked(left.join(F.broadcast(matches), on, "left"), left, payload, how)

    spread = F.lit(False)
    for name in on:
        spread = spread | F.col(name).isNull()
    keys = collected((hot_keys(left, on, hot_rows) if hot is None else hot.select(*on)).dropna())
    if how == "inner" and keys is None:  # rows without a key find nothing, and no others have to be spread
        return _unpacked(left.filter(~spread).join(matches, on), left, payload, how)
    if keys is not None:
        hot_matches = matches.join(F.broadcast(keys), on, "left_semi").withColumnRenamed("_match", "_hot_match")
    if read_again:
        rest = left.filter(~spread)
        parts = [left.filter(spread).withColumn("_match", F.lit(None).cast(matches.schema["_match"].dataType))]
        if keys is not None:
            known = keys.join(F.broadcast(hot_matches), on, "left").withColumnRenamed("_hot_match", "_match")
            parts.append(rest.join(F.broadcast(known), on))
            rest = rest.join(F.broadcast(keys), on, "left_anti")
        parts.append(rest.join(matches, on, "left"))
        return _unpacked(reduce(DataFrame.unionByName, parts), left, payload, how)
    if keys is not None:
        known = keys.join(F.broadcast(hot_matches), on, "left").withColumn("_is_hot", F.lit(True))
        left_marked = left.join(F.broadcast(known), on, "left")
        spread = spread | F.coalesce("_is_hot", F.lit(False))
    else:
        left_marked = left

    salt = F.when(spread, F.lit(1) + F.pmod(F.xxhash64(*spread_by), F.lit(SALTS))).otherwise(0)
    # The right salt is always 0, but depends on the key so that it is not folded out of the join keys.
    unsalted = F.pmod(F.xxhash64(*on), F.lit(1))
    joined = left_marked.withColumn("_salt", salt.cast("long")).join(
        matches.withColumn("_salt", unsalted.cast("long")), [*on, "_salt"], "left",
    )
    if keys is not None:
        joined = joined.withColumn("_match", F.coalesce("_hot_match", "_match"))
    return _unpacked(joined, left, payload, how)


def _unpacked(joined: DataFrame, left: DataFrame, payload: Sequence[str], how: str) -> DataFrame:
    """The rows of ``left`` with what they found."""
    if how == "inner":
        joined = joined.filter(F.col("_match._found"))
    return joined.select(*left.columns, *[F.col(f"_match.{name}").alias(name) for name in payload])


def split_hot(df: DataFrame, by: Sequence[str], hot_rows: int = HOT_ROWS,
              counted: DataFrame | None = None, keys: DataFrame | None = None) -> tuple[DataFrame, DataFrame | None]:
    """Rows of ordinary keys, and rows of hot keys (None when there are none).

    Keys are counted in ``counted`` where that is
    cheaper than in ``df``, and not at all where ``keys`` names the hot ones; the counts only decide which way a key's rows take, not the result.
    With hot keys, ``df`` is staged, because both parts read it, the hot one more than once.
    """
    keys = collected(hot_keys(df if counted is None else counted, by, hot_rows) if keys is None else keys.select(*by))
    if keys is None:
        return df, None
    listed = F.broadcast(keys.select(*[F.col(name).alias(f"_hot_{name}") for name in by]))
    same: Column = F.lit(True)
    for name in by:
        same = same & F.col(name).eqNullSafe(F.col(f"_hot_{name}"))
    rows = stage(df, "split")
    return rows.join(listed, same, "left_anti"), rows.join(listed, same, "left_semi")
