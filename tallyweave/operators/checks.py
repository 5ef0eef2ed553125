"""Integrity checks that a database would enforce by declaration: keys, non-null columns, lengths."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


class IntegrityError(ValueError):
    """Data breaks a declared rule."""


def key_violations(df: DataFrame, *key: str) -> DataFrame:
    """Keys that are NULL or occur more than once, with their row count (map-side combined)."""
    incomplete = F.lit(False)
    for name in key:
        incomplete = incomplete | F.col(name).isNull()
    return df.groupBy(*key).agg(F.count("*").alias("rows")).filter((F.col("rows") > 1) | incomplete)


def assert_key(df: DataFrame, *key: str, what: str = "table") -> DataFrame:
    """Keys are first counted by a hash, which takes fewer bytes through the shuffle; only if one occurs twice, or a key is NULL, are the keys
    themselves counted."""
    incomplete = F.lit(False)
    for name in key:
        incomplete = incomplete | F.col(name).isNull()
    hashed = df.select(F.xxhash64(*key).alias("_hash"), incomplete.alias("_incomplete")).groupBy("_hash").agg(
        F.count("*").alias("_rows"), F.max("_incomplete").alias("_incomplete"))
    if hashed.filter("_rows > 1 or _incomplete").isEmpty():
        return df
    sample = key_violations(df, *key).limit(3).collect()
    if sample:
        shown = "; ".join(f"{tuple(row)[:-1]} x{row['rows']}" for row in sample)
        raise IntegrityError(f"{what}: key ({', '.join(key)}) is NULL or not unique, e.g. {shown}")
    return df


def unique_rows(df: DataFrame, key: str, *columns: str, what: str = "table", where: Column | None = None) -> DataFrame:
    """The right side of a lookup by ``key``: one row per key with the given columns. A key that occurs more than once raises an
    error when the row is computed, out of the count that the grouping carries, so building a plan runs no job. Rows
    without a key are left out, since nothing finds them, and so are those for which ``where`` does not hold. The key itself comes out
    as it was grouped, so a join by it needs no other shuffle."""
    grouped = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_rows"), *[F.max(name).alias(name) for name in columns])
    message = F.concat(F.lit(f"{what}: key ({key}) is not unique, e.g. "), F.col(key).cast("string"))
    once = F.when(F.col("_rows") > 1, F.raise_error(message).cast("boolean")).otherwise(True)
    return grouped.filter(once if where is None else where & once).select(key, *columns)


def row_violations(required: Sequence[str] = (), max_length: Mapping[str, int] | None = None) -> Column:
    """``array<string>`` naming every rule a row breaks; empty for a clean row."""
    rules = [F.when(F.col(name).isNull(), F.lit(f"{name} is null")) for name in required]
    rules += [F.when(F.length(name) > limit, F.lit(f"{name} is longer than {limit}"))
              for name, limit in (max_length or {}).items()]
    if not rules:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*rules))


def assert_rows(df: DataFrame, violations: Column, what: str = "table") -> DataFrame:
    sample = (
        df.select(F.explode(violations).alias("rule")).groupBy("rule").agg(F.count("*").alias("rows"))
        .orderBy("rule").limit(5).collect()
    )
    if sample:
        raise IntegrityError(f"{what}: " + "; ".join(f"{row['rule']} ({row['rows']} rows)" for row in sample))
    return df


def out_of_range(source: Column, typed: Column) -> Column:
    """True where a value was given but did not fit its type."""
    return source.isNotNull() & typed.isNull()
