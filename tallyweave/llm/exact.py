"""Exact deduplication by progressive refinement.

Rows are grouped by byte length, then those that share a length by a hash of the first characters,
then those that share both by SHA-256 of the whole text. Whole texts are read only for rows that
are still in a group of two or more. Only the narrow signatures are shuffled for grouping; every
count is reduced on the map side, so a group that holds a third of all rows costs one row per task.

Two texts are equal when they are identical after lower-casing A-Z. A NULL text counts as empty.
Of equal texts the row with the largest id stays; a NULL id is smaller than any other, and of rows
with the same id and text one stays. Tables without rows give results without rows. Further columns
may have any names; ``membership`` leaves them out and ``keep_one`` keeps them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweave.llm.common import lower_ascii, numbered, text_or_empty
from tallyweave.sources.staging import stage

PREFIX_CHARS = 64
OWN = ("_id", "_bytes", "_prefix", "_full")
_SIGNATURE = ["_id", "_bytes", "_prefix"]


def normal_text(text_column: str = "text") -> Column:
    return lower_ascii(text_or_empty(text_column))


def full_hash(text_column: str = "text") -> Column:
    return F.sha2(normal_text(text_column).cast("binary"), 256)


def signed(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
           prefix_chars: int = PREFIX_CHARS) -> DataFrame:
    """The documents, numbered columns or the two named ones, with what the first two steps group by."""
    text = text_or_empty(text_column)
    return docs.withColumns({
        "_id": F.col(id_column).cast("long"),
        "_bytes": F.octet_length(text).cast("long"),  # lower-casing A-Z keeps the length
        "_prefix": F.xxhash64(lower_ascii(F.substring(text, 1, prefix_chars))),
    })


def _same(left: DataFrame, right: DataFrame, names: list[str]) -> Column:
    condition = F.lit(True)
    for name in names:
        condition = condition & left[name].eqNullSafe(right[name])
    return condition


def _shared(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The rows whose keys occur more than once."""
    groups = rows.groupBy(*keys).agg(F.count("*").alias("_n")).filter("_n > 1").select(*[F.col(k).alias(f"{k}_g") for k in keys])
    condition = F.lit(True)
    for key in keys:
        condition = condition & (F.col(key) == F.col(f"{key}_g"))
    return rows.join(groups, condition, "left_semi")


def exact_groups(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                 prefix_chars: int = PREFIX_CHARS) -> DataFrame:
    """One row per distinct (id, text): ``_id``, ``_bytes``, ``_prefix``, ``_full`` (SHA-256, NULL for rows
    that the first two steps found to be alone), ``copies`` (rows with this id and text), ``keep_id``
    and ``group_size``."""
    marked = signed(docs.select(id_column, text_column), id_column, text_column, prefix_chars)
    signatures = stage(marked.select(*_SIGNATURE), "exact-signatures")
    survivors = stage(_shared(_shared(signatures, ["_bytes"]), ["_bytes", "_prefix"]).distinct(), "exact-survivors")
    keys = survivors.select(*[F.col(name).alias(f"{name}_s") for name in _SIGNATURE])
    # joined by key at every size: whether the survivors would fit a broadcast says nothing of the next corpus
    hashed = (marked.join(keys.hint("merge"), F.col("_id").eqNullSafe(F.col("_id_s")) & (F.col("_bytes") == F.col("_bytes_s"))
                          & (F.col("_prefix") == F.col("_prefix_s")), "left_semi")
              .select(*_SIGNATURE, full_hash(text_column).alias("_full")))
    members = stage(hashed.groupBy(*_SIGNATURE, "_full").agg(F.count("*").alias("copies")), "exact-members")
    groups = members.groupBy(F.col("_full").alias("_full_g")).agg(
        F.max("_id").alias("keep_id"), F.sum("copies").alias("group_size"))
    grouped = members.join(groups, F.col("_full") == F.col("_full_g")).drop("_full_g")
    alone = signatures.join(survivors.hint("merge"), _same(signatures, survivors, _SIGNATURE), "left_anti").select(
        *_SIGNATURE, F.lit(None).cast("string").alias("_full"), F.lit(1).cast("long").alias("copies"),
        F.col("_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"))
    return grouped.select(*alone.columns).unionByName(alone)


def membership(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document, dropped ones too: ``doc_id``, ``keep_id``, ``group_size``, ``kept`` and
    ``text_sha256`` of the lower-cased text."""
    groups = exact_groups(docs, id_column, text_column)
    digests = (signed(docs.select(id_column, text_column), id_column, text_column)
               .select(*[F.col(n).alias(f"{n}_d") for n in _SIGNATURE], full_hash(text_column).alias("text_sha256")).distinct())
    matched = groups.join(digests, F.col("_id").eqNullSafe(F.col("_id_d")) & (F.col("_bytes") == F.col("_bytes_d"))
                          & (F.col("_prefix") == F.col("_prefix_d"))
                          & (F.col("_full").isNull() | (F.col("_full") == F.col("text_sha256"))))
    rows = matched.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return rows.select(
        F.col("_id").alias("doc_id"), "keep_id", "group_size",
        (F.col("_id").eqNullSafe(F.col("keep_id")) & (F.col("_copy") == 1)).alias("kept"), "text_sha256")


def keep_one(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents that stay, with the columns they came with."""
    names = docs.columns
    docs, (id_column, text_column) = numbered(docs, id_column, text_column)
    columns = docs.columns
    groups = stage(exact_groups(docs, id_column, text_column).filter("_full is not null"), "exact-groups")
    marked = signed(docs, id_column, text_column)

    def matches(right: DataFrame) -> Column:
        return (F.col("_id").eqNullSafe(F.col("_id_r")) & (F.col("_bytes") == F.col("_bytes_r"))
                & (F.col("_prefix") == F.col("_prefix_r")) & (full_hash(text_column) == F.col("_full_r")))

    def keyed(rows: DataFrame) -> DataFrame:
        return rows.select(*[F.col(name).alias(f"{name}_r") for name in OWN])

    leaves = keyed(groups.filter("not (_id <=> keep_id) or copies > 1"))
    repeated = keyed(groups.filter("_id <=> keep_id and copies > 1"))
    kept = marked.join(leaves.hint("merge"), matches(leaves), "left_anti").select(*columns)
    if repeated.isEmpty():
        return kept.toDF(*names)
    again = marked.withColumn("_full", full_hash(text_column)).join(repeated, matches(repeated), "left_semi")
    return kept.unionByName(again.dropDuplicates(["_id", "_full"]).select(*columns)).toDF(*names)
