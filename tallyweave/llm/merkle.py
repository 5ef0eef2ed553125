"""A Merkle manifest of a dataset, with a proof for every row.

Each row is a leaf. The leaves of a source, ascending by id, form a tree in which every ``FAN`` consecutive nodes become one; the roots of
the sources, ordered by source, form a tree over them.

A tree is built by aligned builders: each takes ``SPAN`` = FAN ** HEIGHT consecutive nodes, the leaves of one whole subtree, and appends
nodes to a log in the order in which they are completed (postorder). The roots of these subtrees are the nodes of the next tier, so a
source of any size is built by many tasks, and a tier is ``SPAN`` times smaller than the one below. Where a node lies in a log follows from
the sizes of the subtrees completed before it, in closed form (``position``); a proof reads its siblings at their positions, without
searching. Proofs go downwards: a tier gives each subtree below it its path to the root, one small row.

Leaves are numbered by a range-partitioned sort with an offset per partition; no task sees a whole source.

Values hash as ``-`` if NULL, else as their UTF-8 bytes after their number and a colon. NULL sources form a source of
their own, before all others; NULL ids come before all others of a source; rows that repeat an id are ordered by their leaf, and rows that
agree in all fields are leaves of their own. No rows give no rows. Further columns may have any names; they are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyweave.sources.staging import stage

FAN, HEIGHT = 3, 5
SPAN = FAN ** HEIGHT
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
WIDTH = 32
_PER_PARTITION = (1 << 33) - 1  # monotonically_increasing_id numbers the rows of a partition in its lower bits


def joined_hash(parts: Iterable[bytes]) -> bytes:
    """H of digests, which are hex text."""
    return hashlib.sha256(b"".join(parts)).hexdigest().encode()


def levels_over(n: int) -> int:
    """Levels above the leaves of a tree of n."""
    levels = 0
    while n > 1:
        n, levels = -(-n // FAN), levels + 1
    return levels


def position(level: int, index: int, n: int, levels: int) -> int:
    """Where the node lies in the log of a subtree of n leaves. Up to its own level, all nodes that begin before its end are
    complete; above it, those that end before its beginning."""
    end = min((index + 1) * FAN ** level, n)
    below = sum(-(-end // FAN ** own) for own in range(level + 1))
    above = sum(index // FAN ** (own - level) for own in range(level + 1, levels + 1))
    return below + above - 1


@lru_cache(maxsize=2 * SPAN)
def positions(n: int, levels: int) -> list[list[int]]:
    return [[position(level, i, n, levels) for i in range(-(-n // FAN ** level))] for level in range(levels + 1)]


def append_log(leaves: Sequence[bytes], levels: int) -> list[bytes]:
    """The nodes of a subtree in the order of their completion. The last run of a level may be short."""
    log: list[bytes] = []
    runs: list[list[bytes]] = [[] for _ in range(levels + 1)]
    for i, node in enumerate(leaves):
        for level, run in enumerate(runs):
            log.append(node)
            run.append(node)
            if level == levels or (len(run) < FAN and i + 1 < len(leaves)):
                break
            node = joined_hash(run)
            run.clear()
    return log


def inner_path(log: Sequence[bytes], at: list[list[int]], index: int) -> list[tuple[bytes, bytes]]:
    """For each level the siblings to the left and to the right of the leaf's ancestor, joined."""
    path = []
    for own in at[:-1]:
        first = index - index % FAN
        path.append((b"".join(log[k] for k in own[first:index]), b"".join(log[k] for k in own[index + 1:first + FAN])))
        index //= FAN
    return path


def packed_path(path: list[tuple[bytes, bytes]]) -> bytes:
    return b"".join(bytes([len(left) // 64, len(right) // 64]) + bytes.fromhex((left + right).decode()) for left, right in path)


def unpacked_path(blob: bytes) -> list[tuple[bytes, bytes]]:
    path, at = [], 0
    while at < len(blob):
        left, right = blob[at], blob[at + 1]
        middle, end = at + 2 + left * WIDTH, at + 2 + (left + right) * WIDTH
        path.append((blob[at + 2:middle].hex().encode(), blob[middle:end].hex().encode()))
        at = end
    return path


def folded(leaf: bytes, path: list[tuple[bytes, bytes]]) -> bytes:
    for left, right in path:
        leaf = joined_hash((left, leaf, right))
    return leaf


def _digests(blob: bytes) -> list[bytes]:
    text = blob.hex().encode()
    return [text[at:at + 64] for at in range(0, len(text), 64)]


def leaf_hash(fields: Sequence[Column]) -> Column:
    """H of the fields as hex text. Integers count as their decimal digits."""
    spelled = [field.cast("string") for field in fields]
    return F.sha2(F.concat(*[F.when(x.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(x).cast("string"), F.lit(":"), x)) for x in spelled]), 256)


def ranked(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """The rows with ``_rank``, their place within ``_tree`` from 0, and ``_of``, the number of its rows."""
    pieces = rows.repartitionByRange("_tree", *order).sortWithinPartitions("_tree", *order)
    pieces = stage(pieces.withColumns({"_piece": F.spark_partition_id(), "_at": F.monotonically_increasing_id().bitwiseAND(F.lit(_PER_PARTITION))}), "leaves")
    own = Window.partitionBy("_tree")
    earlier = own.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    counts = pieces.groupBy("_tree", "_piece").agg(F.count("*").alias("_n"), F.min("_at").alias("_first")).select(
        "_tree", "_piece", (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"), F.sum("_n").over(own).alias("_of"))
    return pieces.join(counts, ["_tree", "_piece"]).withColumn("_rank", F.col("_at") + F.col("_shift")).drop("_piece", "_at", "_shift")


def segments(nodes: DataFrame, kind: str) -> DataFrame:
    """The logs of one tier: of every ``SPAN`` nodes of a tree (``_tree``, ``_rank``, ``_of``, ``_digest``, ``_id`` of type ``kind``,
    ``_claim``) one row, with ``_block``, its number, the ``_log``, and the ids and claims of the nodes it is built on."""

    def build(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches)).sort_by("_rank")
        leaves, of = [x.as_py().hex().encode() for x in table.column("_digest")], table.column("_of")[0].as_py()
        levels = HEIGHT if of > SPAN else levels_over(of)
        log = append_log(leaves, levels)
        yield pa.RecordBatch.from_pylist([{
            "_tree": key[0].as_py(), "_block": key[1].as_py(), "_of": of, "_levels": levels, "_log": bytes.fromhex(b"".join(log).decode()),
            "_ids": table.column("_id").to_pylist(), "_claims": b"".join(x.as_py() or b"" for x in table.column("_claim"))}], schema)

    schema = pa.schema([("_tree", pa.string()), ("_block", pa.int64()), ("_of", pa.int64()), ("_levels", pa.int32()), ("_log", pa.binary()),
                        ("_ids", pa.list_(pa.int64() if kind == "long" else pa.string())), ("_claims", pa.binary())])
    rows = nodes.select("_tree", F.expr(f"_rank div {SPAN}").alias("_block"), "_rank", "_of", "_digest", "_id", "_claim")
    return stage(rows.groupBy("_tree", "_block").applyInArrow(
        build, f"_tree string, _block long, _of long, _levels int, _log binary, _ids array<{kind}>, _claims binary"), "segments")


def tiers_of(nodes: DataFrame, kind: str) -> list[DataFrame]:
    """The logs of all tiers, lowest first. In the last one every tree is one segment."""
    tiers = [segments(nodes, kind)]
    width = tiers[0].agg(F.max("_of")).first()[0] or 0
    while width > SPAN:
        width = -(-width // SPAN)
        below = tiers[-1]
        tiers.append(segments(below.select(
            "_tree", F.col("_block").alias("_rank"), F.expr(f"(_of + {SPAN - 1}) div {SPAN}").alias("_of"), _root_of(below).alias("_digest"),
            F.lit(None).cast(kind).alias("_id"), F.lit(None).cast("binary").alias("_claim")), kind))
    return tiers


def _root_of(tier: DataFrame) -> Column:
    return F.substring(tier["_log"], -WIDTH, WIDTH)


def _each_leaf(batch: pa.RecordBatch) -> Iterator[tuple[dict, list[bytes], list[tuple[int, list[tuple[bytes, bytes]]]]]]:
    """Of every segment: its row, its leaves, and for each leaf its number and its whole path."""
    for row in batch.to_pylist():
        log = _digests(row["_log"])
        n = -(-row["_of"] // SPAN) - 1 == row["_block"] and row["_of"] - row["_block"] * SPAN or SPAN
        at = positions(n, row["_levels"])
        outer = unpacked_path(row["_path"])
        yield row, [log[k] for k in at[0]], ((i, inner_path(log, at, i) + outer) for i in range(n))


def _paths(tier: DataFrame, outer: DataFrame, with_ids: bool) -> DataFrame:
    """The paths of a tier's nodes: ``_tree``, ``_block`` (the node's number), ``_path``, ``_subroot``. ``with_ids``: each node is
    the root of the tree that its id names."""

    def walk(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row, leaves, paths in _each_leaf(batch):
                for i, path in paths:
                    own = (row["_ids"][i], 0, bytes.fromhex(leaves[i].decode())) if with_ids else (row["_tree"], row["_block"] * SPAN + i, row["_subroot"])
                    out.append((own[0], own[1], packed_path(path), own[2]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.int64(), pa.binary(), pa.binary()))],
                                                 ["_tree", "_block", "_path", "_subroot"])

    return tier.join(outer, ["_tree", "_block"]).mapInArrow(walk, "_tree string, _block long, _path binary, _subroot binary")


def proofs(docs: DataFrame, claim: Column | None = None, fields: Sequence[str] = FIELDS, by: str = "source", id_column: str = "doc_id",
           text_column: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``leaf``, ``subroot``, ``root``, ``siblings`` (hex digests in the order of the proof),
    ``proof_sha256`` (H of them), ``folded_root`` (from the leaf that the claimed text gives, up the siblings) and ``verified``,
    whether it is the root. Without ``claim`` the claimed text is the text."""
    claimed = [claim if name == text_column and claim is not None else F.col(name) for name in fields]
    name = F.when(F.col(by).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(by).cast("string")))  # NULL comes first
    leaves = docs.select(name.alias("_tree"), F.col(id_column).cast("long").alias("_id"), F.unhex(leaf_hash([F.col(n) for n in fields])).alias("_digest"),
                         F.unhex(leaf_hash(claimed)).alias("_claim"))
    tiers = tiers_of(ranked(leaves, ["_id", "_digest"]), "long")

    subroots = tiers[-1].select(F.lit("").alias("_tree"), F.col("_tree").alias("_id"), _root_of(tiers[-1]).alias("_digest"), F.lit(None).cast("binary").alias("_claim"))
    over = tiers_of(ranked(subroots, ["_id"]), "string")
    top = over[-1].select(_root_of(over[-1])).first()  # one row
    root = top[0].hex() if top else None
    outer = over[-1].select("_tree", "_block", F.lit(b"").alias("_path"), F.lit(None).cast("binary").alias("_subroot"))
    for tier in reversed(over):
        outer = _paths(tier, outer, with_ids=tier is over[0])
    for tier in reversed(tiers[1:]):
        outer = _paths(tier, outer, with_ids=False)

    def prove(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, leaves, paths in _each_leaf(batch):
                claims, subroot, out = _digests(row["_claims"]), row["_subroot"].hex(), []
                for i, path in paths:
                    joined = b"".join(left + right for left, right in path)
                    out.append((row["_ids"][i], leaves[i].decode(), subroot, [joined[k:k + 64].decode() for k in range(0, len(joined), 64)],
                                hashlib.sha256(joined).hexdigest(), folded(claims[i], path).decode()))
                types = (pa.int64(), pa.string(), pa.string(), pa.list_(pa.string()), pa.string(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)],
                                                 ["doc_id", "leaf", "subroot", "siblings", "proof_sha256", "folded_root"])

    done = tiers[0].join(outer, ["_tree", "_block"]).mapInArrow(
        prove, "doc_id long, leaf string, subroot string, siblings array<string>, proof_sha256 string, folded_root string")
    return done.withColumns({"root": F.lit(root).cast("string"), "verified": F.col("folded_root") == F.lit(root)})
