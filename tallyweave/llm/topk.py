"""Exact top-k inner products with KD-trees per shard.

Vectors are dealt to cells by median splits of a sample (at most ``SAMPLE_ROWS`` vectors of the commonest length; other lengths are
one cell each), and a cell's vectors to shards by a hash of their ids; each shard is built into a KD-tree by median splits along the
widest axis, with a tight bounding box per node, and written out. A query is first searched in its
own shard; the kth score found there goes along to the shards of
all cells whose boxes may hold a better one, where nodes whose best possible score is under it are never opened. Within a tree, nodes are visited best bound first.
Queries meet trees in blocks, so one task holds one tree and one block.

Components become floor(1024 * x). Rows with a NULL id, a NULL vector, or NULL or non-finite components
take no part. Of rows with the same id, the smallest vector counts. A query meets only vectors of
its own length, and never its own id. Fewer candidates than k give fewer rows; no rows give none.
Scores that do not fit a long are given as the nearest long; they are ordered exactly.
"""

from __future__ import annotations

import heapq
import io
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyweave.sources.staging import stage

SHARD_ROWS, LEAF_ROWS, BLOCK_QUERIES = 8192, 64, 1024
MAX_CELLS, BOX_NUMBERS = 256, 1 << 18  # cells, and numbers in a side of all their boxes
SAMPLE_ROWS, SAMPLE_NUMBERS = 4096, 1 << 22  # vectors that cells are fitted on, and numbers in them
_EXACT = 2.0 ** 53


def scaled(vector: np.ndarray, scale: float = 1024.0) -> np.ndarray:
    """floor(scale * x) as whole doubles, or as Python integers where doubles would round."""
    values = np.floor(np.asarray(vector, np.float64) * scale)
    if values.size and not np.abs(values).max() < _EXACT:
        return np.array([int(v) if abs(v) < _EXACT else int(x) * int(scale) for v, x in zip(values.tolist(), map(float, vector))], object)
    return values


def _matrix(vectors: list[np.ndarray]) -> np.ndarray:
    """Rows as doubles while every inner product is exact in them, else as Python integers."""
    out = np.array(vectors)
    if out.dtype != object and out.size and float(np.abs(out).max()) ** 2 * out.shape[1] >= _EXACT:
        out = np.array([[int(x) for x in row] for row in out.tolist()], object).reshape(out.shape)
    return out


class KDTree:
    """Leaves hold consecutive rows; ``low`` and ``high`` bound the rows below each node."""

    def __init__(self, ids: np.ndarray, points: np.ndarray, leaf_rows: int = LEAF_ROWS):
        order, nodes = np.arange(len(ids)), []
        todo = [(0, len(ids), None)]
        while todo:
            first, last, parent = todo.pop()
            own = points[order[first:last]]
            low, high = own.min(axis=0), own.max(axis=0)
            node = len(nodes)
            nodes.append([first, last, -1, -1, low, high])
            if parent is not None:
                nodes[parent][2 if nodes[parent][2] < 0 else 3] = node
            spread = high - low
            axis = int(np.argmax(spread)) if spread.size else 0
            if last - first > leaf_rows and spread.size and spread[axis] > 0:
                middle = (last - first) // 2
                rank = np.argsort(own[:, axis], kind="stable") if own.dtype == object else np.argpartition(own[:, axis], middle)
                order[first:last] = order[first:last][rank]
                todo += [(first + middle, last, node), (first, first + middle, node)]
        self.ids, self.points = ids[order], points[order]
        self.spans = np.array([n[:4] for n in nodes], np.int64)
        self.low, self.high = np.array([n[4] for n in nodes]), np.array([n[5] for n in nodes])

    def packed(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, ids=self.ids, points=self.points, spans=self.spans, low=self.low, high=self.high)
        return out.getvalue()

    @classmethod
    def unpacked(cls, data: bytes) -> KDTree:
        tree = cls.__new__(cls)
        with np.load(io.BytesIO(data), allow_pickle=True) as found:  # written by packed() in this job
            for name in ("ids", "points", "spans", "low", "high"):
                setattr(tree, name, found[name])
        return tree

    def search(self, own_id: int, query: np.ndarray, k: int, at_least=None) -> list[tuple]:
        """The k best ``(score, -id)``, best first, of those that reach the score ``at_least``."""
        if query.dtype == object or self.points.dtype == object or (
                query.size and float(np.abs(query).max()) * max(float(np.abs(self.low[0]).max()), float(np.abs(self.high[0]).max())) * query.size >= _EXACT):
            query, points, low, high = (np.vectorize(int, otypes=[object])(x) if x.size else x for x in (query, self.points, self.low, self.high))
        else:
            points, low, high = self.points, self.low, self.high
        bounds = high @ np.maximum(query, 0) + low @ np.minimum(query, 0)  # best score in a node's box
        best: list[tuple] = []  # a heap, worst first
        queue = [(-bounds[0], 0)]
        while queue:
            bound, node = heapq.heappop(queue)
            kth = best[0][0] if len(best) == k else at_least
            if kth is not None and -bound < kth:
                break
            first, last, left, right = self.spans[node]
            if left >= 0:
                for child in (left, right):
                    if kth is None or bounds[child] >= kth:
                        heapq.heappush(queue, (-bounds[child], child))
                continue
            scores = points[first:last] @ query
            for at in np.flatnonzero(scores >= kth) if kth is not None else range(last - first):
                found = (scores[at], -int(self.ids[first + at]))
                if found[1] != -own_id:
                    if len(best) < k:
                        heapq.heappush(best, found)
                    elif found > best[0]:
                        heapq.heapreplace(best, found)
        return sorted(best, reverse=True)


def _rows(query_id: int, found: list[tuple]) -> Iterator[tuple]:
    for score, negative in found:
        whole = int(score)
        yield query_id, -negative, max(-(1 << 63), min((1 << 63) - 1, whole)), str(whole)


@dataclass(frozen=True)
class Cells:
    """Space cut in boxes by median splits of a sample: inner nodes have an axis and a border, leaves have numbers."""
    nodes: list[tuple[int, float, int, int]]  # axis (-1: leaf), border, left (leaf: its number), right
    count: int

    @classmethod
    def fitted(cls, sample: np.ndarray, most: int) -> Cells:
        nodes: list[tuple[int, float, int, int]] = []
        leaves, count = max(1, most), 0
        todo = [(sample, leaves, -1, False)]
        while todo:
            own, share, parent, right = todo.pop()
            node = len(nodes)
            if parent >= 0:
                axis, border, a, b = nodes[parent]
                nodes[parent] = (axis, border, a, node) if right else (axis, border, node, b)
            spread = own.max(axis=0) - own.min(axis=0) if own.size else np.zeros(0)
            axis = int(np.argmax(spread)) if spread.size else -1
            inside = own[:, axis] < (border := float(np.median(own[:, axis]))) if axis >= 0 else None
            if share < 2 or axis < 0 or not inside.any():  # nothing smaller than the median: not to be split
                nodes.append((-1, 0.0, count, 0))
                count += 1
                continue
            nodes.append((axis, border, -1, -1))
            todo += [(own[~inside], share // 2, node, True), (own[inside], share - share // 2, node, False)]
        return cls(nodes, count)

    def of(self, points: np.ndarray) -> np.ndarray:
        """The number of each point's cell."""
        out = np.zeros(len(points), np.int32)
        todo = [(0, np.arange(len(points)))]
        while todo:
            node, rows = todo.pop()
            axis, border, left, right = self.nodes[node]
            if axis < 0:
                out[rows] = left
            else:
                inside = points[rows, axis] < border
                todo += [(left, rows[inside]), (right, rows[~inside])]
        return out


def reached(query: np.ndarray, kth: int | None, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The boxes that may hold a point whose inner product with the query is at least ``kth``; bounds are rounded up."""
    if kth is None or query.dtype == object or abs(kth) >= 2 ** 1000:
        return np.arange(len(low))
    bound = high @ np.maximum(query, 0) + low @ np.minimum(query, 0)
    size = np.maximum(np.abs(low), np.abs(high)) @ np.abs(query)
    return np.flatnonzero(~(bound + 1e-12 * (len(query) + 1) * size + 1.0 < float(kth)))


def _cells(usable: DataFrame, dim: int, shards: int) -> Cells:
    most = max(1, min(shards, MAX_CELLS, BOX_NUMBERS // max(1, dim)))
    rows = min(SAMPLE_ROWS, SAMPLE_NUMBERS // max(1, dim)) if most > 1 else 0
    sample = (usable.filter(F.col("_dim") == dim).orderBy(F.xxhash64("_id", F.lit("cells")), "_id").limit(rows).select("_vector").collect()) if rows else []
    return Cells.fitted(np.array([row[0] for row in sample], np.float64).reshape(len(sample), dim), most)


def _boxes(trees: DataFrame, dim: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The box of each cell, out of those of its trees; a cell without rows has an empty one."""
    sides = (trees.filter(F.col("_dim") == dim).select("_cell", F.posexplode(F.arrays_zip("_low", "_high")).alias("axis", "s"))
             .groupBy("_cell", "axis").agg(F.min("s._low").alias("low"), F.max("s._high").alias("high")).toPandas())  # BOX_NUMBERS rows at most
    low, high = np.full((count, dim), np.inf), np.full((count, dim), -np.inf)
    at = (sides["_cell"].to_numpy(np.int64), sides["axis"].to_numpy(np.int64))
    low[at], high[at] = sides["low"], sides["high"]
    return low, high


def top_k(vectors: DataFrame, k: int = 10, every: int = 100, shard_rows: int = SHARD_ROWS,
          block_queries: int = BLOCK_QUERIES, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` for the rows whose id is divisible by ``every``."""
    x = F.col("_vector")
    usable = (vectors.select(F.col(id_column).cast("long").alias("_id"), F.col(vector_column).cast("array<double>").alias("_vector"))
              .filter("_id is not null and _vector is not null")
              .filter(F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))))
              .groupBy("_id").agg(F.min("_vector").alias("_vector")))
    usable = stage(usable.withColumn("_dim", F.size("_vector")), "vectors")
    most = usable.groupBy("_dim").count().orderBy(F.desc("count"), "_dim").first()
    dim, rows_of_dim = tuple(most) if most else (0, 0)
    cells = _cells(usable, dim, -(-rows_of_dim // shard_rows))

    @F.pandas_udf("int")
    def cell_of(found: pd.Series) -> pd.Series:
        out = np.zeros(len(found), np.int32)
        at = np.flatnonzero(found.map(len).to_numpy() == dim)
        if cells.count > 1 and len(at):
            out[at] = cells.of(np.stack(found.iloc[at].to_list()))
        return pd.Series(out)

    placed = usable.withColumn("_cell", cell_of("_vector")) if cells.count > 1 else usable.withColumn("_cell", F.lit(0))
    sizes = usable.groupBy("_dim").agg(F.ceil(F.count("*") / (every * block_queries)).cast("int").alias("_blocks")).withColumnRenamed("_dim", "_dim_s")
    shards = stage(placed.groupBy("_dim", "_cell").agg(F.ceil(F.count("*") / shard_rows).cast("int").alias("_shards")).select(
        F.col("_dim").alias("_dim_c"), F.col("_cell").alias("_cell_c"), "_shards"), "shards")
    dealt = placed.join(shards, (F.col("_dim") == F.col("_dim_c")) & (F.col("_cell") == F.col("_cell_c"))).withColumn(
        "_shard", F.pmod(F.xxhash64("_id"), F.col("_shards")).cast("int")).drop("_dim_c", "_cell_c", "_shards")

    def build(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("_id")
        points = _matrix([scaled(v) for v in rows["_vector"]])
        tree = KDTree(rows["_id"].to_numpy(np.int64), points.reshape(len(rows), -1))
        own = []
        for query_id, point in zip(rows["_id"].tolist(), points):
            if query_id % every == 0:
                own += _rows(query_id, tree.search(query_id, np.asarray(point), k))
        unbounded = tree.low.dtype == object  # numbers beyond doubles
        low, high = [[math.copysign(math.inf, sign)] * tree.low.shape[1] if unbounded else side[0].tolist() for sign, side in ((-1, tree.low), (1, tree.high))]
        return pd.DataFrame({"_dim": [key[0]], "_cell": [key[1]], "_shard": [key[2]], "_tree": [tree.packed()], "_low": [low], "_high": [high],
                             "_own": [[dict(zip(("query_id", "vec_id", "score", "exact"), row)) for row in own]]})

    trees = stage(dealt.groupBy("_dim", "_cell", "_shard").applyInPandas(
        build, "_dim int, _cell int, _shard int, _tree binary, _low array<double>, _high array<double>, "
               "_own array<struct<query_id: long, vec_id: long, score: long, exact: string>>"), "trees")
    lows, highs = _boxes(trees, dim, cells.count) if cells.count > 1 else (np.zeros((1, dim)), np.zeros((1, dim)))
    own = trees.select(F.explode("_own").alias("o")).select("o.*")
    kth = own.groupBy(F.col("query_id").alias("_query")).agg(F.count("*").alias("_n"), F.array_agg("exact").alias("_scores"))  # k at most
    queries = (dealt.filter(F.col("_id") % every == 0).join(kth, F.col("_id") == F.col("_query"), "left")
               .join(sizes, F.col("_dim") == F.col("_dim_s"))
               .select("_dim", F.col("_cell").alias("_home_cell"), F.col("_shard").alias("_home"), "_id", "_vector",
                       F.when(F.col("_n") >= k, F.col("_scores")).alias("_scores"),
                       F.pmod(F.xxhash64("_id", F.lit("block")), F.greatest(F.col("_blocks"), F.lit(1))).alias("_block")))

    @F.pandas_udf("struct<kth: string, cells: array<int>>")
    def visits(found: pd.Series, scores: pd.Series) -> pd.DataFrame:
        out = []
        for vector, own_scores in zip(found, scores):
            least = None if own_scores is None else min(map(int, own_scores))
            inside = [0] if cells.count == 1 or len(vector) != dim else reached(_matrix([scaled(vector)])[0], least, lows, highs).tolist()
            out.append((None if least is None else str(least), inside))
        return pd.DataFrame(out, columns=["kth", "cells"])

    abroad = (queries.withColumn("_visits", visits("_vector", "_scores"))
              .select("*", F.col("_visits.kth").alias("_kth"), F.explode("_visits.cells").alias("_cell")).drop("_visits", "_scores")
              .join(shards, (F.col("_dim") == F.col("_dim_c")) & (F.col("_cell") == F.col("_cell_c")))
              .withColumn("_shard", F.explode(F.sequence(F.lit(0), F.col("_shards") - 1)))
              .filter("_cell <> _home_cell or _shard <> _home").select("_dim", "_cell", "_shard", "_block", "_id", "_vector", "_kth"))
    blocks = queries.select(F.col("_dim").alias("_dim_b"), "_block").distinct()
    posted = trees.join(blocks, F.col("_dim") == F.col("_dim_b")).select(
        F.col("_dim").alias("_dim_t"), F.col("_cell").alias("_cell_t"), F.col("_shard").alias("_shard_t"), F.col("_block").alias("_block_t"), "_tree")

    def visit(tree_rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if len(tree_rows) and len(asked):
            tree = KDTree.unpacked(tree_rows["_tree"].iloc[0])
            for query_id, vector, least in zip(asked["_id"].tolist(), asked["_vector"], asked["_kth"]):
                point = _matrix([scaled(vector)])[0]
                out += _rows(query_id, tree.search(query_id, point, k, None if least is None else int(least)))
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score", "exact"])

    others = posted.groupBy("_dim_t", "_cell_t", "_shard_t", "_block_t").cogroup(abroad.groupBy("_dim", "_cell", "_shard", "_block")).applyInPandas(
        visit, "query_id long, vec_id long, score long, exact string")
    exact = F.coalesce(F.col("exact").cast("decimal(38,0)"), F.col("score").cast("decimal(38,0)"))
    best_first = Window.partitionBy("query_id").orderBy(exact.desc(), F.col("vec_id"))
    ranked = own.unionByName(others).withColumn("rank", F.row_number().over(best_first)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
