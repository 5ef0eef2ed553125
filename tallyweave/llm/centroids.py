"""Centroid clustering in whole numbers, by expressions that run inside Spark's JVM.

Components become floor(1024 * x). A round is one pass over the staged vectors: ``zip_with`` and ``aggregate`` give the squared
distance to each centroid, an array literal; ``array_min`` over structs of distance and number chooses the nearest centroid, the
smaller number on ties; one sum per component and cluster, reduced on the map side, gives the next centroids. The driver
sees the centroids alone: ``k`` rows of ``dim`` sums a round, whatever the number of vectors.

Only vectors with exactly ``dim`` components, none NULL, NaN or infinite, take part; others and NULL vectors give no row. The
first centroids are the vectors with the smallest SHA-256 of ``salt`` and id; vectors without an id come last there, and rows that
repeat an id are told apart by their components (rows that agree in both are both taken, and the smaller number wins their ties).
Fewer than ``k`` vectors give fewer clusters, no vectors no rows. An empty cluster keeps its centroid. Components beyond 2^27
(x of 131,072) count as 2^27, so that every distance fits a long; an inertia beyond a long is given as the largest long.
Further columns may have any names; they are left out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweave.sources.staging import stage

SCALE, LARGEST, LONG_MAX = 1024, 1 << 27, (1 << 63) - 1
SCHEMA = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid array<long>"


def whole_vectors(vectors: DataFrame, dim: int, id_column: str, vector_column: str) -> DataFrame:
    """``vec_id`` and ``point``, the components as whole numbers, of the vectors that take part."""
    def scaled(x: Column) -> Column:
        return F.floor(F.greatest(F.lit(-float(LARGEST)), F.least(F.lit(float(LARGEST)), F.floor(x * SCALE)))).cast("long")

    usable = (F.size("x") == dim) & F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("x"))
            .filter(F.col("x").isNotNull()).filter(usable).select("vec_id", F.transform("x", scaled).alias("point")))


def _literal(values: Sequence[int]) -> str:
    return f"array({', '.join(f'{v}L' for v in values)})"


def nearest(centroids: Sequence[Sequence[int]]) -> Column:
    """A struct of ``distance`` and ``cluster`` for the column ``point``; one SQL text, since its thousand literals would each be a call."""
    squared = "aggregate(zip_with(point, {}, (x, c) -> (x - c) * (x - c)), 0L, (s, d) -> s + d)"
    options = [f"struct({squared.format(_literal(c))} as distance, {i} as cluster)" for i, c in enumerate(centroids)]
    return F.expr(f"array_min(array({', '.join(options)}))")


def updated(points: DataFrame, centroids: list[list[int]], sums: list[Column]) -> list[list[int]]:
    """The mean of each cluster's vectors, rounded down; ``sums`` has one sum per component."""
    chosen = points.select("point", nearest(centroids).alias("near"))
    out = list(centroids)
    for cluster, n, *totals in chosen.groupBy("near.cluster").agg(F.count("*"), *sums).collect():  # a row per centroid
        out[cluster] = [total // n for total in totals]
    return out


def clusters(vectors: DataFrame, k: int = 8, rounds: int = 10, dim: int = 64, salt: str = "3:", id_column: str = "vec_id",
             vector_column: str = "embedding") -> DataFrame:
    """One row per vector that takes part: ``vec_id``, ``cluster``, the squared ``distance`` to its centroid, ``cluster_inertia``
    and ``inertia`` (distances summed over its cluster and over all) and the ``centroid`` itself."""
    spark = vectors.sparkSession
    points = stage(whole_vectors(vectors, dim, id_column, vector_column), "points")
    digest = F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")), 256)
    centroids = [list(row["point"]) for row in points.orderBy(digest.asc_nulls_last(), "point").select("point").limit(k).collect()]
    if not centroids:
        return spark.createDataFrame([], SCHEMA)
    sums = [F.sum(F.col("point")[i]) for i in range(dim)]
    for _ in range(rounds):
        centroids = updated(points, centroids, sums)

    chosen = points.select("vec_id", nearest(centroids).alias("near"))
    assigned = stage(chosen.select("vec_id", "near.cluster", "near.distance"), "assigned")
    sums = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()
    inertia = [0] * len(centroids)
    for row in sums:
        inertia[row["cluster"]] = int(row["s"])
    listed = F.expr(f"array({', '.join(map(_literal, centroids))})")
    own = F.col("cluster") + 1
    return assigned.select(
        "vec_id", "cluster", "distance", F.element_at(F.expr(_literal([min(x, LONG_MAX) for x in inertia])), own).alias("cluster_inertia"),
        F.lit(min(sum(inertia), LONG_MAX)).cast("long").alias("inertia"), F.element_at(listed, own).alias("centroid"))
