"""Connected components by alternating large and small stars, each a grouping and a join."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweave.sources.staging import stage


def _stars(edges: DataFrame, keep: str) -> DataFrame:
    """Every node's neighbours, those that ``keep`` chooses, are linked to the smallest of them all and itself."""
    least = edges.groupBy(F.col("u").alias("node")).agg(F.least(F.min("v"), F.first("u")).alias("least"))
    return (edges.filter(keep).join(least, F.col("u") == F.col("node"))
            .select(F.greatest("v", "least").alias("u"), F.least("v", "least").alias("v")).filter("u <> v").distinct())


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component``, the smallest node that it is connected with, for all nodes of the edges ``a``, ``b``."""
    now = stage(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "edges")
    mark = None
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _stars(both, "v > u")
        small = large.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("least"))
        now = stage(large.join(small, F.col("u") == F.col("node")).select(F.explode(F.array(
            F.struct(F.col("u").alias("u"), F.col("least").alias("v")), F.struct(F.col("v").alias("u"), F.col("least").alias("v")))).alias("e"))
            .select("e.*").filter("u <> v").distinct(), "edges")
        count, total = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if mark == (count, total):
            break
        mark = (count, total)
    stars = now.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
    return stars.union(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def merged_labels(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Within a task: the smallest row number of each row's component, after linking the rows a and b. ``labels`` is changed."""
    while True:
        x, y = labels[a], labels[b]
        apart = x != y
        if not apart.any():
            return labels
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(labels, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(jumped := labels[labels], labels):
            labels = jumped
