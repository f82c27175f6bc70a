"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import saved

FEW = 200_000  # edges that the driver may hold: 3 MB


def components_of_few(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of some edges and the smallest node of the component of each."""
    names, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    u, v = at[: len(u)], at[len(u) :]
    of = np.arange(len(names))
    while len(u):
        least = of.copy()
        np.minimum.at(least, np.maximum(u, v), np.minimum(u, v))
        while not np.array_equal(least, least[least]):
            least = least[least]
        of = least[of]
        u, v = of[u], of[v]
        u, v = u[u != v], v[u != v]
    return names, names[of]


def connected_components(edges: DataFrame, few: int = FEW) -> DataFrame:
    """(node, component) of every node of edges(u, v); the component is its smallest node.

    Alternating large and small stars: O(log^2 n) rounds in the worst case, each a minimum per node (combined before the
    shuffle) and a join that Spark may split for hubs. Every round is written to the shared folder, so that no lineage
    grows and lost executors cost one round at most. Loops and repeated edges do no harm; no edges: no rows. Up to `few`
    edges (a saved table's) need no rounds: the driver names their components.
    """
    if edges.limit(few + 1).count() <= few:
        found = edges.select(F.col("u").cast("long"), F.col("v").cast("long")).toArrow()
        node, component = components_of_few(*(c.to_numpy() for c in found.columns))
        return edges.sparkSession.createDataFrame(pa.table({"node": node, "component": component}))
    now = saved(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct())
    # the end: no node has two edges down, and none that has one is the lower end of another
    while not now.select("u").union(now.select("v").distinct()).groupBy("u").count().where("count > 1").isEmpty():
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = low.groupBy("u").agg(F.min("v").alias("m"))
        small = low.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = saved(small.union(least.select("u", F.col("m").alias("v"))).distinct())
    return now.toDF("node", "component").union(now.select("v", "v").distinct().toDF("node", "component"))
