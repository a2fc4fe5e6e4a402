"""Connected components of a large graph by alternating star contractions, and local spanning stars.

Every round is two groupings and two joins over the edge list, written to the shared folder, so no step
holds a component, and a component with a third of all vertices is split by the shuffles like any other.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registra.llm.common import drop_written, written


def local_stars(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Replace edges by one star for each of their components: (member, smallest member), without loops."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    far = label != np.arange(len(nodes))
    return nodes[far], nodes[label[far]]


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) of every vertex that has an edge; ``edges`` has the long columns u and v.

    The root is the smallest vertex of the component.  Loops, repeated edges and nulls are dropped.
    An empty graph gives an empty table.
    """
    clean = edges.where("u is not null and v is not null and u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    )
    now = written(clean.distinct(), "edges")
    while True:
        both = now.union(now.select("v", "u")).toDF("u", "v")
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # Large star: each neighbour above u is linked to the smallest of u and its neighbours.
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Small star: each vertex and its smaller neighbours are linked to the smallest of those.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        linked = large.join(least, "u")
        small = linked.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").union(
            least.select("u", F.col("m").alias("v"))
        )
        new = written(small.distinct(), "edges")
        # Every component is a star once no centre has an edge downwards.
        open_ = new.join(new.select(F.col("u").alias("v")).distinct(), "v", "left_semi").limit(1).count()
        drop_written(now)
        now = new
        if not open_:
            break
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
