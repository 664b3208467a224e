"""Connected components of an edge list by randomised contraction."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indexkit.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b).

    Each round maps every node to the neighbour (or itself) of least random
    rank, relabels the edges and drops loops; a constant share of the nodes goes
    in each round, so rounds grow with the logarithm of the largest component,
    whatever its shape.  Hub nodes are aggregated map-side; every round is
    written to the shared folder, never held on the driver."""
    left = stored(edges.select("a", "b").filter("a <> b").distinct(), "cc-edges")
    labels = left.select(F.col("a").alias("node")).unionByName(left.select(F.col("b").alias("node"))).distinct() \
        .withColumn("root", F.col("node"))
    labels, turn = stored(labels, "cc-labels"), 0
    while not left.isEmpty():
        rank = lambda c: F.struct(F.xxhash64(c, F.lit(turn)).alias("r"), F.col(c).alias("n"))  # noqa: B023,E731
        both = left.select("a", "b").unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = stored(both.groupBy("a").agg(F.min(rank("b")).alias("m")).select(
            F.col("a").alias("was"), F.least(rank("a"), F.col("m"))["n"].alias("now")), "cc-step")
        labels = stored(labels.join(step, F.col("root") == F.col("was"), "left").select(
            "node", F.coalesce("now", "root").alias("root")), "cc-labels")
        one = left.join(step, F.col("a") == F.col("was")).select(F.col("now").alias("a"), "b")
        two = one.join(step, F.col("b") == F.col("was")).select("a", F.col("now").alias("b"))
        left = stored(two.filter("a <> b").distinct(), "cc-edges")
        turn += 1
    return labels


def local_roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Least member of each of ``n`` nodes' component under pairs (i, j)."""
    label = np.arange(n)
    while len(i):
        low = np.minimum(label[i], label[j])
        before = label.copy()
        np.minimum.at(label, i, low)
        np.minimum.at(label, j, low)
        label = label[label]
        if (label == before).all():
            break
    return label
