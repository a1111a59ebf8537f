"""Connected components over an edge table, by alternating large-star and small-star rounds.

Every round is two grouped minima (combined on the map side) and two joins whose many-row side Spark may
split, so a node with a third of all edges is no single task. A round's edges are written to the shared
folder; the driver sees a count and a checksum per round.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hemline.llm.common import Workspace


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def _round(work: Workspace, edges: DataFrame, step: int) -> DataFrame:
    """One large star and one small star; edges go from the larger node ``u`` to the smaller ``v``.

    The minima are written first: both sides of the joins are then exchanged, and Spark can split a frequent node.
    """
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    low = work.write(low, f"low-{step}")
    large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    large = work.write(large, f"large-{step}")
    least = work.write(large.groupBy("u").agg(F.min("v").alias("m")), f"least-{step}")
    small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return small.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def connected(work: Workspace, edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node that has an edge to another one; root is the component's smallest node.

    ``a`` and ``b`` are long columns; rows with a null and loops are no edges. An empty table gives an empty one.
    """
    pairs = edges.filter(f"{a} <> {b}").select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    )
    now = work.write(pairs.distinct(), "edges-0")
    mark, step = _mark(now), 0
    while mark[0]:
        step += 1
        then = work.write(_round(work, now, step), f"edges-{step}")
        for name in (f"edges-{step - 1}", f"low-{step}", f"large-{step}", f"least-{step}"):
            work.drop(name)
        now, before, mark = then, mark, _mark(then)
        if mark == before:
            break
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest member of each component of n numbered items with links a[i]-b[i], by numpy label rounds."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        while not np.array_equal(jumped := new[new], new):
            new = jumped
        label = new[label]
        keep = label[a] != label[b]
        a, b = a[keep], b[keep]
    return label
