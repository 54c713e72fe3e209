"""Connected components, in memory and over tables."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import settle


def labels_of(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Connected components of nodes 0..n-1 under links a-b: for each node the smallest node it reaches."""
    label = np.arange(n)
    while len(a):
        la, lb = label[a], label[b]
        low = np.minimum(la, lb)
        np.minimum.at(label, la, low)
        np.minimum.at(label, lb, low)
        while True:
            jump = label[label]
            if np.array_equal(jump, label):
                break
            label = jump
        left = label[a] != label[b]
        a, b = a[left], b[left]
    return label


#: Distinct links whose components one task finds; more go by rounds.
FEW_LINKS = 2_000_000
_CHUNK = 1 << 16


def _in_one_task(links: DataFrame) -> DataFrame:
    """components() of distinct links (a, b), few enough for one task to hold."""

    def run(batches):
        held = [[b.column(k).to_numpy() for k in range(2)] for b in batches]
        if not held:
            return
        nodes, at = np.unique(np.concatenate([x for x, _ in held] + [x for _, x in held]), return_inverse=True)
        half = len(at) // 2
        roots = nodes[labels_of(len(nodes), at[:half], at[half:])]
        for i in range(0, len(nodes), _CHUNK):
            yield pa.RecordBatch.from_arrays([pa.array(nodes[i : i + _CHUNK]), pa.array(roots[i : i + _CHUNK])], ["node", "root"])

    return links.select("a", "b").coalesce(1).mapInArrow(run, "node long, root long")


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of edges (a, b long): root is the smallest node reachable. Written to the shared folder.

    Up to FEW_LINKS distinct links meet in one task, as rounds cost the driver some ten jobs each. More go by
    alternating large-star and small-star rounds; a round joins the links to the smallest neighbour of
    each node, so the only hot side of a join is one that Spark splits, and no component meets in one task.
    Each round is written to the shared folder. Rows with a null or a = b are ignored.
    """
    low, high = F.least("a", "b"), F.greatest("a", "b")
    links = settle(edges.where("a is not null and b is not null and a <> b").select(low.alias("a"), high.alias("b")).distinct())

    def digest(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    now = digest(links)
    if now[0] <= FEW_LINKS:
        return settle(_in_one_task(links))
    for _ in range(max_rounds):
        both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(links.select(F.col("b"), F.col("a")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u and v <> m").select(F.col("m").alias("a"), F.col("v").alias("b")).distinct()
        least = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(least, "b").where("a <> m").select(F.col("m").alias("a"), F.col("a").alias("b"))
        links = settle(small.union(least.select(F.col("m").alias("a"), "b")).distinct())
        was, now = now, digest(links)
        if was == now:
            break
    else:
        raise RuntimeError(f"components not settled after {max_rounds} rounds")
    return settle(links.select(F.col("b").alias("node"), F.col("a").alias("root")).union(links.select("a", "a").distinct()))
