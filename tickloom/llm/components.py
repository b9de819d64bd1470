"""Connected components of a graph given as an edge table, by alternating star contractions."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, functions as F

from tickloom.session import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node links its larger neighbours to its smallest one (or to itself, if it is smaller)."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("least")).select(F.col("a").alias("u"), F.least("least", "a").alias("least"))
    joined = both.join(least, both["a"] == least["u"]).where(F.col("b") > F.col("a"))
    return joined.select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node links itself and its smaller neighbours to the smallest of them; edges run from larger to smaller."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    moved = edges.join(least, "a").where(F.col("b") != F.col("least")).select(F.col("b").alias("a"), F.col("least").alias("b"))
    return least.select("a", F.col("least").alias("b")).union(moved).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """`node`, `component` (smallest node of the component) for every node of an edge (`a`, `b`).

    Edges may repeat and run either way; loops are left out. Each round is written to the shared folder,
    so lineage stays short and a lost executor costs one round; the driver only sees a count and a checksum.
    The number of rounds grows with the logarithm of the longest path.
    """
    ordered = edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    current, before = materialize(ordered, "edges"), None
    while True:
        state = current.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == before or state[0] == 0:
            break
        before = state
        current = materialize(_small_star(_large_star(current)), "edges")
    leaves = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return leaves.union(current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def spanning_forest(certain: np.ndarray, possible: np.ndarray | None = None, test: Callable[[int, int], bool] | None = None) -> list[tuple[int, int]]:
    """Edges of a spanning forest of a symmetric boolean matrix, each tree rooted at its smallest position.

    `possible` pairs are edges if `test` says so; it is asked only where it could join two trees.
    """
    links, new = [], np.ones(len(certain), bool)
    for start in range(len(certain)):
        if not new[start]:
            continue
        new[start], stack = False, [start]
        while stack:
            u = stack.pop()
            found = np.flatnonzero(certain[u] & new).tolist()
            if possible is not None:
                found += [v for v in np.flatnonzero(possible[u] & new & ~certain[u]).tolist() if test(u, v)]
            new[found] = False
            links += [(u, v) for v in found]
            stack += found
    return links
