"""Connected components of a table of edges, by alternating star contractions."""

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaar.llm import common
from bazaar.operators.joins import keyed_join


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v") % (1 << 40)).alias("h")).first()
    return row["n"], row["h"]


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b) but the roots: the smallest node that it reaches.

    Edges point from larger to smaller nodes. A large star hangs the larger neighbours of every node on the smallest
    of its neighbours and itself; a small star hangs a node's smaller neighbours on the smallest of them. Both are a
    minimum by node, combined before the shuffle, and a join that splits hot nodes; the rounds grow with the
    logarithm of the nodes. Each round is written, so a lost executor costs one round at most.
    """
    rows = common.saved(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges"
    )
    before = _state(rows)
    while before[0]:
        both = rows.unionByName(rows.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("v"), F.least("u", "m").alias("m"))
        large = keyed_join(rows, least, ["v"], "inner").select("u", F.col("m").alias("v"))
        rows = common.saved(large.distinct(), "edges")
        lowest = rows.groupBy("u").agg(F.min("v").alias("m"))
        hung = keyed_join(rows, lowest, ["u"], "inner")
        small = hung.select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        rows = common.saved(small.distinct(), "edges")
        after = _state(rows)
        if after == before:
            break
        before = after
    return rows.select(F.col("u").alias("node"), F.col("v").alias("root"))


def forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Root index per node 0..n-1 of the edges (a, b): union by the smaller index, within one task."""
    root = np.arange(n)
    a, b = np.asarray(a), np.asarray(b)
    while len(a):
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        np.minimum.at(root, high, low)
        while (root != root[root]).any():
            root = root[root]
        open_ = root[a] != root[b]
        a, b = a[open_], b[open_]
    return root
