"""Connected components of a table of links, by rounds of Spark joins."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickweave.llm.common import written


def local_roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Members and the smallest member of their component, for links that fit in
    a task.  The smallest members themselves are left out."""
    nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = place[:len(a)], place[len(a):]
    label = np.arange(len(nodes))
    while True:
        la, lb = label[left], label[right]
        if np.array_equal(la, lb):
            break
        low = np.minimum(la, lb)
        np.minimum.at(label, la, low)
        np.minimum.at(label, lb, low)
        while not np.array_equal(label, label[label]):
            label = label[label]
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node of its component) for every node
    but the roots, from links (columns ``a``, ``b``, any order, repeats allowed).

    Large-star and small-star rounds: every node points its larger neighbours,
    then its smaller ones, to the smallest neighbour, until nothing changes.
    The number of rounds grows with the logarithm of the longest path.  Each
    round is written to the shared folder.
    """
    edges = written(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    mark = F.struct(F.count("*"), F.expr("bit_xor(xxhash64(u, v))"))
    state = edges.select(mark).first()[0]
    while True:
        both = edges.union(edges.select("v", "u").toDF("u", "v"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")).withColumnRenamed("u", "w")
        large = both.join(low, F.col("u") == F.col("w")).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "w")
        small = large.join(low, F.col("u") == F.col("w")).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = written(small.union(low.select("w", "m").toDF("u", "v")).distinct(), "star")
        before, state = state, edges.select(mark).first()[0]
        if state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
