"""Connected components of a graph whose links lie in a frame, by alternating large and small stars.

Every round points neighbours at the smallest number they know of; the rounds needed grow with the
logarithm of the largest distance. A vertex with very many links is no group in any task: its minimum is
combined before the shuffle, and its links meet that minimum in a join that Spark can split.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroom.llm.frames import discard, one_row, settle


def components(links: DataFrame, a: str, b: str, label: str) -> DataFrame:
    """(id, component) for every vertex with a link to another that is not the smallest of its component;
    `component` is the smallest. `a` and `b` hold whole numbers that are not null."""
    big, small = F.greatest(a, b), F.least(a, b)
    links = settle(links.filter(F.col(a) != F.col(b)).select(big.alias("u"), small.alias("v")).distinct(), label)
    known = None
    while True:
        seen = one_row(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % 1_000_000_007)))
        if seen == known or not seen[0]:
            return links.select(F.col("u").alias("id"), F.col("v").alias("component"))
        known = seen
        before, links = links, small_star(large_star(links, label), label)
        discard(before)


def large_star(links: DataFrame, label: str) -> DataFrame:
    both = links.select("v", F.col("v").alias("n")).unionByName(links.select(F.col("u").alias("v"), F.col("v").alias("n")))
    least = both.groupBy("v").agg(F.min("n").alias("m"))
    return settle(links.join(least, "v").select("u", F.col("m").alias("v")).filter("u != v").distinct(), label)


def small_star(links: DataFrame, label: str) -> DataFrame:
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    met = links.join(least, "u").select(F.when(F.col("v") != F.col("m"), F.col("v")).otherwise(F.col("u")).alias("u"), F.col("m").alias("v"))
    turned = settle(met.distinct(), label)
    discard(links)
    return turned


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest vertex that each of n vertices reaches over the links a[i]-b[i], inside one task."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        nxt = root.copy()
        np.minimum.at(nxt, root[a], low)
        np.minimum.at(nxt, root[b], low)
        while not np.array_equal(jump := nxt[nxt], nxt):
            nxt = jump
        if np.array_equal(nxt[root], root):
            return root
        root = nxt[root]
