"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


class Forest:
    """Union-find whose roots are the smallest members."""

    def __init__(self):
        self.up: dict = {}

    def find(self, x):
        root = x
        while (y := self.up.get(root, root)) != root:
            root = y
        while x != root:
            self.up[x], x = root, self.up.get(x, x)
        return root

    def join(self, a, b) -> bool:
        """Whether a and b were apart."""
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


def _forests(batches):
    """The links of one task as stars around its smallest members; a task's links are a share of all, whatever its order."""
    forest, nodes = Forest(), set()
    for pdf in batches:
        for a, b in zip(pdf["a"].tolist(), pdf["b"].tolist()):
            forest.join(a, b)
            nodes.add(a)
            nodes.add(b)
        if len(nodes) > 500_000:
            yield _stars(forest, nodes)
            forest, nodes = Forest(), set()
    yield _stars(forest, nodes)


def _stars(forest: Forest, nodes: set) -> pd.DataFrame:
    pairs = [(n, r) for n in nodes if (r := forest.find(n)) != n]
    return pd.DataFrame(pairs, columns=["a", "b"], dtype="int64")


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """node and root (the smallest node reachable) for every node of links (a long, b long), written out each round, until a round
    changes nothing (after about the logarithm of the longest path).

    Only minima per node meet in groups, so that a node of any degree is pre-aggregated; links pass as rows.  They are written
    first, so that Python that makes them and the Python here do not hold a worker each in the same task.
    """
    links = stored(links.select("a", "b").where("a <> b"), "links")
    edges = stored(links.mapInPandas(_forests, "a long, b long").distinct(), "edges")
    before = _state(edges)
    while before[0]:
        # edges point from the larger to the smaller end
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stored(large.where("a <> b").distinct(), "edges")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        kept = large.join(least, "a")
        edges = kept.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
        edges = stored(edges.where("a <> b").distinct(), "edges")
        now = _state(edges)
        if now == before:
            break
        before = now
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
