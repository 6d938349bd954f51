"""Connected components of a table of links, by alternating star contractions.

Large-star: every node gives its larger neighbours its smallest one. Small-star: every node gives its
smaller neighbours its smallest one. A number of rounds that grows with the logarithm of the longest
path ends in stars around the smallest node. Links are first reduced to forests by tasks of FOREST_ROWS links; so
few links are done with that, in one task of bounded size and without rounds. Each round's tables are stored: lineage is cut, and a
join reads both sides from files, so that adaptive execution can split a node with very many links.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from variantry.llm.store import stored

FOREST_ROWS = 1 << 18


def _forest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Union-find over at most FOREST_ROWS links at a time: the same components with fewer links."""
    parent: dict[int, int] = {}

    def root(node: int) -> int:
        top = node
        while (up := parent.setdefault(top, top)) != top:
            top = up
        while parent[node] != top:
            parent[node], node = top, parent[node]
        return top

    def drained() -> pd.DataFrame:
        rows = [(node, top) for node in list(parent) if (top := root(node)) != node]
        parent.clear()
        return pd.DataFrame(rows, columns=["a", "b"]).astype("int64")

    seen = 0
    for frame in frames:
        for a, b in zip(frame["a"].tolist(), frame["b"].tolist(), strict=True):
            low, high = sorted((root(a), root(b)))
            parent[high] = low
        seen += len(frame)
        if seen >= FOREST_ROWS:
            yield drained()
            seen = 0
    yield drained()


def _large_star(links: DataFrame) -> DataFrame:
    both = stored(links.union(links.select("b", "a")), "links")
    lowest = stored(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low")), "lowest")
    return both.where("b > a").join(lowest, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    down = stored(down.where("a <> b").distinct(), "links")
    lowest = stored(down.groupBy("a").agg(F.min("b").alias("low")), "lowest")
    found = down.join(lowest, "a")
    stars = found.select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b")
    return stars.union(lowest.select("a", F.col("low").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """Rows (node, root) for every node of `links` (a, b: long) but the roots, each the smallest of its component."""
    links = stored(links.where("a <> b"), "links")
    tasks = max(1, -(-links.count() // FOREST_ROWS))
    forest = links.coalesce(tasks).mapInPandas(_forest, "a long, b long")
    if tasks == 1:
        return stored(forest, "forest").select(F.col("a").alias("node"), F.col("b").alias("root"))
    links = stored(forest.distinct(), "links")
    before = None
    while True:
        links = stored(_small_star(_large_star(links)), "links")
        state = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state
