"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.llm.common import cut


def _state(edges: DataFrame) -> tuple:
    """A fingerprint of the edge set, to see whether it still changes."""
    mark = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count("*"), F.bit_xor(mark), F.sum(mark % 1_000_003)).first())


def _with_least(edges: DataFrame) -> DataFrame:
    """Edges with the least end at ``u``. The join, unlike a list, may split a hot node."""
    least = edges.groupBy(F.col("u").alias("_u")).agg(F.min("v").alias("_least"))
    joined = edges.join(least, F.col("u") == F.col("_u"))
    return joined.select("u", "v", F.least("u", "_least").alias("m"))


def components(edges: DataFrame) -> DataFrame:
    """The least node reachable from each node that has an edge: columns ``node`` and ``root``.

    ``edges`` has columns ``u`` and ``v``. Large and small stars alternate: every node hangs its
    larger neighbours, then its smaller ones, on the least of them, until nothing changes, which
    takes a number of rounds logarithmic in the longest chain. Each round is written to the shared
    folder. Nothing but the state's three numbers reaches the driver.
    """
    edges = edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    edges = cut(edges.distinct(), "edges")
    state = _state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        stars = _with_least(large.where("u != v").distinct())
        small = stars.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            stars.select("u", F.col("m").alias("v"))
        )
        edges = cut(small.where("u != v").distinct(), "edges")
        before, state = state, _state(edges)
        if state == before:
            break
    ends = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return ends.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
