"""Connected components of links that are too many for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from strata.llm.common import written


def _kept(edges: DataFrame) -> tuple[DataFrame, dict]:
    """The distinct edges as a table, with their number and a checksum taken while writing."""
    state = Observation()
    edges = edges.where("u != v").distinct()
    edges = edges.observe(state, F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("sum"))
    return written(edges, "links"), state.get


def parents(links: DataFrame) -> DataFrame:
    """``node, root`` for every end of ``links(a, b)`` but the roots, their component's smallest nodes.

    Large-star and small-star steps in turn: each node links its neighbours to the smallest one,
    first the larger neighbours, then the smaller.  Every step is a grouping and a join on
    written tables.  A round is one write whose plan holds each step once, without unions: the
    driver's memory grows with the exchanges and broadcasts it starts, however small they are.
    """
    edge = lambda u, v: F.struct(F.col(u).alias("u"), F.col(v).alias("v"))
    both = F.inline(F.array(edge("u", "v"), edge("v", "u")))
    edges, state = _kept(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")))
    before = None
    while state["n"] and state != before:  # u > v in all edges
        least = edges.select(both).groupBy("u").agg(F.least(F.min("v"), "u").alias("m"))
        large = edges.join(least.withColumnRenamed("u", "v"), "v").select("u", F.col("m").alias("v"))
        small = large.join(large.groupBy("u").agg(F.min("v").alias("m")), "u")
        before = state
        edges, state = _kept(small.select(F.inline(F.array(edge("u", "m"), edge("v", "m")))))
    return edges.toDF("node", "root")


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every end of ``links(a, b)``; the root is the component's smallest node."""
    found = parents(links)
    return found.union(found.select("root", "root").distinct())
