"""Distributed union-find over a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelog.llm.storage import Storage


def components(links: DataFrame, storage: Storage, name: str = "stars", rounds: int = 60) -> DataFrame:
    """``(node, component)`` for every node of ``links(a, b)``; the component is its smallest node.

    Alternates large and small stars: every node sends its larger neighbours, then its smaller
    ones, to the smallest node near it, until each component is one star. The minimum of a hub is
    combined per task, and its neighbours pass through a join that adaptive execution can split.
    Each round is a table of the shared folder. NULL ends and links to oneself are ignored.
    """
    edges = links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = storage.table(edges.distinct(), f"{name}-0")
    for i in range(1, rounds + 1):
        if _settled(edges):
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy(F.col("u").alias("w")).agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(least, F.col("u") == F.col("w"))
        large = large.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v")
        low = large.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m"))
        small = large.join(low, F.col("u") == F.col("w"))
        small = small.select(F.explode(F.array(F.struct(F.col("v").alias("u"), "m"), F.struct("u", "m"))).alias("e"))
        small = small.select("e.u", F.col("e.m").alias("v")).filter("u > v").distinct()
        edges = storage.table(small, f"{name}-{i}")
        storage.drop(f"{name}-{i - 1}")
    else:
        raise RuntimeError(f"links did not settle in {rounds} rounds")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _settled(edges: DataFrame) -> bool:
    """Whether every node has one edge, and none to a node that has an edge itself."""
    if not edges.groupBy("u").count().filter("count > 1").isEmpty():
        return False
    return edges.join(edges.select(F.col("u").alias("w")), F.col("v") == F.col("w"), "left_semi").isEmpty()


def with_more_links(groups: DataFrame, links: DataFrame, storage: Storage, name: str) -> DataFrame:
    """The components of ``groups(node, component)`` after more ``links(a, b)``.

    Only the links between components, mostly few, go through union-find again.
    """
    at = lambda end: groups.select(F.col("node").alias(end), F.col("component").alias(f"{end}_of"))
    joined = links.join(at("a"), "a", "left").join(at("b"), "b", "left")
    joined = joined.select(F.coalesce("a_of", "a").alias("a"), F.coalesce("b_of", "b").alias("b")).filter("a <> b")
    upper = components(joined, storage, name).select(F.col("node").alias("w"), F.col("component").alias("root"))
    moved = groups.join(upper, F.col("component") == F.col("w"), "left").select("node", F.coalesce("root", "component").alias("component"))
    fresh = upper.join(groups, F.col("w") == F.col("node"), "left_anti").select(F.col("w").alias("node"), F.col("root").alias("component"))
    return moved.unionByName(fresh)
