"""Connected components of a link table, in rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postline.llm.common import by_sorting, stage


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of links (a, b); root is the smallest node reachable.

    Alternates the large-star and small-star steps until a round changes no
    link: each node is tied to the smallest neighbour it knows, so chains
    shorten by half a round and stars are finished at once. Rows with nulls and
    self links add nothing. Each round is written to the shared folder.
    """
    edges = stage(_clean(links))
    before = None
    while True:
        edges = stage(_small_star(_large_star(edges)))
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if tuple(now) == before:
            break
        before = tuple(now)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def _clean(links: DataFrame) -> DataFrame:
    """Links from the larger to the smaller node, once each."""
    return (
        links.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    """Tie every larger neighbour of a node to the node's smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return _clean(both.join(by_sorting(least), "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    """Tie a node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(by_sorting(least), "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _clean(moved.unionByName(least.select("a", F.col("m").alias("b"))))
