"""From texts that share sketch bands to verified links, without all pairs of a band.

In every band all members are first compared with one of them, the one whose
bands are the most crowded (in a group of copies that is the text nearest to
all). What that links is one component and needs no further pair. Members of
bands that then still hold several components are joined again, on their rarest
elements: two multisets of the wanted similarity must have one in common among
so many of the rarest that they cannot all differ (prefix filter), and what no
other text has cannot be common. Both bounds hold for certain, so every pair that
shares a band is compared, already joined, or ruled out.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postline.llm.common import stage
from postline.llm.components import components

#: How often elements are counted again without the nodes that were ruled out.
PASSES = 2

Verify = Callable[[DataFrame], DataFrame]


def shared_bands(bands: DataFrame) -> DataFrame:
    """(band, node, size) of the bands that hold two nodes or more."""
    sizes = bands.groupBy("band").agg(F.count("*").alias("size")).where("size > 1")
    return bands.join(sizes, "band")


def star_pairs(shared: DataFrame) -> DataFrame:
    """(a, b): each band's most crowded member a with each of the others."""
    crowd = shared.groupBy("node").agg(F.sum("size").alias("crowd"))
    ranked = shared.join(crowd, "node")
    center = ranked.groupBy("band").agg(F.max(F.struct("crowd", "node")).alias("top")).select("band", F.col("top.node").alias("a"))
    return ranked.join(center, "band").where("a <> node").select("a", F.col("node").alias("b")).distinct()


def with_roots(members: DataFrame, roots: DataFrame) -> DataFrame:
    return members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def undecided(shared: DataFrame, roots: DataFrame) -> DataFrame:
    """(node, root) of the members of bands that hold several components."""
    placed = with_roots(shared.select("band", "node"), roots)
    mixed = placed.groupBy("band").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("band")
    return placed.join(mixed, "band").select("node", "root").distinct()


def ranked_elements(elements: DataFrame, percent: int) -> DataFrame:
    """(node, element, before, whole, sharable): each node's elements that others have too, the rarest first.

    elements: (node, element, weight). `before` is the weight that comes before
    an element, with all that the node has alone at the front. Nodes whose
    sharable weight is below the wanted part of their whole are left out, and
    what only those had in common counts no more in the next pass.
    """
    whole = elements.groupBy("node").agg(F.sum("weight").alias("whole"))
    for _ in range(PASSES):
        counts = stage(elements.groupBy("element").agg(F.count("*").alias("n")).where("n > 1"))
        common = elements.join(counts, "element")
        part = common.groupBy("node").agg(F.sum("weight").alias("sharable"))
        able = stage(whole.join(part, "node").where(F.col("sharable") * 100 >= F.col("whole") * percent))
        elements = stage(elements.join(able.select("node"), "node"))
    earlier = Window.partitionBy("node").orderBy("n", "element").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("whole") - F.col("sharable") + F.coalesce(F.sum("weight").over(earlier), F.lit(0))
    return common.join(able, "node").withColumn("before", before).select("node", "element", "before", "whole", "sharable")


def open_pairs(members: DataFrame, texts: DataFrame, elements: Verify, percent: int) -> DataFrame:
    """(a, b) of different components among members (node, root) that may be similar.

    Of a pair the larger one (ties by node) must have an element of its first
    `longer` weights among the first `shorter` ones of the other. From the first
    element that they have in common on, no more than the smaller rest is common.
    """
    found = stage(elements(texts.join(members.select("node"), "node", "left_semi")))
    ranked = stage(ranked_elements(found, percent).join(members, "node"))
    longer = F.col("whole") - F.ceil(F.col("whole") * percent / 100) + 1
    shorter = F.col("whole") - F.ceil(F.col("whole") * (2 * percent) / (100 + percent)) + 1
    large = ranked.where(F.col("before") < longer)
    columns = ("node", "root", "whole", "sharable", "before")
    small = ranked.where(F.col("before") < shorter).select("element", *(F.col(c).alias(f"{c}_b") for c in columns))
    most = F.least("sharable", "sharable_b", F.col("whole") - F.col("before"), F.col("whole_b") - F.col("before_b"))
    may_be = 100 * most >= percent * (F.col("whole") + F.col("whole_b") - most)
    once = F.struct("whole", "node") > F.struct("whole_b", "node_b")
    pairs = large.join(small, "element").where(once & (F.col("root") != F.col("root_b")) & may_be)
    return pairs.select(F.least("node", "node_b").alias("a"), F.greatest("node", "node_b").alias("b")).distinct()


def linked(bands: DataFrame, texts: DataFrame | Verify, verify: Verify, elements: Verify, percent: int) -> DataFrame:
    """(node, root) of all nodes that have a verified link.

    bands: (band, node), each once. texts: (node, text), each node once, or what
    gives these for a table of nodes. verify takes rows (a, b, text_a, text_b) and returns (a, b) of those that hold;
    elements takes texts and returns (node, element, weight) of the multisets
    whose Jaccard similarity in percent a link must reach.
    """
    shared = stage(shared_bands(bands))
    nodes = shared.select("node").distinct()
    held = stage(texts(nodes) if callable(texts) else texts.join(nodes, "node", "left_semi"))
    tried = stage(star_pairs(shared))
    roots = stage(components(verify(with_texts(tried, held))))
    known = tried.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    members = stage(undecided(shared, roots))
    rest = stage(open_pairs(members, held, elements, percent).join(known, ["a", "b"], "left_anti"))
    more = stage(verify(with_texts(rest, held)))
    if more.isEmpty():
        return roots
    return stage(components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more.select("a", "b"))))


def with_texts(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """pairs with text_a and text_b; texts: (node, text), each node once."""
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    return pairs.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b")


def node_of(text: Column) -> Column:
    """128-bit hash of a text: exact copies are one node."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))
