"""Connected components of a link table, by alternating stars; nothing is collected."""

from pyspark.sql import DataFrame, functions as F

from chatterscope.llm.common import keep


def _both(edges):
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _star(edges, larger):
    """Links every neighbour of a node (the larger ones only, or the smaller ones and itself) to the least of them."""
    sides = _both(edges)
    if not larger:
        sides = sides.where("b < a")
    least = sides.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
    joined = sides.join(least, "a")
    found = joined.where(F.col("b") > F.col("a")) if larger else joined
    found = found.select(F.col("b").alias("a"), F.col("least").alias("b"))
    if not larger:
        found = found.unionByName(least.select("a", F.col("least").alias("b")))
    return found.where("a <> b").distinct()


def components(edges: DataFrame, name="links") -> DataFrame:
    """a, b: each node that has a link, but the least of its component, next to the least; edges(a, b) are undirected.

    Each round writes its links to the shared folder; it ends when a round changes nothing. Loops and repeated links
    are ignored; an empty table gives an empty one.
    """
    edges = keep(edges.select("a", "b").where("a <> b").distinct(), name)
    before = None
    while True:
        edges = keep(_star(_star(edges, True), False), name)
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(state) == before:
            return edges
        before = tuple(state)
