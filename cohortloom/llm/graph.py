"""Connected components of an edge list, by joins alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.common import discard, stored


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, label) of every node with an edge (a, b); the label is the smallest node of its component.

    Each round lets every node point to its smallest neighbour and to where that one
    points, then contracts the edges to the nodes pointed to, so that few are left after
    a round or two. When none is left, the rounds' pointers are followed one after
    another. Edges and pointers are stored tables, so a lost executor costs one round, and
    are deleted once what follows from them is stored.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    links = stored(both.filter("a != b").distinct(), f"{name}-links")
    rounds: list[DataFrame] = []
    while not rounds or not links.isEmpty():
        near = links.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("up")).withColumn("up", F.least("node", "up"))
        near = stored(near, f"{name}-near")
        above = near.select(F.col("node").alias("up"), F.col("up").alias("top"))
        pointers = stored(near.join(above, "up").select("node", F.col("top").alias("up")), f"{name}-pointers")
        discard(near)
        rounds.append(pointers)
        left = links.join(pointers.withColumnRenamed("node", "a"), "a").select(F.col("up").alias("x"), "b")
        moved = left.join(pointers.select(F.col("node").alias("b"), F.col("up").alias("y")), "b").filter("x != y")
        before, links = links, stored(moved.select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(), f"{name}-links")
        discard(before)
    labels = rounds[0].withColumnRenamed("up", "label")
    for pointers in rounds[1:]:
        labels = labels.join(pointers.select(F.col("node").alias("label"), "up"), "label", "left")
        labels = labels.select("node", F.coalesce("up", "label").alias("label"))
    labels = stored(labels, f"{name}-labels")
    discard(links, *rounds)
    return labels
