"""Connected components of a graph given by edges, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.session import drop_scratch, materialise


def _folder(df: DataFrame) -> str | None:
    files = df.inputFiles()
    return files[0].rpartition("/")[0] if files else None


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Links the neighbours of every node to the least of them and the node. ``large`` looks at all neighbours and links those above the node, else those below.

    The least neighbour comes from an aggregation that is combined before the shuffle; no list of neighbours is built,
    so a node with very many of them is no burden to one task.
    """
    if large:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    linked = both.join(least, "a")
    if large:
        new = linked.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        new = linked.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(linked.select("a", F.col("m").alias("b")))
    return new.where("a <> b").distinct()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node with an edge to another, root the least node of its component. Nodes are bigints.

    Each round is written to the shared folder, so lost executors cost one round; the number of rounds grows with the
    logarithm of the longest chain. Null ends and loops don't count; without edges there are no rows.
    """
    start = edges.select(F.greatest(a, b).cast("long").alias("a"), F.least(a, b).cast("long").alias("b")).where("a is not null and b is not null and a <> b").distinct()
    now = materialise(start, "edges")
    while True:
        new = materialise(_star(_star(now, True), False), "edges")
        # the least fingerprint of a fixed point: equal edge sets
        marks = [e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first() for e in (now, new)]
        if (old := _folder(now)) is not None:
            drop_scratch(now.sparkSession, old)
        now = new
        if marks[0] == marks[1]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).distinct()
