"""Connected components of a graph of links, by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from leadtide.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); nodes of one component share a root.

    In each round every node moves to the neighbour (or itself) that comes first in a random
    order drawn anew, and links between moved nodes are kept; so the number of nodes falls by
    a constant factor each round, whatever the shape.  Each round is written to the shared
    folder.  Links of a node to itself are allowed; null ends are ignored.
    """
    links = stored(
        links.where(F.col("a").isNotNull() & F.col("b").isNotNull()).select("a", "b").distinct(), "links"
    )
    roots = None
    turn = 0
    while True:
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        ends = both.union(both.select("a", F.col("a").alias("b")))
        moved = stored(
            ends.groupBy("a")
            .agg(F.min(F.struct(F.xxhash64("b", F.lit(turn)).alias("turn"), F.col("b"))).alias("first"))
            .select(F.col("a").alias("node"), F.col("first.b").alias("root")),
            "moved",
        )
        if roots is None:
            roots = moved
        else:
            step = moved.select(F.col("node").alias("old"), F.col("root").alias("new"))
            roots = stored(
                roots.join(step, F.col("root") == F.col("old"), "left")
                .select("node", F.coalesce("new", "root").alias("root")),
                "roots",
            )
        left = moved.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        right = moved.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        links = stored(
            links.join(left, "a").join(right, "b").where("ra <> rb")
            .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(),
            "links",
        )
        if links.isEmpty():
            return roots
        turn += 1
