"""Connected components of an undirected graph as Spark joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from martworks.llm.common import FILES_PER_CORE, staged


#: Edges that a task writes in a round, by the number of edges of the round before.
EDGES_IN_TASK = 100_000


def _staged_edges(edges: DataFrame, before: int | None = None) -> tuple[DataFrame, tuple]:
    """The edges written out, and a mark that changes when the set of them does."""
    seen = Observation()
    marks = F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")
    tasks = None
    if before is not None:
        most = FILES_PER_CORE * edges.sparkSession.sparkContext.defaultParallelism
        tasks = min(most, before // EDGES_IN_TASK + 1)
    edges = staged(edges.distinct().observe(seen, *marks), "edges", tasks)
    return edges, (seen.get.get("n"), seen.get.get("x"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); root is the smallest node reached.

    Alternates two star steps: every node hands its larger neighbours, then its smaller
    ones, to the smallest neighbour it knows. The number of rounds grows with the logarithm
    of the longest chain. A star with a third of all nodes is split: its centre's smallest
    neighbour is a map-side aggregate, and the join that spreads it can be dealt anew by
    adaptive execution. Each round is a staged table. Null ends and loops are left out;
    an empty graph gives no rows.
    """
    edges = edges.where("a <> b")
    edges, before = _staged_edges(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    )
    while True:
        # large star: both directions, link larger neighbours to the smallest known node
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m"))
        low = low.select("a", F.least("a", "m").alias("m"))
        large = (
            both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        )
        # small star: smaller neighbours go to the smallest of them
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges, mark = _staged_edges(
            small.union(low.select("a", F.col("m").alias("b"))).where("a <> b"), before[0] or 0
        )
        if mark == before:
            break
        before = mark
    # a star for each component: its smallest node is no first end
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
