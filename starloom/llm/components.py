"""Connected components of a graph held in tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.session import materialise

ROWS = 1 << 20  # rows of a written file, about


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of the edges ``a, b``; the component is its
    smallest node.

    Alternating stars: every node hangs its larger neighbours, then its smaller ones and
    itself, onto the smallest it knows. Each round is two sums and joins by node, written
    to the shared folder; the number of rounds grows with the logarithm of the longest
    chain. Nodes with many neighbours only ever meet one row each. Links are counted, and
    tables are written by as many tasks as their rows call for: small rounds would else spend
    their time on files of a few rows.
    """
    links = materialise(edges.where("a <> b").select("a", "b").distinct(), "links")
    mark, count = None, links.count()

    def written(df: DataFrame, name: str) -> DataFrame:
        # A round's tables have no more rows than both directions of its links.
        return materialise(df.coalesce(1 + 2 * count // ROWS), name)

    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = written(
            both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least")), "least"
        )
        large = written(
            both.where("b > a").join(least, "a").where("b <> least")
            .select(F.col("b").alias("a"), F.col("least").alias("b")),
            "large",
        )  # every row: a > b
        least = written(large.groupBy("a").agg(F.min("b").alias("least")), "least")
        joined = large.join(least, "a")
        links = written(
            joined.where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
            .unionByName(least.select("a", F.col("least").alias("b")))
            .distinct(),
            "links",
        )
        state = links.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if state == mark:
            break
        mark, count = state, state[0]
    # Now every node but the smallest of a component has one edge, to that smallest.
    members = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return members.unionByName(roots)
