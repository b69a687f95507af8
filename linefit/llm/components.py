"""Connected components of a graph given as edges, without ever gathering them.

Alternating large-star and small-star steps (Kiveris et al., 2014) turn each component into a
star around its smallest node. A node's smallest neighbour comes from an aggregate that tasks
begin locally, so hubs do not hurt there; the join that hands it back is dealt over salts.
Each round is written to the shared folder, which also cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linefit.llm.common import discard, salted_lookup, staged


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step on edges (a > b). Large: larger neighbours move to a node's smallest one.

    Small: the smaller neighbours of a node, and the node, move to the smallest of them.
    """
    if large:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        moved = salted_lookup(both.where("b > a"), "a", least, F.col("b"))
        out = moved.select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        least = edges.groupBy("a").agg(F.min("b").alias("m"))
        moved = salted_lookup(edges, "a", least, F.col("b"))
        out = moved.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))
        )
    return out.where("a <> b").distinct()


def components(edges: DataFrame) -> tuple[DataFrame, str]:
    """Staged (node, component) for every node that has an edge, and the table's path.

    ``edges`` has two long columns ``a`` and ``b`` in any order; loops and repeats are fine.
    Component is the smallest node reachable. The smallest node itself is not listed.
    """
    spark = edges.sparkSession
    current, path = staged(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(), "edges",
    )
    before = None
    while True:
        stepped, next_path = staged(_star(_star(current, True), False), "edges")
        discard(spark, path)
        current, path = stepped, next_path
        # a star forest has one edge for each node that is no centre, and no centre has an edge
        state = current.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if state == before:
            return current.select(F.col("a").alias("node"), F.col("b").alias("component")), path
        before = state
