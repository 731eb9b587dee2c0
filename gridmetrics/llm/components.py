"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmetrics.llm.storage import checkpointed


def components(edges: DataFrame) -> DataFrame:
    """``id`` and ``component`` (its smallest id) for the end points of ``edges`` (long ``a`` and ``b``).

    In each round every node takes its smallest neighbour, or itself, as parent, parents are followed
    to their roots by doubling steps, and the graph is contracted to the roots. That at least halves the
    nodes with edges, so the rounds are few; a star and a chain take one. Nothing but the answer whether
    something is left comes to the driver, and each round is written to the checkpoint folder. Loops, repeated edges and edges with a null end are of no effect.
    """
    edges = checkpointed(edges.select("a", "b").where(F.col("a") != F.col("b")).distinct())
    steps = []
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parents = both.groupBy("a").agg(F.min("b").alias("b"))
        parents = parents.select(F.col("a").alias("id"), F.least("a", "b").alias("parent"))
        parents = _to_roots(parents)
        steps.append(parents)
        start = parents.select(F.col("id").alias("a"), F.col("parent").alias("pa"))
        end = parents.select(F.col("id").alias("b"), F.col("parent").alias("pb"))
        edges = edges.join(start, "a").join(end, "b")
        edges = edges.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).where("a <> b").distinct()
        edges = checkpointed(edges)
    if not steps:
        return edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
    result = steps[0].withColumnRenamed("parent", "component")
    for step in steps[1:]:
        step = step.withColumnRenamed("id", "component")
        result = result.join(step, "component", "left").select("id", F.coalesce("parent", "component").alias("component"))
    return result


def _to_roots(parents: DataFrame) -> DataFrame:
    """``id`` and the root above it as ``parent``; a tree of depth d takes log d steps."""
    parents = checkpointed(parents)
    while True:
        above = parents.select(F.col("id").alias("parent"), F.col("parent").alias("above"))
        next_up = checkpointed(parents.join(above, "parent"))
        if next_up.where("above <> parent").isEmpty():
            return parents
        parents = next_up.select("id", F.col("above").alias("parent"))
