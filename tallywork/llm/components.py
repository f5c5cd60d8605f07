"""Connected components of an edge table, every step written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywork.llm.shared import written


def roots(parents: DataFrame) -> DataFrame:
    """Root of every ``id`` of a forest given as one ``(id, parent)`` row each, without cycles; roots have no row.

    Pointer jumping: each round halves the depth, so its number is logarithmic.
    """
    held = written(parents.select("id", "parent"), "forest")
    while True:
        above = held.select(F.col("id").alias("parent"), F.col("parent").alias("grand"))
        held = written(held.join(above, "parent", "left").select("id", F.coalesce("grand", "parent").alias("parent"), F.col("grand").isNotNull().alias("moved")), "forest")
        if held.where("moved").isEmpty():
            return held.select("id", F.col("parent").alias("root"))
        held = held.select("id", "parent")


def components(edges: DataFrame) -> DataFrame:
    """``(id, root)`` of every id that has an edge ``(a, b)`` and is not itself the smallest id of its component.

    Each round hangs every id under its smallest neighbour, finds the roots of that forest and contracts the edges; a
    component of ``n`` ids takes at most ``log2 n`` rounds, and only edges between different roots go on.
    """
    held = written(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), "edges")
    found: DataFrame | None = None
    while not held.isEmpty():
        both = held.unionByName(held.select(F.col("b").alias("a"), F.col("a").alias("b")))
        forest = both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("parent")).where("parent < id")
        top = roots(forest)
        named = lambda old, new: top.select(F.col("id").alias(old), F.col("root").alias(new))
        if found is None:
            found = top
        else:
            moved = found.join(named("root", "up"), "root", "left").select("id", F.coalesce("up", "root").alias("root"))
            found = written(moved.unionByName(top), "components")
        held = held.join(named("a", "ra"), "a", "left").join(named("b", "rb"), "b", "left")
        held = held.select(F.coalesce("ra", "a").alias("x"), F.coalesce("rb", "b").alias("y"))
        held = written(held.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
    return edges.sparkSession.createDataFrame([], "id long, root long") if found is None else found
