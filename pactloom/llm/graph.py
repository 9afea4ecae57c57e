"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pactloom.llm.common import stored, tidy


def _digest(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["s"]


@tidy
def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(id, root)`` for every id that an edge names; ``root`` is the smallest id it is connected with.

    Each round hangs all larger neighbours of an id on its smallest neighbour, then all smaller ones, until nothing
    changes (about the logarithm of the longest path). The minimum is combined before the shuffle; it is written down
    before it is joined, so that the join reads two plain shuffles and adaptive execution can split the many
    neighbours of one id. Edges with a null end and loops name no connection and are left out.
    """
    plain = edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    current, before = stored(plain, "edges"), None
    after = _digest(current)
    while after != before and after[0]:
        before = after
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stored(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.where("u != v").distinct(), "large")
        least = stored(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        current = stored(small.union(least.select("u", F.col("m").alias("v"))).where("u != v").distinct(), "edges")
        after = _digest(current)
    members = current.select(F.col("u").alias("id"), F.col("v").alias("root"))
    return members.union(current.select(F.col("v").alias("id"), F.col("v").alias("root")).distinct())


def joined(classes: DataFrame, more: DataFrame) -> DataFrame:
    """``classes (id, root)`` after ``more (id, root)`` has joined some of their roots with each other or with new ids."""
    moves = more.select(F.col("id").alias("root"), F.col("root").alias("new"))
    moved = classes.join(moves, "root", "left").select("id", F.coalesce("new", "root").alias("root"))
    return moved.union(more.join(classes.select("id"), "id", "left_anti").select("id", "root"))
