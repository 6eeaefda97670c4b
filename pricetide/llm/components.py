"""Connected components of an edge table, in alternating star steps; nothing is gathered outside Spark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pricetide.session import stage


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b") % 1_000_000_007).alias("h")).first()
    return row["n"], row["h"]


def _star(edges: DataFrame, least: DataFrame, keep: Column | None = None) -> DataFrame:
    """Point each edge's far end, and the node itself, to the least neighbour of the node."""
    joined = edges.join(least, "a")
    far = joined.where(keep) if keep is not None else joined
    ends = far.select(F.col("b").alias("a"), F.col("least").alias("b"))
    own = least.select("a", F.col("least").alias("b"))
    return ends.union(own).where(F.col("a") != F.col("b")).dropDuplicates(["a", "b"])


def components(edges: DataFrame, label: str = "edges") -> DataFrame:
    """``node`` and ``component`` (the smallest node it is joined to) for every node of ``edges`` (``a``, ``b``).

    Loops and repeated edges do no harm. A step halves the distance to the smallest node at least, so the number of
    rounds grows with the logarithm of the longest chain. Every round is staged, which also cuts its lineage.
    """
    cast = edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"))
    pairs = cast.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = stage(pairs.dropDuplicates(["a", "b"]), label)
    mark = _mark(now)
    while mark[0]:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("least"))
        large = stage(_star(both, least, F.col("b") > F.col("a")), label)
        least = large.groupBy("a").agg(F.min("b").alias("least"))
        now = stage(_star(large, least), label)
        before, mark = mark, _mark(now)
        if before == mark:
            break
    roots = now.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
