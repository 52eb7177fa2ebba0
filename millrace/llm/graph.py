"""Connected components by contraction, on narrow tables only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def connected_components(edges: DataFrame, scratch: Scratch, label: str) -> DataFrame:
    """``node``, ``component`` (the smallest node of its component) of every node of
    ``edges(u long, v long)``.

    Each round every node moves to the neighbour, or itself, that a hash puts first;
    edges inside a group vanish. The hash makes the number of nodes fall by a constant
    factor per round whatever the shape of the graph, so rounds grow with its logarithm.
    A node with many neighbours is reduced map-side and its edges are split by the
    join, so no task meets them all. Every round is stored.
    """
    names, rounds = [], 0
    edges = scratch.save(edges.filter("u <> v").distinct(), f"{label}-edges-0")
    moves = []
    while not edges.isEmpty():
        nearest = F.min(F.struct(F.xxhash64("v").alias("h"), "v"))
        near = _both_ways(edges).groupBy("u").agg(nearest.alias("n"))
        own = F.struct(F.xxhash64("u").alias("h"), F.col("u").alias("v"))
        move = near.select("u", F.least("n", own)["v"].alias("to"))
        moves.append(scratch.save(move, f"{label}-moves-{rounds}"))
        names += [f"{label}-edges-{rounds}", f"{label}-moves-{rounds}"]
        to = moves[-1]
        contracted = (
            edges.join(to, "u")
            .select(F.col("to").alias("a"), "v")
            .join(to.withColumnRenamed("u", "v"), "v")
            .select(F.least("a", "to").alias("u"), F.greatest("a", "to").alias("v"))
            .filter("u <> v")
            .distinct()
        )
        rounds += 1
        edges = scratch.save(contracted, f"{label}-edges-{rounds}")
    spark = edges.sparkSession
    if not moves:
        return spark.createDataFrame([], "node long, component long")
    found = moves[-1]
    for move in reversed(moves[:-1]):
        later = found.select(F.col("u").alias("via"), F.col("to").alias("root"))
        found = move.join(later, F.col("to") == F.col("via"), "left").select(
            "u", F.coalesce("root", "to").alias("to")
        )
    found = scratch.save(found, f"{label}-roots")
    least = found.groupBy("to").agg(F.min("u").alias("component"))
    result = scratch.save(
        found.join(least, "to").select(F.col("u").alias("node"), "component"), f"{label}-components"
    )
    scratch.drop(f"{label}-edges-{rounds}", f"{label}-roots", *names)
    return result
