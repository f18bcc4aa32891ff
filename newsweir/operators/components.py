"""Connected components of a large graph, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import cut, discard


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link every neighbour to the least vertex of a neighbourhood: of all greater neighbours (large), or of the others."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    x = both.join(least, "a")
    if large:
        x = x.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        x = x.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return x.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """id, component (the least id that is reachable) of every vertex of `edges` (a, b: two ids, not null).

    Large-star and small-star steps alternate until nothing changes; the rounds grow with the logarithm of the longest
    path. Joins have one row per vertex on one side, so a vertex with very many neighbours can be split over tasks."""
    now = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = None
    while True:
        sums = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if sums == state or not sums[0]:
            break
        state = sums
        after = cut(_star(_star(now, True), False), "edges")
        discard(now)
        now = after
    tops = now.select(F.col("b").alias("id")).distinct().select("id", F.col("id").alias("component"))
    return now.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(tops)


def grown(stars: DataFrame, edges: DataFrame) -> DataFrame:
    """id, component after new edges (a, b) are added to the components of earlier runs (stars: id, component).

    Each edge is one of components: those that it joins become the least of them, which is the oldest where ids grow with time,
    and all their vertices move. Only the components that new edges touch are searched; the earlier edges aren't needed."""
    of = lambda c: stars.select(F.col("id").alias(c), F.col("component").alias(f"{c}_of"))
    x = edges.join(of("a"), "a", "left").join(of("b"), "b", "left")
    x = cut(x.select("a", "b", F.coalesce("a_of", "a").alias("ca"), F.coalesce("b_of", "b").alias("cb")), "new-edges")
    part = components(x.select(F.col("ca").alias("a"), F.col("cb").alias("b"))).select(F.col("id").alias("component"), F.col("component").alias("least"))
    ends = x.select(F.col("a").alias("id")).unionByName(x.select(F.col("b").alias("id"))).distinct()
    every = stars.select("id", "component").unionByName(ends.join(stars.select("id"), "id", "left_anti").select("id", F.col("id").alias("component")))
    return every.join(part, "component", "left").select("id", F.coalesce("least", "component").alias("component"))


def moved(before: DataFrame, after: DataFrame) -> DataFrame:
    """component, now: components of an earlier run that have become part of another."""
    x = before.select(F.col("component").alias("id")).distinct().join(after, "id")
    return x.where(F.col("id") != F.col("component")).select(F.col("id").alias("component"), F.col("component").alias("now"))
