"""Connected components of links between ids, by alternating large and small
stars: every node links to the smallest neighbour it sees until only stars of
the smallest id remain.  Hot nodes are met by joins that Spark splits, never
gathered; each round is written to the shared folder.

A cheap choice of pairs links most members of a large group.  ``apart`` deals
what it left, so that every other pair of a group can be looked at."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopstream.llm.common import materialized


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours link to the smallest node it sees."""
    near = _both_ways(edges)
    least = near.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return (near.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .where("a <> b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours link to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    kept = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
        least.select("a", F.col("m").alias("b")))
    return kept.where("a <> b").distinct()


def _print(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b") % 1000003).alias("h")).first()
    return r.n, r.h


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) of every node that has a
    link in ``edges`` (a, b) to another one.  Links of a node to itself and
    links with a null are ignored; no links give no rows."""
    edges = materialized(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                         .distinct(), "links")
    before = _print(edges)
    while before[0]:
        edges = materialized(_small_star(_large_star(edges)), "stars")
        now = _print(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def apart(groups: DataFrame, classes: DataFrame, weight: Column, most: int) -> DataFrame:
    """Rows of ``groups`` (key long, node, ...) whose group has nodes of
    several components in ``classes``, with component, tile, low and high: any
    two of a group that are in different components meet at one (key, low,
    high), and its tiles ``low`` and ``high`` weigh about ``most`` at most.  The
    group's main component has tiles of its own, never dealt to each other."""
    named = (groups.withColumn("weight", weight).join(classes, "node", "left")
             .withColumn("component", F.coalesce("component", "node")))
    each = named.groupBy("key", "component").agg(F.sum("weight").alias("w"))
    sums = (each.groupBy("key").agg(F.count("*").alias("n"), F.sum("w").alias("w"), F.max(F.struct("w", "component")).alias("main"))
            .where("n > 1"))
    hidden = F.bitwise_not(F.bitwise_not("key")).alias("key")       # see near_dup: a hot group's join is split
    tiles = sums.select(hidden, F.col("main.component").alias("main"), F.ceil(F.col("main.w") / most).alias("own"),
                        F.ceil((F.col("w") - F.col("main.w")) / most).alias("others"))
    at = F.xxhash64("node")
    tiled = named.join(tiles, "key").withColumn("tile", F.when(F.col("component") == F.col("main"), F.pmod(at, F.col("own")))
                                                .otherwise(F.col("own") + F.pmod(at, F.col("others"))))
    meets = F.sequence(F.when(F.col("component") == F.col("main"), F.col("own")).otherwise(F.lit(0)),
                       F.col("own") + F.col("others") - 1)
    return (tiled.withColumn("with", F.explode(meets)).withColumn("low", F.least("tile", "with"))
            .withColumn("high", F.greatest("tile", "with")).drop("weight", "main", "own", "others", "with"))


def spanning(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of the links ``a[i]``, ``b[i]`` rows (a, b) that join the same ids, none
    of them twice."""
    links = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
    root: dict[int, int] = {}
    kept = []
    for x, y in links.tolist():
        u, v = x, y
        while u in root:
            u = root[u]
        while v in root:
            v = root[v]
        for z, r in ((x, u), (y, v)):       # shorter ways for the next ones
            while z in root and root[z] != r:
                root[z], z = r, root[z]
        if u != v:
            root[max(u, v)] = min(u, v)
            kept.append((x, y))
    return np.array(kept, np.int64).reshape(-1, 2)
