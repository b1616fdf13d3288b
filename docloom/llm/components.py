"""Connected components of links that stay distributed."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


def stars(u: np.ndarray, v: np.ndarray, n: int) -> np.ndarray:
    """The least node that each of n nodes reaches over the links."""
    root = np.arange(n)
    while True:
        least = np.minimum(root[u], root[v])
        new = root.copy()
        np.minimum.at(new, root[u], least)
        np.minimum.at(new, root[v], least)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) of every node of the links (u, v), both long and non-null: root is the smallest node reachable.

    Large-star and small-star steps turn by turn: each node's neighbours are tied to the least of them, until nothing changes.
    A step takes only a minimum per node, combined before the shuffle, and a join that Spark may split at a hub; the number of
    links never grows. Each step's links are written, so a lost executor costs one step at most."""
    e = common.written(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct())
    before = None
    for _ in range(most_rounds):
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        # large star: larger neighbours go to the least one
        e = e.select(F.col("u").alias("far"), F.col("v").alias("u")).join(least, "u").select(F.col("far").alias("u"), F.col("m").alias("v"))
        e = e.filter("u <> v").distinct()
        # small star: smaller neighbours, and the node, go to the least of them
        least = e.groupBy("u").agg(F.min("v").alias("m"))
        e = e.join(least, "u").select(F.explode(F.array(F.struct(F.col("u").alias("a"), F.col("m").alias("b")), F.struct(F.col("v").alias("a"), F.col("m").alias("b")))).alias("x")).select(F.col("x.a").alias("u"), F.col("x.b").alias("v"))
        e = common.written(e.filter("u <> v").distinct())
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before or now[0] == 0:
            break
        before = now
    else:
        raise RuntimeError(f"components didn't settle in {most_rounds} rounds")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(e.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
