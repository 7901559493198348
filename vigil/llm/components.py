"""Distributed union-find: connected components of an edge table.

Alternating large-star and small-star rounds (Kiveris et al., "Connected
Components in MapReduce and Beyond"): every round is two groupings with a
partial ``min`` before the shuffle and a join back, so a node of a million
links is never gathered in one task (the join on it is split by AQE).  Each
round is a table in the shared folder; nothing but a count and a checksum
reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import Scratch


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over (u, v) pairs with u > v: links the larger
    (``large``) or the smaller neighbours of each node, and the node itself,
    to the smallest."""
    if large:
        nb = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        nb = edges
    least = nb.groupBy(F.col("u").alias("_u")).agg(F.min("v").alias("_m"))
    least = least.select("_u", F.least("_u", "_m").alias("_m"))
    j = nb.join(least, nb["u"] == least["_u"])
    if large:
        out = j.where("v > u").select(F.col("v").alias("u"), F.col("_m").alias("v"))
    else:
        out = j.select(F.col("v").alias("u"), F.col("_m").alias("v")).unionAll(least.select(F.col("_u").alias("u"), F.col("_m").alias("v")))
    return out.where("u <> v").distinct()


def connected_components(edges: DataFrame, scratch: Scratch, max_rounds: int = 200) -> DataFrame:
    """(node, component) for every node that has a link; ``component`` is the
    smallest node reachable.

    ``edges``: two columns of one ordered type, any direction, repeats and
    self links allowed, rows with a null end ignored.  An empty table gives
    an empty table.
    """
    a, b = edges.columns
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(F.col(a).isNotNull() & F.col(b).isNotNull()).where("u <> v").distinct()
    e = scratch.save(e, "edges")
    stamp = _stamp(e)
    for _ in range(max_rounds):
        if stamp[0] == 0:
            break
        nxt = scratch.save(_star(_star(e, True), False), "edges")
        scratch.drop(e)
        e, last, stamp = nxt, stamp, _stamp(nxt)
        if last == stamp:
            break
    else:
        raise RuntimeError(f"components not stable after {max_rounds} rounds")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _stamp(e: DataFrame) -> tuple:
    r = e.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
    return r["n"], r["s"]
