"""Connected components of a link table by alternating large and small stars.

All rounds are joins and minimum aggregates over links; a hub's neighbours never
meet in one group. Each round writes its links to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._store import discard, written


def _star(links: DataFrame, both_ways: bool) -> DataFrame:
    """Link the neighbours of every u to the least node among them and u (large star: only those above u)."""
    out = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))) if both_ways else links
    least = out.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
    near = out.join(least, out["a"] == least["u"])
    if both_ways:
        return near.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    moved = near.select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).filter("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in links (a, b); component is the least node reachable.

    Nodes may be of any ordered type; self links and repeats are allowed, null nodes are not.
    """
    now = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    state = lambda df: df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    mark = state(now)
    before = None
    while True:
        now = written(_star(_star(now, True), False), "stars", mark[0])
        if before is not None:
            discard(before)
        before, new = now, state(now)
        if new == mark:
            break
        mark = new
    roots = now.select(F.col("b").alias("node")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        roots.withColumn("component", F.col("node"))
    )
