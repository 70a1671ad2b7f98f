"""Connected components of a table of links, in Spark rounds.

Every round lets each node point its larger neighbours, and then its smaller ones, at the smallest
node it knows, until only stars are left. A round is two groupings and two joins of narrow rows, whose
hot keys are aggregated before the shuffle or split by adaptive execution; what a round ends with is
written to the shared folder, so a lost executor costs a re-read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import release, stage


def _pointed(links: DataFrame, larger: bool) -> DataFrame:
    """One half of a round: neighbours on one side of each node get a link to its smallest neighbour."""
    both = links.union(links.select("b", "a")) if larger else links
    # In stored links a > b, so without the mirror each node sees its smaller neighbours only.
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    side = both.where("b > a") if larger else both
    moved = side.join(least, "a").select(F.col("b").alias("x"), F.col("least").alias("y"))
    if not larger:
        moved = moved.union(least.select("a", "least"))
    return moved.where("x <> y").select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node`` and ``component``, its smallest node, for every node of a link between two different nodes."""
    now = links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a <> b").distinct()
    now = stage(now, "links")
    state = None
    while True:
        before, now = now, stage(_pointed(_pointed(now, larger=True), larger=False), "links")
        release(before)
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(seen) == state:
            break
        state = tuple(seen)
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.union(stars.select(F.col("component").alias("node"), "component").distinct())
