"""Connected components by alternating large-star and small-star steps.

Every step is a grouped minimum and a join back; a hub's links are
combined on the map side and its join is one row against many, which the planner
can split.  Each round is written to the shared folder; rounds end when
no link changes, after about log(longest path) of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firn.llm.common import stored


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return (both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .where("a <> b").distinct())


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.explode(F.array(
        F.struct("b", "m"), F.struct(F.col("a").alias("b"), "m"))).alias("x"))
    return moved.select(F.col("x.b").alias("a"), F.col("x.m").alias("b")).where("a <> b").distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """``(id, component)`` for every id in ``links`` (columns a and b); the component is its least id.
    Null ends and self links are ignored."""
    links = stored(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                   .distinct(), "links")
    state = None
    while True:
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state or now[0] == 0:
            break
        state = now
        links = stored(_small_star(_large_star(links)), "links")
    roots = links.select(F.col("b").alias("id")).distinct()
    return links.select(F.col("a").alias("id"), F.col("b").alias("component")).union(
        roots.select("id", F.col("id").alias("component")))
