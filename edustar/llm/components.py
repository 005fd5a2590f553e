"""Connected components of a link table by alternating large-star and small-star rounds.

Every round is two aggregations with map-side minimum and two joins back on the node; each round's
links are a written table. Nothing is collected but one (count, checksum) row a round. A hot node's
rows are split by the adaptive skew join, since both join sides are plain shuffles of written tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edustar.llm.store import stored

MAX_ROUNDS = 60


def _star(links: DataFrame, large: bool) -> DataFrame:
    """links (a > b). Large star: every neighbour above a node points to the smallest of the node and its
    neighbours. Small star: every smaller neighbour and the node itself point to the smallest one."""
    if large:
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(
            F.col("a").alias("u"), F.least("a", "m").alias("m"))
        # neighbours above u: the links stored as (a = neighbour, b = u)
        return links.join(least, links.b == least.u).select("a", F.col("m").alias("b"))
    least = links.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), "m")
    near = links.join(least, links.a == least.u).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return near.union(least.select(F.col("u").alias("a"), F.col("m").alias("b")))


def components(links: DataFrame) -> DataFrame:
    """links (a long, b long), any order, repeats and loops allowed -> (node, component), one row for each
    node that has a link to another, component = its smallest reachable node."""
    links = links.where("a is not null and b is not null and a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links = stored(links, "links")
    before = None
    for _ in range(MAX_ROUNDS):
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
        links = stored(_star(links, True).where("a <> b").distinct(), "large")
        links = stored(_star(links, False).where("a <> b").distinct(), "small")
    else:
        raise RuntimeError("components did not settle")
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
