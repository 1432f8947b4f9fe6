"""Connected components of a table of links, by joins and minima only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from vitalsieve.llm.common import written

#: Links (a few MB) up to which one task takes a round's stars, in sorted runs without shuffles or broadcasts; more links are dealt out.
FEW = 100_000


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star operation on edges (u, v): every neighbour of u is linked to the smallest of u and its neighbours.

    The large star moves the neighbours above u, the small star u and those below. Minima are combined before the shuffle and the
    hub's edges meet their minimum in a join, which Spark splits where a hub is hot; no neighbourhood is collected.
    """
    both = edges.union(edges.select(F.col("v"), F.col("u"))) if large else edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    joined = both.join(least, "u")
    if large:
        return joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v")
    moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    return moved.filter("u != v")


def _star_of_few(edges: DataFrame, large: bool) -> DataFrame:
    """As ``_star``, for edges that lie in one task: the minimum goes along each sorted run of u."""
    here, back = F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v"))
    both = edges.select(F.inline(F.array(here, back))) if large else edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    joined = both.withColumn("m", F.least("u", F.min("v").over(Window.partitionBy("u"))))
    if large:
        return joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v")
    moved, own = F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v"))
    return joined.select(F.inline(F.array(moved, own))).filter("u != v")


def components(links: DataFrame) -> DataFrame:
    """(id, root) for every id of ``links`` (a, b) but the roots themselves; a root is the smallest id of its component.

    Large and small stars alternate until nothing changes, in a number of rounds that grows with the logarithm of the longest path. Each
    round is a written table. Rounds over at most FEW links are one task each, as every task, broadcast and plan costs the driver memory.
    """
    edges = written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct(), "edges")
    before = None
    while True:
        mark = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before or not mark[0]:
            return edges.select(F.col("u").alias("id"), F.col("v").alias("root"))
        before = mark
        star, dealt = (_star_of_few, edges.coalesce(1)) if mark[0] <= FEW else (_star, edges)
        edges = written(star(star(dealt, True).distinct(), False).distinct(), "edges")
