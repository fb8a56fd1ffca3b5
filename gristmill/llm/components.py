"""Connected components of a table of links, by alternating stars (Kiveris et al. 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.session import Scope


def components(links: DataFrame, scope: Scope) -> DataFrame:
    """``(id, component)`` of every id in ``links (i, j)``; the component is its smallest id.

    A round hangs every node below the smallest node it knows, first from its larger neighbours, then
    from its smaller ones; after a number of rounds that grows with the logarithm of the longest path
    the links are stars. Every step is a minimum per node, combined before the shuffle, and a join.
    The driver sees one count a round.
    """
    edges = stars(links, scope)
    found = edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
    roots = edges.select("v").distinct().select(F.col("v").alias("id"), F.col("v").alias("component"))
    return found.unionAll(roots)


def stars(links: DataFrame, scope: Scope) -> DataFrame:
    """``(u, v)``, staged: every id of ``links`` that is not its component's smallest, with the smallest."""
    edges = scope.stage(
        links.select(F.greatest("i", "j").alias("u"), F.least("i", "j").alias("v")).filter("u > v").distinct(), "links"
    )
    while True:
        edges = scope.stage(_small_star(_large_star(edges)), "links")
        if not _unsettled(edges):
            return edges


def _unsettled(edges: DataFrame) -> int:
    """How many nodes hang below two others, or below one and above another."""
    hung = edges.select(F.col("u").alias("id"), F.lit(1).alias("below"), F.lit(0).alias("above"))
    ends = hung.unionAll(edges.select(F.col("v").alias("id"), F.lit(0).alias("below"), F.lit(1).alias("above")))
    of = ends.groupBy("id").agg(F.sum("below").alias("below"), F.max("above").alias("above"))
    return of.filter("below > 1 OR below > 0 AND above > 0").count()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    hung = edges.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.unionAll(least.select("u", F.col("m").alias("v"))).distinct()
