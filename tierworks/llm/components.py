"""Connected components of a graph of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tierworks.plans.workspace import settle


#: A table of so many rows or fewer is worked on in one piece, which needs no shuffle.
ROWS_IN_A_PIECE = 200_000


def pieces(df: DataFrame, rows: int) -> DataFrame:
    """``df``, known to have about ``rows`` rows, in as many pieces as these are worth."""
    return df.coalesce(1 + rows // ROWS_IN_A_PIECE)


def components(links: DataFrame) -> DataFrame:
    """``node, root``: the smallest node that each node of ``links`` (``a, b``: longs) reaches.

    Each round hangs every node's larger neighbours, then its smaller ones, on the smallest; the number of rounds
    grows with the logarithm of the longest path. A node with very many links is a hot key of joins only, which
    adaptive execution splits; minima are combined before they are shuffled. No links: no rows. Links of a node
    to itself and NULLs say nothing and are left out.
    """
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = settle(edges.filter(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b"))).distinct())
    before = None
    while True:
        seen = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        edges = pieces(edges, seen[0])
        if seen == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
                edges.select("b", "b").distinct()
            )
        before = seen
        edges = settle(_small_star(pieces(_large_star(edges, seen[0]), seen[0]), seen[0]))


def _large_star(edges: DataFrame, rows: int) -> DataFrame:
    both = pieces(edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(edges.select("b", "a")), rows)
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame, rows: int) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    hung = edges.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return pieces(hung.unionAll(least.select("a", F.col("m").alias("b"))), rows).distinct()
