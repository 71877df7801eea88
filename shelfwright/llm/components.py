"""Connected components of a links table, wholly on executors."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfwright.session import stored


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over edges (a, b): each node hands its least neighbour to the larger (or to the smaller) ones.

    Only the minima are aggregated (with partial sums before the shuffle); a hub's edges meet their minimum in a join
    that adaptive execution can split, never in one group.
    """
    if large:
        edges = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = edges.groupBy(F.col("a").alias("k")).agg(F.min("b").alias("m")).withColumn("m", F.least("m", "k"))
    met = edges.join(least, edges["a"] == least["k"])
    if large:
        out = met.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = met.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(met.select(F.col("a"), F.col("m").alias("b")))
    return out.where("a <> b")


def _stars_only(edges: DataFrame) -> bool:
    """Whether no node hangs on another one that hangs on a third, nor on two."""
    twice = edges.groupBy("a").agg(F.count("*").alias("n")).where("n > 1")
    chained = edges.select("a").join(edges.select("b").distinct(), F.col("a") == F.col("b"), "left_semi")
    return not twice.select("a").unionByName(chained).limit(1).count()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) for every id in links, component the least id reachable. Null ends are ignored.

    Alternates steps that hang larger neighbours, then smaller ones, on the least neighbour until the edges are stars;
    a logarithmic number of rounds, each a table in the shared folder.
    """
    edges = stored(links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a <> b").distinct(), "cc")
    while not _stars_only(edges):
        edges = stored(_stars(_stars(edges, True), False).distinct(), "cc")
    roots = edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(roots)
