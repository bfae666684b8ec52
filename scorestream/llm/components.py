"""Connected components of a link table, on Spark.

Links are rewired to ever smaller ids (large star, small star; Kiveris et al.,
"Connected components in MapReduce and beyond", 2014) until every link points
at the smallest id of its component.  Each round is written to the shared
folder, so that a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorestream.workspace import materialize


def _downward(links: DataFrame) -> DataFrame:
    """Each link once, from the larger to the smaller id."""
    return (
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where(F.col("a") != F.col("b"))
        .distinct()
    )


def _rewired(links: DataFrame, keep: str) -> DataFrame:
    """Neighbours of every id, linked to the smallest of that id and its neighbours."""
    lowest = links.groupBy("a").agg(F.min("b").alias("low"))
    lowest = lowest.select(F.col("a").alias("centre"), F.least("a", "low").alias("low"))
    moved = links.join(lowest, F.col("a") == F.col("centre")).where(keep)
    return moved.select(F.col("b").alias("a"), F.col("low").alias("b"))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return _downward(_rewired(both, "b > a"))


def _small_star(links: DataFrame) -> DataFrame:
    own = links.groupBy("a").agg(F.min("b").alias("b"))
    return _downward(_rewired(links, "b != low").union(own))


def _digest(links: DataFrame) -> tuple:
    row = links.agg(
        F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    ).first()
    return tuple(row)


def smallest_reachable(links: DataFrame, name: str = "links") -> DataFrame:
    """(node, component) of every id that has a link; links have columns a and b.

    Null ends and self links are ignored.  An empty table gives an empty result.
    """
    links = materialize(_downward(links.dropna(subset=["a", "b"])), name)
    seen = _digest(links)
    while seen[0]:
        links = materialize(_small_star(_large_star(links)), name)
        now = _digest(links)
        if now == seen:
            break
        seen = now
    roots = links.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("component"))
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
