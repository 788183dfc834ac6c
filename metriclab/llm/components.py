"""Connected components of a table of links, by alternating large and small stars.

Each round joins every node with the smallest of its neighbours; nothing is
collected but two numbers that tell whether a round changed anything.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import dropped, written


def _state(links: DataFrame) -> tuple[int, int]:
    row = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], int(row["s"] or 0)


def _large(links: DataFrame) -> DataFrame:
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return both.join(least, "a").filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small(links: DataFrame) -> DataFrame:
    # every link already points from the larger to the smaller node
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").filter(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component): each node that has a link, with the smallest node it can reach.

    ``links`` has columns a and b of one type.  Loops, repeated links and both
    directions are allowed; a link with a null end is none.  No links give no rows.
    """
    links = links.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links = written(links, "links")
    state = _state(links)
    while state[0]:
        after = written(_small(_large(links)), "links")
        dropped(links.sparkSession, links)
        links, before, state = after, state, _state(after)
        if state == before:
            break
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
