"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.storage import Stored, store


def _large_star(links: DataFrame) -> DataFrame:
    """Each node's larger neighbours are tied to the smallest node around it."""
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are tied to the smallest of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    moved = down.join(least, "a").filter("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionByName(least.select("a", F.col("least").alias("b"))).distinct()


def components(links: DataFrame, most_rounds: int = 60) -> Stored:
    """(a, b): each linked node except the smallest of its component, with that smallest node.

    Large stars and small stars in turn (Kiveris et al. 2014) until nothing changes; a round's links
    are written, so no round is worked out twice.
    """
    before = None
    current = store(_small_star(links), "links")
    for _ in range(most_rounds):
        following = store(_small_star(_large_star(current.rows)), "links")
        print_of = following.rows.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        current.drop()
        current = following
        if print_of == before:
            return current
        before = print_of
    raise RuntimeError(f"no end after {most_rounds} rounds")
