"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkloom.llm.tables import written


def _large_star(links: DataFrame) -> DataFrame:
    """Hang every neighbor above a node on the least of its neighborhood."""
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Hang a node and its neighbors below it on the least of them."""
    least = links.groupBy("a").agg(F.min("b").alias("low"))
    moved = links.join(least, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.union(least).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for each node of links (a, b), its root the least node it reaches; roots are left out.

    Each round is joins and partial aggregates on the link table, written to
    the shared folder; a hub is never gathered, and a skewed join partition is
    split by adaptive execution.  Rounds grow with the logarithm of the
    longest path.  Self links are dropped, an empty table gives no rows.
    """
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    links = written(links, "links")
    state = None
    while True:
        links = written(_small_star(_large_star(links)), "stars")
        now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = now
