"""Connected components of an edge table, in alternating star rounds."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laurel.llm.common import stage


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours are tied to the smallest it knows."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("least"))
    least = least.select("a", F.least("a", "least").alias("least"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are tied to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    tied = down.join(least, "a").where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return tied.union(least.select("a", F.col("least").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (``a, b``) but the roots themselves.

    root is the smallest node that can be reached.  Loops and null ends are ignored, edges
    may repeat.  Rounds grow with the logarithm of the longest path; each is a written table.
    """
    now = stage(edges.where("a <> b").select("a", "b").distinct(), "edges")
    seen = None
    while True:
        now = stage(_small_star(_large_star(now)), "stars")
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = mark


def grouped(edges: DataFrame, rounds: int = 2) -> DataFrame:
    """``node, root`` after a few rounds: equal roots are one component, but not the reverse.

    Enough where groups only save work.
    """
    now = edges.where("a <> b").select("a", "b").distinct()
    for _ in range(rounds):
        now = stage(_small_star(_large_star(now)), "stars")
    return now.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
