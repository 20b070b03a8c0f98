"""Connected components of links between nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from starload.session import written


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every linked node: the least node of its component.

    Large-star and small-star steps in turn, until one changes nothing. The least neighbours are written
    before they are joined, so both sides of the join are plain shuffles, which Spark splits where one node
    has very many neighbours. A lost executor costs the step at hand.
    """
    pair = lambda a, b: (F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
    now = written(links.where("a <> b").select(*pair("a", "b")).distinct(), "links")
    before = _digest(now)
    while before["n"]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = written(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least")
        large = both.where("b > a").join(least, "a").select(*pair("b", "m")).where("a <> b").distinct()
        large = written(large, "large-star")
        least = written(large.groupBy("b").agg(F.min("a").alias("m")), "least")
        small = large.join(least, "b")
        small = small.select(*pair("a", "m")).unionByName(small.select(*pair("b", "m")))
        after = written(small.where("a <> b").distinct(), "small-star")
        now, last, before = after, before, _digest(after)
        if before == last:
            break
    return now.select(F.col("b").alias("node"), F.col("a").alias("root"))


def _digest(links: DataFrame) -> Row:
    """Tells two sets of links apart."""
    return links.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum")).first()
