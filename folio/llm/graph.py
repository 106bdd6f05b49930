"""Connected components of a distributed edge list, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm.common import discard, staged


def components(edges: DataFrame) -> DataFrame:
    """edges(a long, b long) to (id, component): the smallest id reachable, for each id that has an edge.

    Every step is a sum by node (combined before the shuffle) and a join, whose edges never outnumber those given; its result is written to
    the shared folder, until nothing changes any more. A node with very many edges costs no more than its edges. Loops and repeated edges are allowed; no edges give no rows.
    """
    now = staged(edges.select(F.col("a").cast("long"), F.col("b").cast("long")).filter("a <> b").distinct(), "edges")
    last = None
    while True:
        both = now.select("a", "b").union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(low, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*")
        before, now = now, staged(small.filter("a <> b").distinct(), "stars")
        discard(before)
        # the same edges twice: every component is a star around its smallest id
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == last:
            break
        last = mark
    star = now.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return star.union(star.select(F.col("component").alias("id"), "component").distinct())
