"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinis.session import materialize, stack


def components(links: DataFrame) -> DataFrame:
    """``(node, root)``: the smallest node each node of ``links(a, b)`` is connected with.

    Rounds of large-star and small-star (Kiveris et al., 2014): every node hangs
    its larger, then its smaller neighbours under the smallest one it knows. The
    number of rounds grows with the logarithm of the longest path; each round is
    written, and the links never become more.
    """

    def smallest(pairs: DataFrame) -> DataFrame:
        least = pairs.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("w", "m").alias("m"))
        return pairs.join(least, F.col("u") == F.col("w"))

    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    edges, state = materialize(edges, "links"), None
    while True:
        total = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == total or not total[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = total
        both = stack(edges, edges.select("v", "u"))
        large = smallest(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        large = materialize(large.distinct(), "links")
        small = smallest(large).select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        edges = materialize(small.where("u <> v").distinct(), "links")
