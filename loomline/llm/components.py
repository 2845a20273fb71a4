"""Connected components of an edge table, by alternating large and small stars.

Each round links every node's larger neighbours to the smallest one around it, then
every node and its smaller neighbours to the smallest of them.  Both only compare a
node with a minimum, so no neighbourhood is gathered in one place.  A round is one
job, written to the shared folder; the driver sees a count and a checksum only, taken
while the round is written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomline.llm import shared


def _round(stars: DataFrame) -> DataFrame:
    pair = lambda a, b: F.struct(F.col(a).alias("a"), F.col(b).alias("b"))
    both = stars.select(F.explode(F.array(pair("a", "b"), pair("b", "a"))).alias("e")).select("e.*")
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("b"), F.least("a", "m").alias("m"))
    large = stars.join(least, "b").select("a", F.col("m").alias("b"))
    lowest = large.groupBy("a").agg(F.min("b").alias("m"))
    moved = F.when(F.col("b") != F.col("m"), pair("b", "m"))
    small = large.join(lowest, "a").select(F.explode(F.array_compact(F.array(pair("a", "m"), moved))).alias("e"))
    return small.select("e.*").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of the edges ``a``, ``b``; the label is the smallest node reachable.

    Loops and repeated edges don't matter; edges with a null end are left out.  No edges give no rows.
    """
    state = (F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("checksum"))
    edges = edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    stars, before = shared.observed_cut(edges.distinct(), "edges", *state)
    while before["n"]:
        last = stars
        stars, now = shared.observed_cut(_round(last), "stars", *state)
        shared.discard(last)
        if now == before:
            break
        before = now
    return stars.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.col("b").alias("label")), F.struct(F.col("b").alias("node"), F.col("b").alias("label")))).alias("x")).select("x.*").distinct()
