"""Connected components of a link table, by alternating star contractions.

``components(links, "a", "b")`` returns one row ``(node, component)`` for every
node that occurs in a link; ``component`` is the smallest node reachable.  Each
round is two joins over the links that are left; rounds grow with the
logarithm of the longest chain.  Every round's links are written to the shared
folder, so a lost executor costs one round at most, and nothing but two
aggregated numbers reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripforge.llm.common import staged


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """One contraction.  Large star: a node's greater neighbours are tied to its
    smallest neighbour (itself included).  Small star: so are its smaller ones."""
    if small:
        pairs = edges.select(F.greatest("u", "v").alias("n"), F.least("u", "v").alias("o"))
    else:
        pairs = (edges.select(F.col("u").alias("n"), F.col("v").alias("o"))
                 .unionByName(edges.select(F.col("v").alias("n"), F.col("u").alias("o"))))
    least = pairs.groupBy("n").agg(F.min("o").alias("m")).select("n", F.least("n", "m").alias("m"))
    tied = pairs.join(least, "n")
    if small:
        out = (tied.select(F.col("o").alias("u"), F.col("m").alias("v"))
               .unionByName(least.select(F.col("n").alias("u"), F.col("m").alias("v"))))
    else:
        out = tied.filter(F.col("o") > F.col("n")).select(F.col("o").alias("u"), F.col("m").alias("v"))
    return out.filter("u <> v").distinct()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """Component of every linked node; null ends and loops count for nothing."""
    edges = staged(links.select(F.col(a).alias("u"), F.col(b).alias("v"))
                   .filter("u <> v").distinct(), "edges")
    mark = None
    while True:
        edges = staged(_star(_star(edges, small=False), small=True), "edges")
        # stars are done when no centre is a leaf: the table then repeats itself
        now = edges.agg(F.count(F.lit(1)).alias("n"),
                        F.bit_xor(F.xxhash64("u", "v")).alias("x"),
                        F.sum(F.xxhash64("v", "u").cast("decimal(38,0)")).alias("s")).first()
        if now == mark:
            break
        mark = now
    return edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
