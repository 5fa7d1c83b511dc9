"""Connected components of a link table, by alternating large and small stars.

Every round is a few joins and map-side combined minima over the links; rounds end
when the links no longer change, which takes a number of rounds that grows with the
logarithm of the longest chain.  Nothing is collected: the driver sees one count and
one checksum a round.  Links are checkpointed every round, so lineage stays short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmart.llm.common import checkpoint


def _star(links: DataFrame, both_ways: bool) -> DataFrame:
    """Tie the neighbours of each node to the least of them (and of the node itself)."""
    near = links
    if both_ways:
        near = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = near.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    tied = near.join(least, "u")
    if both_ways:
        return tied.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
        least.select("u", F.col("m").alias("v")))


def components(links: DataFrame) -> DataFrame:
    """(node, component): the least node that links (columns u, v) lead to, for every linked node."""
    now = checkpoint(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = None
    while True:
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == before or not seen[0]:
            break
        before = seen
        large = _star(now, True).distinct()
        now = checkpoint(_star(large, False).distinct())
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
