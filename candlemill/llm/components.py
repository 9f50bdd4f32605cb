"""Connected components of a table of links, without gathering links anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlemill.llm.common import saved


def _starred(links: DataFrame, larger: bool) -> DataFrame:
    """Each node's neighbours tied to the smallest of them instead (large or small star)."""
    if larger:
        both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    tied = both.join(least, "u")
    if larger:
        tied = tied.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        tied = tied.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select("u", F.col("m").alias("v"))
        )
    return tied.where("u <> v").distinct()


def _all_stars(links: DataFrame) -> bool:
    """Whether every node has one link to a smaller node at most, and that is a root."""
    if not links.groupBy("u").count().where("count > 1").isEmpty():
        return False
    ends = links.select(F.col("v").alias("u")).distinct()
    return links.where("u < v").isEmpty() and links.join(ends, "u", "left_semi").isEmpty()


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (u, v); component is the smallest node.

    Alternates large-star and small-star steps until nothing changes. Links stay a table of
    at most its first size; a node with very many links is reduced to a minimum before the
    shuffle, and its links are spread again by the skew handling of the join.
    """
    links = saved(links.where("u <> v").select("u", "v").distinct(), "links")
    while not _all_stars(links):
        links = saved(_starred(_starred(links, True), False), "links")
    roots = links.select(F.col("v").alias("node")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        roots.select("node", F.col("node").alias("component"))
    )
