"""Connected components of a link table, by alternating star contractions.

Large star: every node hands its larger neighbours to the least node it sees. Small star:
every node hands its smaller neighbours, and itself, to the least of them. Both keep the
components and end, after a number of rounds that is logarithmic in practice, in one star
around the least node of each component. Minima combine before the shuffle, and the joins
are inner joins on a node, which Spark splits at run time when a node is hot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarn.session import stage


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.min("v").alias("low"))
    larger = both.filter("v > u").join(least, "u")
    return larger.select(F.col("v").alias("u"), F.least("low", "u").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("low"))
    smaller = edges.join(least, "u").filter("v > low").select(F.col("v").alias("u"), F.col("low").alias("v"))
    return smaller.union(least).distinct()


def _only_stars(edges: DataFrame) -> bool:
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("outer"), F.lit(0).alias("inner"))
    starts = edges.select(F.col("v").alias("node"), F.lit(0).alias("outer"), F.lit(1).alias("inner"))
    seen = ends.union(starts).groupBy("node").agg(F.sum("outer").alias("o"), F.max("inner").alias("i"))
    return not seen.filter("o > 1 OR (o > 0 AND i > 0)").head(1)


def stars(edges: DataFrame) -> DataFrame:
    """(u, v): every linked node but the least of its component, with that least node.

    `edges` has two columns of node numbers, in any order and with repeats; null ends and
    links of a node with itself are left out. Each round is written to the shared folder.
    """
    first, second = (F.col(f"`{c}`").cast("long") for c in edges.columns[:2])
    links = edges.select(F.greatest(first, second).alias("u"), F.least(first, second).alias("v"), (first == second).alias("same"))
    links = stage(links.filter("NOT same").select("u", "v").distinct(), "links")
    while not _only_stars(links):
        links = stage(_small_star(_large_star(links)), "links")
    return links


def with_component(nodes: DataFrame, node: str, edges: DataFrame, name: str = "component_id") -> DataFrame:
    """`nodes` with the least node number reachable over `edges`, their own included.

    A null node has no component. A node may be repeated, also very often: the stars have
    one row per node, and the join keeps all rows of the left side.
    """
    found = stars(edges).select(F.col("u").alias("__u"), F.col("v").alias("__v"))
    key = F.col(f"`{node}`").cast("long")
    joined = nodes.join(found, key == F.col("__u"), "left")
    return joined.withColumn(name, F.coalesce("__v", key)).drop("__u", "__v")
