"""Connected components of a table of links, in rounds of star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from skygauge.llm.common import materialized


def _state(stars: DataFrame) -> tuple:
    """Whether a round has changed anything: rows and an order-free digest."""
    row = stars.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("node", "root").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("node", "root").union(edges.select(F.col("root").alias("node"), F.col("node").alias("root")))
    lowest = both.groupBy("node").agg(F.least(F.min("root"), F.col("node")).alias("lowest"))
    far = both.where(F.col("root") > F.col("node")).join(lowest, "node")
    return far.select(F.col("root").alias("node"), F.col("lowest").alias("root")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    lowest = edges.groupBy("node").agg(F.min("root").alias("lowest"))
    near = edges.join(lowest, "node").where(F.col("root") != F.col("lowest"))
    return near.select(F.col("root").alias("node"), F.col("lowest").alias("root")).union(lowest).distinct()


def component_roots(links: DataFrame) -> DataFrame:
    """Rows (``node``, ``root``) for every node that has a link: the smallest node it reaches.

    ``links`` has two long columns ``a`` and ``b``; order, repeats and links of a node to itself don't matter, and
    links with a null end are none. No links give no rows. Neighbours are reduced to their minimum before they are
    shuffled, and every round is materialised, so a node with very many links isn't gathered anywhere.
    """
    links = links.where("a is not null and b is not null and a != b")
    edges = materialized(links.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root")).distinct())
    state = _state(edges)
    while state[0]:
        edges = materialized(_small_star(_large_star(edges)))
        before, state = state, _state(edges)
        if state == before:
            break
    roots = edges.select(F.col("root").alias("node"), F.col("root")).distinct()
    return edges.select("node", "root").union(roots)
