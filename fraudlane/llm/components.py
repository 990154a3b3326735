"""Connected components of a link table, by contraction with written rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def _with_degrees(links: DataFrame) -> DataFrame:
    """``links`` with n_a and n_b, the number of links of each end."""
    n = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("n"))
    return links.join(n.toDF("a", "n_a"), "a").join(n.toDF("b", "n_b"), "b")


def connected(links: DataFrame) -> DataFrame:
    """(node, root) for every node of links (a, b); the roots name the components.

    In each round every node points to the first of its neighbours and itself, and the links between
    the nodes pointed to make the next, smaller graph. In every second round the order is by a hash of
    node and round, so a path shrinks by a constant share however its ids are ordered; in the others
    nodes of more links come first, so a star becomes one node, where by hashes about half of its leaves would stay.
    A neighbourhood is only ever a minimum or a count, never a list.
    """
    links = materialise(links.select("a", "b").where("a != b").distinct(), "links")
    roots, step = None, 0
    while not links.isEmpty():
        step += 1
        priority = lambda c: F.struct((-F.col(f"n_{c}")).alias("n"), F.xxhash64(F.col(c), F.lit(step)).alias("p"), F.col(c).alias("node"))
        ranked = _with_degrees(links) if step % 2 else links.withColumns({"n_a": F.lit(0), "n_b": F.lit(0)})
        # both ends come with the link, so a node's own priority is at hand
        ends = ranked.select(F.explode(F.array("a", "b")).alias("node"), F.least(priority("a"), priority("b")).alias("to"))
        point = ends.groupBy("node").agg(F.min("to").alias("to"))
        point = materialise(point.select("node", F.col("to.node").alias("root")), "points")
        if roots is None:
            roots = point
        else:
            onward = point.select(F.col("node").alias("root"), F.col("root").alias("next"))
            roots = materialise(roots.join(onward, "root", "left").select("node", F.coalesce("next", "root").alias("root")), "roots")
        to = point.select(F.col("node").alias("n"), F.col("root").alias("r"))
        links = (links.join(to.withColumnsRenamed({"n": "a", "r": "ra"}), "a").join(to.withColumnsRenamed({"n": "b", "r": "rb"}), "b")
                 .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).where("a != b").distinct())
        links = materialise(links, "links")
    return roots if roots is not None else links.select(F.col("a").alias("node"), F.col("b").alias("root"))
