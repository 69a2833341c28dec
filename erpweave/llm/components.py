"""Connected components of a link table by alternating stars, in DataFrame operations.

Large star: every node hands its larger neighbours to the least node it knows; small star: it does so
with its smaller neighbours and itself. Repeated in turn the links become one star per component in
a logarithmic number of rounds. Each round is written to the shared folder, which cuts the
lineage; no links reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from erpweave.session import materialize


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One step over ``links(u, v)`` with u > v."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else links
    least = both.groupBy("u").agg(F.min("v").alias("w")).select("u", F.least("u", "w").alias("least"))
    joined = both.join(least, "u")
    moved = joined.where("v > u") if large else joined
    out = moved.select(F.col("v").alias("u"), F.col("least").alias("v"))
    if not large:
        out = out.unionByName(least.select("u", F.col("least").alias("v")))
    return out.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def components(links: DataFrame, most_rounds: int = 50) -> DataFrame:
    """(node, root) for every node of ``links(u, v)`` but the roots; the root is the least node.

    Fails when the links are not stars after ``most_rounds``, rather than give wrong roots.
    """
    links = links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    for _ in range(most_rounds):
        links = materialize(_star(_star(links, True), False), "star")
        # Done when every node has one link, to a node that has none.
        seen = links.agg(F.count("*").alias("n"), F.count_distinct("u").alias("nodes")).first()
        if seen["n"] == seen["nodes"] and links.select(F.col("v").alias("u")).join(
                links.select("u"), "u", "left_semi").isEmpty():
            return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
    raise RuntimeError(f"links are no stars after {most_rounds} rounds")
