"""Connected components of a graph of links, in rounds of joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsemill.llm.shared import staged


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """(node, root) for every node of the links (a, b); the root is the smallest node of its component.

    Every round gives a node the smallest root among its own and its neighbours' and then takes the root
    of that root, so chains shorten by half; rounds end when nothing changes, without a limit.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = staged(both.filter("a <> b").distinct(), f"{label}-edges")
    roots = staged(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("root")), f"{label}-roots")
    while True:
        near = edges.join(roots.select(F.col("node").alias("b"), "root"), "b").groupBy(F.col("a").alias("node")).agg(
            F.min("root").alias("near")
        )
        met = roots.join(near, "node").select("node", F.least("root", "near").alias("root"), F.col("root").alias("old"))
        jump = roots.select(F.col("node").alias("root"), F.col("root").alias("next"))
        moved = staged(
            met.join(jump, "root", "left").select("node", F.least("root", F.coalesce("next", "root")).alias("root"), "old"),
            f"{label}-roots",
        )
        changed = moved.filter(F.col("root") != F.col("old")).limit(1).count()
        roots = moved.select("node", "root")
        if not changed:
            return roots
