"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvio.llm.common import staged


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b): root is the smallest
    node that can be reached.

    Each round hooks every node to its smallest neighbour, follows one more
    step, and contracts the links to the nodes that remain. A node that is
    hooked leaves, so the links shrink fast; the smallest node of a
    component never does. Only "is any link left" reaches the driver.
    """
    ordered = lambda a, b: [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]
    left = staged(links.select(*ordered("a", "b")).where("a <> b").distinct(), "links")
    rounds: list[DataFrame] = []
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooked = staged(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b"))
                        .select("node", F.least("node", "b").alias("root")), "hooked")
        step = hooked.select(F.col("node").alias("root"), F.col("root").alias("further"))
        hooked = staged(hooked.join(step, "root").select("node", F.col("further").alias("root")), "hooked")
        rounds.append(hooked)
        for end in ("a", "b"):
            left = left.join(hooked.withColumnRenamed("node", end), end).drop(end).withColumnRenamed("root", end)
        left = staged(left.select(*ordered("a", "b")).where("a <> b").distinct(), "links")
    if not rounds:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root")).limit(0)
    found = rounds[0]
    for later in rounds[1:]:
        later = later.select(F.col("node").alias("root"), F.col("root").alias("further"))
        found = found.join(later, "root", "left").select("node", F.coalesce("further", "root").alias("root"))
    return staged(found, "components")
