"""Connected components of a link table, as joins and grouped minima.

Every node points to a parent, at first itself.  A round lets each node, and
its parent, point to the least grandparent seen over a link, then shortens all
paths by one step; rounds end when nothing changes.  Paths halve in a round, so
their number grows with the logarithm of a component's width.  Nothing but a
count reaches the driver, every grouping combines before its shuffle, and the
joins are plain equi-joins that adaptive execution can split at a hub.

Nulls link with nothing; loops and repeated links change nothing; no links give
no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm import common


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): every linked node with the least node of its component."""
    links = links.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v")
    edges = common.materialize(
        links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "links")
    if not edges.count():
        return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    f = common.materialize(edges.groupBy("u").agg(F.least(F.first("u"), F.min("v")).alias("f")), "parents")
    while True:
        # grandparents: f(f(u))
        g = f.join(f.select(F.col("u").alias("f"), F.col("f").alias("g")), "f").select("u", "f", "g")
        seen = (edges.join(g.select(F.col("u").alias("v"), "g"), "v").groupBy("u").agg(F.min("g").alias("m"))
                .join(f, "u"))
        offers = (seen.select("u", "m")
                  .unionByName(seen.select(F.col("f").alias("u"), "m"))
                  .unionByName(g.select("u", F.col("g").alias("m")))
                  .groupBy("u").agg(F.min("m").alias("m")))
        new = f.join(offers, "u").select("u", F.least("f", "m").alias("f"), (F.col("m") < F.col("f")).alias("_moved"))
        new = common.materialize(new, "parents")
        if not new.filter("_moved").count():
            return new.select(F.col("u").alias("node"), F.col("f").alias("root"))
        f = new.drop("_moved")
