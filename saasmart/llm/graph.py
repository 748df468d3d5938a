"""Connected components of a link table, by contraction.

Each round hooks every node to its smallest neighbour, follows the hooks to their
roots by pointer jumping, and relabels the links; nodes that are no root vanish, so
at least half of the linked nodes go each round. A component's smallest node is
always a root and so ends as its label. Every round's tables are written to the
shared folder: lineage stays short and a lost executor costs one round at most.

Defined results: null ends and self links are ignored, repeated links count once, an
empty link table gives an empty result, nodes without a link are not listed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import cut


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every linked node; component: the smallest node reachable."""
    def tidy(x: DataFrame) -> DataFrame:
        return x.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")) \
            .where("a is not null and b is not null and a <> b").distinct()

    edges = cut(tidy(links.select(F.col(a).alias("a"), F.col(b).alias("b"))), "links")
    levels: list[DataFrame] = []
    while not edges.isEmpty():
        ends = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = cut(ends.groupBy("a").agg(F.min("b").alias("b"))
                   .select(F.col("a").alias("node"), F.least("a", "b").alias("root")), "hooks")
        while True:
            above = hook.select(F.col("node").alias("root"), F.col("root").alias("top")).where("root <> top")
            jumped = cut(hook.join(above, "root", "left")
                         .select("node", F.coalesce("top", "root").alias("root"), F.col("top").isNotNull().alias("moved")),
                         "jumps")
            hook = jumped.select("node", "root")
            if jumped.where("moved").isEmpty():
                break
        levels.append(hook)
        to_a = hook.select(F.col("node").alias("a"), F.col("root").alias("root_a"))
        to_b = hook.select(F.col("node").alias("b"), F.col("root").alias("root_b"))
        edges = cut(tidy(edges.join(to_a, "a").join(to_b, "b").select(F.col("root_a").alias("a"), F.col("root_b").alias("b"))),
                    "links")
    if not levels:
        return links.select(F.col(a).alias("node"), F.col(a).alias("component")).limit(0)
    out = levels[-1].withColumnRenamed("root", "component")
    for hook in reversed(levels[:-1]):
        final = out.select(F.col("node").alias("root"), "component")
        out = hook.join(final, "root", "left").select("node", F.coalesce("component", "root").alias("component"))
    return out
