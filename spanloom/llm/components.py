"""Connected components of an edge table, by repeated contraction.

Each round hooks every node to its smallest neighbour, follows those hooks once
more, and rewrites the edges between the nodes that remain; a round removes at
least half of the nodes that still have edges.  All steps are joins on node ids
and minima per node, so nothing is gathered on the driver or in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, release


def connected_components(edges: DataFrame) -> DataFrame:
    """(u, v) edges -> (node, root): one row per node that has an edge; root is the component's smallest node.

    Self-loops and repeated edges are harmless; null ends are ignored.  An empty
    table gives an empty result.
    """
    live = materialize(edges.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).filter("u is not null and v is not null and u <> v").distinct(), "edges")
    labels = None
    while not live.isEmpty():
        both = live.select("u", "v").unionByName(live.select(F.col("v").alias("u"), F.col("u").alias("v")))
        hook = materialize(both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("node"), F.least("u", "m").alias("up")), "hooks")
        second = hook.select(F.col("node").alias("up"), F.col("up").alias("top"))
        jumped = hook.join(second, "up").select("node", F.col("top").alias("root"))
        if labels is None:
            new = materialize(jumped, "labels")
        else:
            new = materialize(labels.join(jumped.select(F.col("node").alias("root"), F.col("root").alias("next")), "root", "left").select("node", F.coalesce("next", "root").alias("root")), "labels")
        step = new if labels is None else materialize(jumped, "jumps")
        a = step.select(F.col("node").alias("u"), F.col("root").alias("ru"))
        b = step.select(F.col("node").alias("v"), F.col("root").alias("rv"))
        rest = live.join(a, "u").join(b, "v").filter("ru <> rv").select(F.least("ru", "rv").alias("u"), F.greatest("ru", "rv").alias("v")).distinct()
        after = materialize(rest, "edges")
        for old in [live, hook, *([labels, step] if labels is not None else [])]:
            release(old)
        live, labels = after, new
    if labels is None:
        return live.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return labels
