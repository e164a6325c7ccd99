"""Connected components over edges that Spark holds.

Min-label contraction: every node hooks onto its smallest neighbour, labels
are shortcut once (pointer jumping), edges are rewritten onto the labels, and
the rounds repeat until no edge is left. Edges never reach the driver; each
round's tables are written under ``spark.checkpoint.dir``, so lineage stays
short and a lost executor only costs a re-read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.tables import materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges(a, b)`` of one orderable type -> ``node, component``.

    Every node that an edge names is listed once with the smallest node of its
    component. Loops and repeated edges are harmless; null ends are ignored;
    no edges give no rows."""
    e = edges.select("a", "b").filter("a <> b").distinct()
    e, _ = materialize(e, "cc-edges")
    labels = None
    while e.head(1):
        sym = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = (sym.groupBy("a").agg(F.min("b").alias("m"))
                   .select(F.col("a").alias("node"), F.least("a", "m").alias("component")))
        hook, _ = materialize(hook, "cc-hook")
        up = hook.select(F.col("node").alias("component"), F.col("component").alias("up"))
        hook = hook.join(up, "component").select("node", F.col("up").alias("component"))
        hook, _ = materialize(hook, "cc-jump")
        to = lambda old, new: hook.select(F.col("node").alias(old), F.col("component").alias(new))
        e = (e.join(to("a", "x"), "a").join(to("b", "y"), "b")
              .select(F.col("x").alias("a"), F.col("y").alias("b")).filter("a <> b").distinct())
        e, _ = materialize(e, "cc-edges")
        if labels is None:
            labels = hook
        else:
            step = to("component", "next")
            labels = (labels.join(step, "component", "left")
                            .select("node", F.coalesce("next", "component").alias("component")))
            labels, _ = materialize(labels, "cc-labels")
    if labels is None:
        return e.select(F.col("a").alias("node"), F.col("b").alias("component")).limit(0)
    return labels
