"""Connected components of an edge table by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelake.llm.common import materialize


def components(edges: DataFrame) -> DataFrame:
    """(v, root) for every end of ``edges`` (a, b long); ``root`` is one of the
    component's vertices.

    Each round every vertex hooks to its smallest neighbour, chains of hooks
    are shortened by two jumps, and the edges are rewritten to the hooked
    ends; equal ends drop out.  The number of rounds is logarithmic in the
    usual way.  Hooks are partial ``min`` aggregates, so a vertex with many
    edges is reduced before the shuffle; every round is written to the shared
    folder, so no lineage grows."""
    edges = materialize(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                        .filter("a <> b").distinct())
    labels = materialize(edges.select(F.explode(F.array("a", "b")).alias("v")).distinct()
                         .select("v", F.col("v").alias("root")))
    while edges.limit(1).count():
        hook = edges.groupBy(F.col("b").alias("x")).agg(F.min("a").alias("y"))
        for _ in range(2):
            up = hook.select(F.col("x").alias("y"), F.col("y").alias("z"))
            hook = hook.join(up, "y", "left").select("x", F.coalesce("z", "y").alias("y"))
        hook = materialize(hook)

        def lifted(df: DataFrame, col: str) -> DataFrame:
            to = hook.select(F.col("x").alias(col), F.col("y").alias("_y"))
            return df.join(to, col, "left").withColumn(col, F.coalesce("_y", col)).drop("_y")
        labels = materialize(lifted(labels, "root"))
        moved = lifted(lifted(edges, "a"), "b").filter("a <> b")
        edges = materialize(moved.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    return labels
