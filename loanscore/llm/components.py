"""Connected components of an edge table, on Spark tables only.

Every node carries a label, at first the smallest of itself and its
neighbours. In each round a node looks at its neighbours' labels; the smallest
label seen from a component hooks that component's label onto the smaller one,
and labels follow the hooks twice.
Rounds end when no label can be lowered, so the result is exact whatever the
number of rounds, which falls with the logarithm of the longest chain in
practice.

Every round reads and writes tables in the shared checkpoint folder. Joins
are between such tables, so Spark can split the partitions of a hub (a node
or a component with a large share of all edges), and all minima are partial
aggregates before they are shuffled. Nothing is collected but row counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanscore.llm.common import Written


def connected_components(edges: DataFrame) -> Written:
    """(node, label): the nodes of ``edges`` (a, b) and their component's smallest node.

    Null ends are dropped; a loop (a = b) makes a node of its own; repeated
    edges count once. No edges give no rows.
    """
    ends = edges.where("a IS NOT NULL AND b IS NOT NULL")
    both = Written(ends.select("a", "b").union(ends.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    state = Written(
        both.df.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b")).select("node", F.least("node", "b").alias("label")),
        "labels",
    )
    while True:
        seen = (
            both.df.join(state.df.select(F.col("node").alias("b"), "label"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("seen"))
        )
        looked = Written(
            state.df.join(seen, "node").select("node", "label", F.least("label", "seen").alias("least")), "looked"
        )
        hooks = Written(
            looked.df.where("least < label").groupBy(F.col("label").alias("root")).agg(F.min("least").alias("onto")), "hooks"
        )
        if hooks.df.isEmpty():
            for old in (both, looked, hooks):
                old.drop()
            return state
        first, second = hooks.df.select("root", "onto"), hooks.df.select(F.col("root").alias("root2"), F.col("onto").alias("onto2"))
        lowered = (
            looked.df.join(first, F.col("label") == F.col("root"), "left")
            .withColumn("next", F.coalesce(F.least("least", "onto"), "least"))
            .join(second, F.col("next") == F.col("root2"), "left")
            .select("node", F.coalesce("onto2", "next").alias("label"))
        )
        previous, state = state, Written(lowered, "labels")
        for old in (previous, looked, hooks):
            old.drop()
