"""Connected components by contraction, as DataFrame steps.

Every round each component takes the smallest neighbour as its parent, chains of parents
are shortened by joining them with themselves, and edges inside a component go.  Each
component that still has an edge merges with another one, so the rounds are logarithmic.
Nothing is collected but a count.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import session


def _shortened(parents: DataFrame, keep: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Follow parents to their roots; the lengths of chains halve with every step."""
    while True:
        step = (
            parents.alias("a")
            .join(parents.select(F.col("node").alias("b"), F.col("root").alias("r")), F.col("root") == F.col("b"), "left")
            .select("node", F.coalesce("r", "root").alias("root"), (F.col("r").isNotNull() & (F.col("r") != F.col("root"))).alias("_moved"))
        )
        step = keep(step)
        moved = step.where("_moved").limit(1).count()
        parents = step.drop("_moved")
        if not moved:
            return parents


def components(
    edges: DataFrame, a: str = "a", b: str = "b", keep: Callable[[DataFrame], DataFrame] = session.checkpointed
) -> DataFrame:
    """``node`` and ``root``, the smallest node that edges lead to, for all nodes of edges.

    Null ends, loops and repeated edges add nothing; no edges give no rows.  ``keep`` writes a
    table that later steps read.
    """
    open_edges = edges.where(f"{a} <> {b}").select(
        F.least(a, b).alias("a"), F.greatest(a, b).alias("b")
    ).distinct()
    open_edges = keep(open_edges)
    labels = None
    while open_edges.limit(1).count():
        # The smaller end is a root or has a smaller neighbour itself, so chains only descend.
        parents = open_edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("root"))
        roots = _shortened(keep(parents), keep)
        labels = roots if labels is None else _relabel(labels, roots)
        labels = keep(labels)

        def renamed(e: DataFrame, side: str) -> DataFrame:
            named = roots.select(F.col("node").alias("_n"), F.col("root").alias("_r"))
            return e.join(named, F.col(side) == F.col("_n"), "left").withColumn(side, F.coalesce("_r", side)).drop("_n", "_r")

        rest = renamed(renamed(open_edges, "a"), "b").where("a <> b")
        open_edges = keep(rest.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    if labels is None:
        return open_edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    itself = labels.select(F.col("root").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return labels.unionByName(itself.join(labels.select("node"), "node", "left_anti"))


def _relabel(labels: DataFrame, roots: DataFrame) -> DataFrame:
    named = roots.select(F.col("node").alias("_n"), F.col("root").alias("_r"))
    old = labels.join(named, F.col("root") == F.col("_n"), "left").select("node", F.coalesce("_r", "root").alias("root"))
    new = roots.join(labels.select("node"), "node", "left_anti")
    return old.unionByName(new)
