"""Connected components of a link graph, by rounds of hooking to the smallest neighbour and contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yardstick.llm.common import drop_stored, store


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every vertex of links (a, b): component is the smallest vertex reachable.

    Each round maps every vertex to the smallest of itself and its neighbours (one pointer jump
    further where that hooks on in turn), and the links with it; links inside one vertex vanish.
    A round at least halves the vertices that still have links in any tree of hooks, and the
    loop ends when no link is left. Tables are written in every round; the joins have an
    exchange on both sides, so that adaptive execution can split a hub. Null ends are ignored.
    """
    def tidy(df: DataFrame) -> DataFrame:
        return df.where(F.col("a") != F.col("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    edges = store(tidy(links), "cc-edges")
    labels = None
    while True:
        if labels is not None and edges.isEmpty():
            drop_stored(edges)
            return labels
        ends = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = store(ends.groupBy(F.col("a").alias("id")).agg(F.least(F.col("id"), F.min("b")).alias("to")), "cc-hooks")
        far = hooks.select(F.col("id").alias("to"), F.col("to").alias("__far"))
        parents = store(hooks.join(far, "to").select("id", F.col("__far").alias("to")), "cc-parents")
        old_labels, old_edges = labels, edges
        if labels is None:
            labels = parents.withColumnRenamed("to", "component")
        else:
            to = parents.select(F.col("id").alias("component"), "to")
            labels = store(labels.join(to, "component", "left")
                           .select("id", F.coalesce("to", "component").alias("component")), "cc-labels")
        moved = (edges.join(parents.select(F.col("id").alias("a"), F.col("to").alias("__a")), "a")
                 .join(parents.select(F.col("id").alias("b"), F.col("to").alias("__b")), "b")
                 .select(F.col("__a").alias("a"), F.col("__b").alias("b")))
        edges = store(tidy(moved), "cc-edges")
        drop_stored(hooks)
        drop_stored(old_edges)
        if old_labels is not None:
            drop_stored(old_labels)
            drop_stored(parents)


def extended(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The stored `labels` (from `components`) after more links (a, b; stored) are added to those that made them.

    The added links are taken between the components so far, and only the components that they join are worked on: the
    links that made `labels` are not gone through again. Without such links, `labels` itself is returned.
    """
    of = lambda end: labels.select(F.col("id").alias(end), F.col("component").alias(f"__{end}"))
    between = store(links.join(of("a"), "a", "left").join(of("b"), "b", "left")
                    .select(F.coalesce("__a", "a").alias("a"), F.coalesce("__b", "b").alias("b")).where("a <> b"), "cc-between")
    if between.isEmpty():
        drop_stored(between)
        return labels
    met = components(between)
    drop_stored(between)
    old = (labels.join(met.select(F.col("id").alias("component"), F.col("component").alias("__to")), "component", "left")
           .select("id", F.coalesce("__to", "component").alias("component")))
    return store(old.unionByName(met.join(labels.select("id"), "id", "left_anti")), "cc-labels")
