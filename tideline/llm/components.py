"""Connected components by hooking and contraction.

In a round every node of the contracted graph hooks onto its smallest neighbour, if that is smaller
than itself. Hooks go downwards, so they form trees, which pointer jumping flattens in as many
joins as the logarithm of their depth; then the edges are contracted to the roots. Every table is
written to the shared scratch folder. A node with very many edges costs one partial row per task in
the aggregation, and adaptive execution splits its rows in the joins.

Edges with a null end and loops are ignored; repeated edges count once; no edges give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import stage


def _both_ways(edges: DataFrame) -> DataFrame:
    ab = edges.select("a", "b").filter("a is not null and b is not null and a <> b")
    return ab.unionByName(ab.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()


def _flattened(hooks: DataFrame) -> DataFrame:
    """`node, root` where following `root` any further changes nothing."""
    while True:
        onward = hooks.select(F.col("node").alias("root"), F.col("root").alias("further"))
        jumped = stage(
            hooks.join(onward, "root").select(
                "node", F.col("further").alias("root"), (F.col("further") != F.col("root")).alias("moved")
            ),
            "components-jumps",
        )
        hooks = jumped.select("node", "root")
        if jumped.filter("moved").isEmpty():
            return hooks


def connected_components(edges: DataFrame) -> DataFrame:
    """`id, component` for each end of `edges` (a, b): the smallest id it reaches."""
    edges = stage(_both_ways(edges), "components-edges")
    found = edges.select(F.col("a").alias("id")).distinct().withColumn("component", F.col("id"))
    while not edges.isEmpty():
        hooks = edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
        hooks = stage(
            hooks.select("node", F.least("node", "least").alias("root")), "components-hooks"
        )
        roots = _flattened(hooks)
        found = stage(
            found.join(roots, F.col("component") == F.col("node"), "left").select(
                "id", F.coalesce("root", "component").alias("component")
            ),
            "components-found",
        )
        of_a = roots.select(F.col("node").alias("a"), F.col("root").alias("root_a"))
        of_b = roots.select(F.col("node").alias("b"), F.col("root").alias("root_b"))
        contracted = (
            edges.join(of_a, "a")
            .join(of_b, "b")
            .filter("root_a <> root_b")
            .select(F.col("root_a").alias("a"), F.col("root_b").alias("b"))
            .distinct()
        )
        edges = stage(contracted, "components-edges")
    return found


def joined_components(components: DataFrame, links: DataFrame) -> DataFrame:
    """`components` after further `links` (a, b), whose ends may be new.

    The links are contracted to the components they join, which is a far smaller graph than that
    of all links. Without links between two of them the components stay as they are.
    """
    of_a = components.select(F.col("id").alias("a"), F.col("component").alias("of_a"))
    of_b = components.select(F.col("id").alias("b"), F.col("component").alias("of_b"))
    between = stage(
        links.select("a", "b")
        .join(of_a, "a", "left")
        .join(of_b, "b", "left")
        .select(F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b"))
        .filter("a <> b")
        .distinct(),
        "components-between",
    )
    if between.isEmpty():
        return components
    upper = connected_components(between)
    # An end without a component so far is its own, and is there under its own name.
    new = upper.select("id").join(components, "id", "left_anti")
    every = components.unionByName(new.withColumn("component", F.col("id")))
    roots = upper.select(F.col("id").alias("component"), F.col("component").alias("root"))
    return stage(
        every.join(roots, "component", "left").select(
            "id", F.coalesce("root", "component").alias("component")
        ),
        "components-found",
    )
