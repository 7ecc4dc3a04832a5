"""Connected components of a link table, by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecspark.llm.exact_dedup import with_groups
from vecspark.session import materialize


def _mapped(rows: DataFrame, column: str, parents: DataFrame, total: int) -> DataFrame:
    """``rows`` with ``column`` replaced by its parent; nodes named by very many rows are met by broadcast."""
    uses = rows.groupBy(F.col(column).alias("node")).agg(F.count(F.lit(1)).alias("_uses"))
    groups = materialize(parents.join(uses, "node").select(F.col("node").alias(column), F.col("parent").alias("_to"), "_uses"), "parents")
    met = with_groups(rows, groups, column, "_uses", total)
    return met.drop(column, "_uses").withColumnRenamed("_to", column)


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node in ``links`` (a, b); the label is the smallest node of the component.

    Every round each node takes its smallest neighbour as parent, parent chains are halved until they are
    roots, and links are rewritten to the roots.  A round leaves at most half of the nodes, so a few rounds
    do.  Each step is a written table, which cuts the lineage.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = materialize(both.filter("a <> b").distinct(), "edges")
    labels = None
    while True:
        total = edges.count()
        if not total:
            return labels if labels is not None else edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
        parents = materialize(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.min("a")).alias("parent")), "parents")
        while True:
            nodes = parents.select("node", "parent", F.col("parent").alias("up"))
            jumped = materialize(_mapped(nodes, "up", parents, total), "jumped")
            moved = jumped.filter("up <> parent").limit(1).count()
            parents = jumped.select("node", F.col("up").alias("parent"))
            if not moved:
                break
        if labels is None:
            labels = parents.select("node", F.col("parent").alias("label"))
        else:
            size = labels.count()
            known = labels.join(parents.select(F.col("node").alias("label")).distinct(), "label", "left_semi")
            rest = labels.join(parents.select(F.col("node").alias("label")).distinct(), "label", "left_anti")
            labels = _mapped(known, "label", parents, size).select("node", "label").unionByName(rest.select("node", "label"))
            labels = materialize(labels, "labels")
        half = materialize(_mapped(edges, "a", parents, total).select("a", "b"), "half-edges")
        edges = materialize(_mapped(half, "b", parents, total).select("a", "b").filter("a <> b").distinct(), "edges")
