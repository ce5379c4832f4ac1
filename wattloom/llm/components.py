"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.workspace import materialize


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges`` (columns ``u`` and ``v``, long).

    ``component`` is the least node of the component.  Each round, every node joins
    its neighbour of least hash (or stays, if its own is less) and the edges between
    joined nodes remain; hashes make the number of rounds grow as the logarithm of the
    longest path.  All steps are joins and combinable minima, so a node with very many
    edges is no trouble, and every round is stored.
    """
    edges = materialize(edges.where("u <> v").select("u", "v").distinct(), "edges")
    nodes = edges.select(F.col("u").alias("node")).union(edges.select("v")).distinct()
    labels = materialize(nodes.withColumn("label", F.col("node")), "labels")
    ranked = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("n"))
    while not edges.isEmpty():
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        joined = materialize(
            both.groupBy("u")
            .agg(F.min(ranked("v")).alias("least"))
            .select("u", F.least("least", ranked("u"))["n"].alias("to")),
            "joined",
        )
        left = joined.select("u", F.col("to").alias("to_u"))
        right = joined.select(F.col("u").alias("v"), F.col("to").alias("to_v"))
        edges = materialize(
            edges.join(left, "u")
            .join(right, "v")
            .where("to_u <> to_v")
            .select(F.least("to_u", "to_v").alias("u"), F.greatest("to_u", "to_v").alias("v"))
            .distinct(),
            "edges",
        )
        labels = materialize(
            labels.join(joined.withColumnRenamed("u", "label"), "label", "left").select(
                "node", F.coalesce("to", "label").alias("label")
            ),
            "labels",
        )
    least = labels.groupBy("label").agg(F.min("node").alias("component"))
    return labels.join(least, "label").select("node", "component")
