"""A fitted forest in the open: its nodes as a table, its formula as one SQL expression."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from wattloom.operators.model import model_features
from wattloom.workspace import materialize, new_path

# Nodes that one expression may hold; larger forests score by the model itself.
EXPRESSION_NODES = 20_000


def tree_nodes(model: PipelineModel) -> DataFrame:
    """``TREE, NODE, FEATURE, THRESHOLD, LEFT, RIGHT, VALUE, ROWS``: one row for each node.

    A row whose feature is at most the threshold goes left.  Leaves have no feature,
    and the root of a tree is node 0.  ``ROWS`` is the weight of the training rows that
    reached the node.
    """
    spark = SparkSession.active()
    path = new_path(spark, "trees")
    model.stages[-1].write().overwrite().save(path)
    names = F.array(*[F.lit(f) for f in model_features(model)])
    node = F.col("nodeData")
    is_split = node["leftChild"] >= 0
    return materialize(
        spark.read.parquet(f"{path}/data").select(
            F.col("treeID").alias("TREE"),
            node["id"].alias("NODE"),
            F.when(is_split, F.element_at(names, node["split"]["featureIndex"] + 1)).alias("FEATURE"),
            F.when(is_split, node["split"]["leftCategoriesOrThreshold"][0]).alias("THRESHOLD"),
            F.when(is_split, node["leftChild"]).alias("LEFT"),
            F.when(is_split, node["rightChild"]).alias("RIGHT"),
            node["prediction"].alias("VALUE"),
            node["rawCount"].alias("ROWS"),
        ),
        "nodes",
    )


def _number(value: float) -> str:
    return f"CAST('{value!r}' AS DOUBLE)"


def _formula(nodes: Mapping[int, Row], at: int) -> str:
    node = nodes[at]
    if node["FEATURE"] is None:
        return _number(node["VALUE"])
    left, right = _formula(nodes, node["LEFT"]), _formula(nodes, node["RIGHT"])
    test = f"CAST({node['FEATURE']} AS DOUBLE) <= {_number(node['THRESHOLD'])}"
    return f"CASE WHEN {test} THEN {left} ELSE {right} END"


def forest_sql(model: PipelineModel, nodes: DataFrame | None = None) -> str:
    """The forest's prediction as an SQL expression over its features.

    It gives the very doubles of the model, in Spark and in other engines, and null where
    a feature is null or NaN, for which the model has no row.  The expression has all nodes,
    so forests of more than ``EXPRESSION_NODES`` are refused.
    """
    features = model_features(model)
    if any(not re.fullmatch(r"[A-Za-z_]\w*", f) for f in features):
        raise ValueError("features need plain names")
    nodes = tree_nodes(model) if nodes is None else nodes
    if nodes.count() > EXPRESSION_NODES:
        raise ValueError(f"the forest has more than {EXPRESSION_NODES} nodes")
    trees: dict[int, dict[int, Row]] = {}
    for row in nodes.collect():
        trees.setdefault(row["TREE"], {})[row["NODE"]] = row
    total = " + ".join(["CAST('0.0' AS DOUBLE)", *(_formula(trees[t], 0) for t in sorted(trees))])
    missing = " OR ".join(f"{f} IS NULL OR isnan(CAST({f} AS DOUBLE))" for f in features)
    return f"CASE WHEN {missing} THEN NULL ELSE ({total}) / {_number(float(len(trees)))} END"


def forest_column(model: PipelineModel, nodes: DataFrame | None = None) -> Column:
    """The forest's prediction as a Column: scores rows without the model, batch or stream."""
    return F.expr(forest_sql(model, nodes))
