"""Boosted trees that stop on held-out ROC-AUC with patience in rounds.

Staged scoring: one pass finds every held-out row's leaf in every tree, its running sum of leaf
values is the margin after each round, and rows with equal margins of a round are one. One curve
job then gives the area of every round. Trees do not depend on how many follow, so fits of
growing size share their first trees, and the model that is kept is its own first rounds.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions.values import quoted
from riskframe.operators.metrics import sound_label
from riskframe.operators.order import bucket_count, quantile_splits, running_totals
from riskframe.session import checkpoint_folder, durable

#: Trees of the first fit; each further one has twice as many.
FIRST_FIT = 32
COUNTS = "round int, margin double, pos bigint, neg bigint"
COUNTS_ARROW = pa.schema(
    [("round", pa.int32()), ("margin", pa.float64()), ("pos", pa.int64()), ("neg", pa.int64())]
)


def leaf_values(model: GBTClassificationModel, df: DataFrame) -> list[list[float]]:
    """Weighted value of every leaf of every tree, leaves from left to right."""
    spark = df.sparkSession
    folder = f"{checkpoint_folder(spark)}/trees-{uuid.uuid4().hex}"
    model.save(folder)
    leaves = (
        spark.read.parquet(f"{folder}/data")
        .where("nodeData.leftChild = -1")
        .groupBy("treeID")
        .agg(F.sort_array(F.collect_list(F.struct("nodeData.id", "nodeData.prediction"))).alias("x"))
        .select("treeID", F.col("x.prediction").alias("values"))
    )
    found = {r.treeID: r["values"] for r in leaves.collect()}
    return [[w * v for v in found[i]] for i, w in enumerate(model.treeWeights)]


def staged_counts(model: GBTClassificationModel, df: DataFrame, label_col: str) -> DataFrame:
    """``round, margin, pos, neg``: rows of ``df`` (with assembled features) by margin after each round."""
    values = leaf_values(model, df)
    leaves = model.copy()
    leaves.setLeafCol("_leaves")
    placed = leaves.transform(df).select(
        sound_label(label_col).alias("label"), vector_to_array("_leaves").alias("leaves")
    )

    def margins(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            if not batch.num_rows:
                continue
            label = batch.column("label").to_numpy()
            flat = batch.column("leaves").flatten().to_numpy().astype(np.int64)
            leaf = flat.reshape(batch.num_rows, len(values))
            margin = np.zeros(batch.num_rows)
            for number, tree in enumerate(values, 1):
                margin = margin + np.array(tree)[leaf[:, number - 1]]
                seen, inverse = np.unique(margin, return_inverse=True)
                pos = np.bincount(inverse, weights=label, minlength=len(seen)).astype(np.int64)
                neg = np.bincount(inverse, minlength=len(seen)) - pos
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(seen), number, np.int32)), pa.array(seen),
                     pa.array(pos), pa.array(neg)],
                    schema=COUNTS_ARROW,
                )

    rows = placed.mapInArrow(margins, COUNTS)
    return rows.groupBy("round", "margin").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def staged_auc(model: GBTClassificationModel, df: DataFrame, label_col: str) -> list[float]:
    """ROC-AUC after every round; equal margins count half."""
    counts = durable(staged_counts(model, df, label_col))
    splits, _, _ = quantile_splits(counts, F.col("margin"), bucket_count(counts))
    totals = counts.groupBy("round").agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    placed = running_totals(counts, "margin", ["neg"], ["round"], splits)
    # Twice the wins over a negative, in whole numbers.
    won = F.col("pos").cast("decimal(38,0)") * (2 * (F.col("n") - F.col("neg_above")) - F.col("neg"))
    areas = placed.join(F.broadcast(totals), "round").groupBy("round").agg(
        F.try_divide(F.sum(won).cast("double"), F.first("p") * 2.0 * F.first("n")).alias("area")
    )
    found = {r["round"]: r["area"] for r in areas.collect()}
    if any(v is None for v in found.values()):
        raise ValueError("stopping rows need both label classes")
    return [found[i] for i in range(1, len(found) + 1)]


def best_round(areas: Sequence[float], patience: int) -> tuple[int, bool]:
    """Round with the best area before ``patience`` rounds without a better one; whether they ran out."""
    best, at = -1.0, 0
    for number, area in enumerate(areas, 1):
        if area > best:
            best, at = area, number
        elif number - at >= patience:
            return at, True
    return at, False


def first_trees(model: GBTClassificationModel, count: int) -> GBTClassificationModel:
    """The model of the first ``count`` rounds."""
    from pyspark import SparkContext

    context = SparkContext._active_spark_context
    jvm, gateway = context._jvm, context._gateway
    trees = gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, count)
    weights = gateway.new_array(jvm.double, count)
    for i, (tree, weight) in enumerate(zip(model.trees[:count], model.treeWeights)):
        trees[i], weights[i] = tree._java_obj, weight
    made = jvm.org.apache.spark.ml.classification.GBTClassificationModel(
        f"{model.uid}_{count}", trees, weights, model.numFeatures, 2
    )
    short = GBTClassificationModel(made)
    short.setFeaturesCol(model.getFeaturesCol())
    return short


def fit_with_patience(
    learner: GBTClassifier,
    train: DataFrame,
    held_out: DataFrame,
    label_col: str,
    most_trees: int,
    patience: int,
) -> GBTClassificationModel:
    """Fit on ``train``; keep the rounds up to the best ROC-AUC on ``held_out``."""
    if patience < 1 or most_trees < 1:
        raise ValueError("patience and trees must be at least 1")
    size = min(most_trees, max(FIRST_FIT, patience + 1))
    while True:
        model = learner.copy({learner.maxIter: size}).fit(train)
        at, ended = best_round(staged_auc(model, held_out, label_col), patience)
        if ended or size == most_trees:
            return first_trees(model, at)
        size = min(most_trees, 2 * size)
