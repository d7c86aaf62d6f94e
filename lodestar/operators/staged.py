"""Evaluation after every tree of a boosted fit, in one pass over the rows.

The trees' nodes (as many as the model settings allow, whatever the data) go
to the tasks as arrays.  Each row is walked through all trees once, and its
margin after each tree is kept as an array; log loss and the exact AUC of every
stage are then aggregates of those arrays.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.operators.cumulative import cumulative
from lodestar.session import shared_dir
from lodestar.sources.scratch import scratch
from lodestar.sources.tables import checkpoint_table, intermediate


class Trees:
    """The nodes of an ensemble; children and categories index into arrays."""

    def __init__(self, nodes: list, weights: list[float]):
        cats = max([len(n.cats) and int(max(n.cats)) + 1 for n in nodes if n.arity >= 0] + [1])
        first = {}
        for i, n in enumerate(nodes):
            first.setdefault(n.tree, i)
        self.roots = [first[t] for t in sorted(first)]
        self.weights = np.array(weights)
        base = np.array([first[n.tree] for n in nodes])
        self.leaf = np.array([n.left < 0 for n in nodes])
        self.left, self.right = (np.array([getattr(n, s) for n in nodes]) + base for s in ("left", "right"))
        self.feature = np.array([max(n.feature, 0) for n in nodes])
        self.by_category = np.array([n.arity >= 0 for n in nodes]) & ~self.leaf
        self.threshold = np.array([n.cats[0] if n.arity < 0 and n.left >= 0 else 0.0 for n in nodes])
        self.goes_left = np.zeros((len(nodes), cats), bool)
        for i, n in enumerate(nodes):
            if n.arity >= 0 and n.left >= 0:
                self.goes_left[i, np.array(n.cats, int)] = True
        self.prediction = np.array([n.prediction for n in nodes])

    def margins(self, x: np.ndarray) -> np.ndarray:
        """Margin of each row after each tree."""
        out, rows = np.empty((len(x), len(self.roots))), np.arange(len(x))
        for t, root in enumerate(self.roots):
            at = np.full(len(x), root)
            while not self.leaf[at].all():
                value = x[rows, self.feature[at]]
                code = np.where(np.isfinite(value) & (value < self.goes_left.shape[1]), value, 0).astype(int)
                known = value < self.goes_left.shape[1]
                left = np.where(self.by_category[at], self.goes_left[at, code] & known, value <= self.threshold[at])
                at = np.where(self.leaf[at], at, np.where(left, self.left[at], self.right[at]))
            out[:, t] = self.weights[t] * self.prediction[at]
        return np.cumsum(out, axis=1)


def trees_of(model, folder: str) -> Trees:
    """The nodes of a fitted ``GBTClassificationModel``, through its saved form."""
    from pyspark.sql import SparkSession
    spark = SparkSession.active()
    model.write().overwrite().save(folder)
    nodes = (spark.read.parquet(f"{folder}/data")
             .select(F.col("treeID").alias("tree"), "nodeData.id", "nodeData.prediction", F.col("nodeData.leftChild").alias("left"),
                     F.col("nodeData.rightChild").alias("right"), F.col("nodeData.split.featureIndex").alias("feature"),
                     F.col("nodeData.split.leftCategoriesOrThreshold").alias("cats"), F.col("nodeData.split.numCategories").alias("arity"))
             .orderBy("tree", "id").collect())
    return Trees(nodes, list(model.treeWeights))


def margins(model: PipelineModel, test: DataFrame, label_col: str) -> DataFrame:
    """(y, margins): label and margin after each tree of every row."""
    data = test.withColumn(label_col, F.col(label_col).cast("double"))
    for stage in model.stages[:-1]:
        data = stage.transform(data)
    spark = test.sparkSession
    with scratch(spark):
        trees = trees_of(model.stages[-1], intermediate(shared_dir(spark, f"trees-{uuid.uuid4().hex[:12]}")))
    shared = spark.sparkContext.broadcast(trees)           # bounded by trees and depth

    def run(batches):
        for b in batches:
            x = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1) if b.num_rows else np.zeros((0, 1))
            for a in range(0, b.num_rows, 4096):
                got = shared.value.margins(x[a:a + 4096])
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(a, 4096), pa.ListArray.from_arrays(pa.array(np.arange(len(got) + 1) * got.shape[1], pa.int32()),
                                                                          pa.array(got.ravel()))], ["y", "margins"])

    return data.select(F.col(label_col).alias("y"), vector_to_array("features").alias("x")).mapInArrow(run, "y double, margins array<double>")


def staged_evaluation(model: PipelineModel, test: DataFrame, label_col: str) -> DataFrame:
    """(tree, log_loss, auc) after each tree; the margins are stored once."""
    spark = test.sparkSession
    kept = checkpoint_table(margins(model, test, label_col), shared_dir(spark, f"margins-{uuid.uuid4().hex[:12]}"))
    long = kept.select(F.col("y").cast("long").alias("y"), F.posexplode("margins").alias("tree", "margin"))
    sign = 2 * F.col("y") - 1
    loss = long.groupBy("tree").agg(F.avg(2 * F.log1p(F.exp(-2.0 * sign * F.col("margin")))).alias("log_loss"))
    points = (long.groupBy("tree", "margin").agg(F.sum("y").alias("pos"), F.count(F.lit(1)).alias("n"))
              .withColumn("neg", F.col("n") - F.col("pos")).drop("n"))
    run = cumulative(points, ["tree"], [("margin", False)], ["pos", "neg"])
    # a distinct margin's positives beat the negatives below it, and tie with its own
    twice = F.sum((F.col("pos") * (2 * (F.col("neg_all") - F.col("neg_upto")) + F.col("neg"))).cast("decimal(38,0)"))
    area = run.groupBy("tree").agg((twice.cast("double") / (2.0 * F.max("pos_all") * F.max("neg_all"))).alias("auc"))
    return loss.join(area, "tree").select((F.col("tree") + 1).alias("tree"), "log_loss", "auc")
