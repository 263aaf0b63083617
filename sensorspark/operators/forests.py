"""Scoring of many rows by random forests, tree by tree.

A row that meets hundreds of deep trees one after the other reads memory all over. Here a batch of rows walks one tree at
a time: values become their places among a feature's thresholds once, a tree is one array of (feature, threshold) and one of children.
Predictions are those of Spark's models to the last bit: trees are added in their order.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorspark.plans.shared import new_path

# Rows that walk a tree together; their places among thresholds stay in the cache.
TOGETHER = 4096
_BITS = 16


class Forest:
    """Trees of a model as arrays: nodes of all trees one after the other, leaves are their own children."""

    def __init__(self, trees: np.ndarray, left: np.ndarray, right: np.ndarray, feature: np.ndarray, threshold: np.ndarray, value: np.ndarray,
                 features: int) -> None:
        """Nodes by tree and number; `left` and `right` are numbers within the tree, negative in leaves."""
        self.starts = np.flatnonzero(np.diff(trees, prepend=-1))
        first = np.repeat(self.starts, np.diff(self.starts, append=len(trees)))
        inner, own = left >= 0, np.arange(len(trees))
        self.thresholds = [np.unique(threshold[inner & (feature == f)]) for f in range(features)]
        if features >= 1 << _BITS - 1 or max(map(len, self.thresholds), default=0) >= 1 << _BITS:
            raise ValueError("too many features or thresholds")
        place = np.zeros(len(trees), np.int32)
        for f, known in enumerate(self.thresholds):
            mine = inner & (feature == f)
            place[mine] = np.searchsorted(known, threshold[mine])
        self.test = (np.where(inner, feature, 0).astype(np.int64) << _BITS) | place
        self.children = np.stack([np.where(inner, first + left, own), np.where(inner, first + right, own)], axis=1).ravel()
        self.inner, self.value = inner, value

    def places(self, x: np.ndarray) -> np.ndarray:
        """Thresholds below each value: a row goes left at a threshold if no more than those before it are below."""
        out = np.empty(x.shape, np.uint16)
        for f, known in enumerate(self.thresholds):
            out[:, f] = np.searchsorted(known, x[:, f], side="left")
        return out

    def predict(self, places: np.ndarray) -> np.ndarray:
        flat, n = places.ravel(), len(places)
        base, total = np.arange(n) * places.shape[1], np.zeros(n)
        for root in self.starts.tolist():
            node, walking, steps = np.full(n, root), None, 0
            at, own = node, base
            while len(at):
                test = self.test.take(at)
                right = flat.take(own + (test >> _BITS)) > (test & ((1 << _BITS) - 1))
                at = self.children.take(2 * at + right)
                steps += 1
                if steps % 3 == 0:  # rows in leaves leave
                    on = self.inner.take(at)
                    walking = np.arange(n) if walking is None else walking
                    node[walking] = at
                    walking, at, own = walking[on], at[on], own[on]
            total += self.value.take(node)
        return total / len(self.starts)


def arrays(spark: SparkSession, model: RandomForestRegressionModel) -> Forest:
    """The trees of a model, read from its stored form once."""
    if not hasattr(model, "_arrays"):
        path = new_path(spark, "forest")
        model.write().save(path)
        node = F.col("nodeData")
        rows = spark.read.parquet(f"{path}/data").select(
            "treeID", node["id"].alias("id"), node["leftChild"].alias("left"), node["rightChild"].alias("right"),
            node["split"]["featureIndex"].alias("feature"), F.get(node["split"]["leftCategoriesOrThreshold"], F.lit(0)).alias("threshold"),
            node["prediction"].alias("value"), (node["split"]["numCategories"] >= 0).alias("named")).toPandas().sort_values(["treeID", "id"])
        if rows["named"].any():
            raise ValueError("splits by category are not read")
        model._arrays = Forest(*(rows[c].to_numpy() for c in ("treeID", "left", "right", "feature", "threshold", "value")), model.numFeatures)
    return model._arrays


def predictions(df: DataFrame, vector: str, wanted: Sequence[tuple[RandomForestRegressionModel, Sequence[float]]]) -> Column:
    """An array with the prediction of each (model, values appended to the vector)."""
    spark = df.sparkSession
    forests = {id(model): arrays(spark, model) for model, _ in wanted}
    told = spark.sparkContext.broadcast((forests, [(id(model), list(more)) for model, more in wanted]))

    def score(x: np.ndarray) -> np.ndarray:
        known, asked = told.value
        out = np.empty((len(x), len(asked)))
        for i, (name, more) in enumerate(asked):
            out[:, i] = known[name].predict(known[name].places(np.hstack([x, np.tile(more, (len(x), 1))]) if more else x))
        return out

    @F.arrow_udf("array<double>")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            n, width = len(batch), len(told.value[1])
            x = batch.flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.zeros((0, 0))
            parts = [score(x[a: a + TOGETHER]) for a in range(0, n, TOGETHER)]
            values = np.concatenate(parts).ravel() if parts else np.zeros(0)
            yield pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), pa.array(values))

    return scored(vector_to_array(vector))
