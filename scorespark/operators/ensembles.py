"""Trained trees as arrays of nodes, and how well every smaller ensemble inside a trained one predicts.

An ensemble of many deep trees holds the smaller ones of the same settings: the
first trees of a boosted sequence or a forest, and every tree cut at a depth.
They are all scored in one pass over the points, so a search fits each learner
once for all its numbers of trees and, where trees do not build on each other,
for all its depths.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.base import Model
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorespark.session import new_path


@dataclass(frozen=True)
class Size:
    """The first ``trees`` trees, cut at ``depth``."""

    trees: int
    depth: int


@dataclass(frozen=True)
class Trees:
    """Nodes of all trees; those of tree i start at ``starts[i]`` with its root, children stand behind their parent."""

    starts: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray  # place of the child among all nodes, -1 for a leaf
    right: np.ndarray
    depth: np.ndarray
    value: np.ndarray  # share of label 1 among the rows of the node, or what it adds
    weights: np.ndarray
    votes: bool  # shares are averaged, else values are added with the weights of their trees

    @classmethod
    def of(cls, spark: SparkSession, model: Model) -> Trees:
        """The nodes as the model's own files hold them; they are as large as the model, which the driver has already."""
        path = new_path(spark, "model")
        model.write().save(path)
        data = spark.read.parquet(f"{path}/data")
        if "nodeData" in data.columns:
            data = data.select("treeID", "nodeData.*")
        else:
            data = data.select(F.lit(0).alias("treeID"), "*")
        fields = ["treeID", "id", "prediction", "impurityStats", "leftChild", "rightChild", "split.featureIndex", "split.leftCategoriesOrThreshold"]
        rows = sorted(data.select(*fields).collect(), key=lambda r: (r[0], r[1]))
        tree = np.array([r[0] for r in rows])
        starts = np.searchsorted(tree, np.arange(tree[-1] + 2))
        shift = starts[tree]
        left, right = (np.array([r[k] for r in rows]) for k in (4, 5))
        leaf = left < 0
        depth = np.zeros(len(rows), np.int64)
        for i in np.flatnonzero(~leaf):  # parents first
            depth[[shift[i] + left[i], shift[i] + right[i]]] = depth[i] + 1
        votes = not model.__class__.__name__.startswith("GBT")
        value = [r[3][1] / (sum(r[3]) or 1.0) if votes else r[2] for r in rows]
        return cls(
            starts,
            np.array([r[6] for r in rows]),
            np.array([r[7][0] if r[7] else 0.0 for r in rows]),
            np.where(leaf, -1, left + shift),
            np.where(leaf, -1, right + shift),
            depth,
            np.array(value),
            np.array(getattr(model, "treeWeights", [1.0])),
            votes,
        )

    def cut(self, depth: int) -> np.ndarray:
        """Which nodes are leaves when trees end at ``depth``: sibling leaves of one prediction are merged, as in training."""
        leaf = (self.left < 0) | (self.depth >= depth)
        if self.votes:
            label = self.value > 0.5
            for i in np.flatnonzero(~leaf)[::-1]:
                a, b = self.left[i], self.right[i]
                leaf[i] = leaf[a] and leaf[b] and label[a] == label[b]
        return leaf

    def predictions(self, points: np.ndarray, sizes: Sequence[Size]) -> np.ndarray:
        """Predicted labels, a row for each of ``sizes``."""
        out = np.zeros((len(sizes), len(points)), bool)
        for depth in {s.depth for s in sizes}:
            leaf = self.cut(depth)
            wanted = [(i, min(s.trees, len(self.starts) - 1)) for i, s in enumerate(sizes) if s.depth == depth]
            total = np.zeros(len(points))
            for t in range(max(n for _, n in wanted)):
                node = np.full(len(points), self.starts[t])
                while len(at := np.flatnonzero(~leaf[node])):
                    own = node[at]
                    node[at] = np.where(points[at, self.feature[own]] <= self.threshold[own], self.left[own], self.right[own])
                total += self.value[node] * (1.0 if self.votes else self.weights[t])
                for i, n in wanted:
                    if n == t + 1:
                        out[i] = total > (n / 2 if self.votes else 0.0)
        return out


def accuracies(trees: Trees, points: DataFrame, sizes: Sequence[Size]) -> list[float]:
    """Accuracy of each of ``sizes`` over weighted ``points`` (features, label, weight); sums are made where the points are."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        right, total = np.zeros(len(sizes)), 0.0
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column("x").flatten().to_numpy().reshape(batch.num_rows, -1)
            label, weight = (batch.column(c).to_numpy().astype(float) for c in ("label", "weight"))
            right += (trees.predictions(x, sizes) == (label == 1)) @ weight
            total += weight.sum()
        yield pa.RecordBatch.from_arrays([pa.array(range(len(sizes)), pa.int32()), pa.array(right), pa.array(np.full(len(sizes), total))], ["size", "correct", "total"])

    rows = points.select(vector_to_array("features").alias("x"), F.col("label").cast("int").alias("label"), F.col("weight").cast("double").alias("weight"))
    found = rows.mapInArrow(sums, "size int, correct double, total double").groupBy("size").agg(F.sum("correct").alias("correct"), F.sum("total").alias("total"))
    by = {r["size"]: r["correct"] / r["total"] if r["total"] else 0.0 for r in found.collect()}
    return [by.get(i, 0.0) for i in range(len(sizes))]
