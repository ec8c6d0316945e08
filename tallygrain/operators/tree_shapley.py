"""Exact Shapley values of tree ensembles.

A tree is the sum of its leaves. Given that the features of a set S are known, a leaf counts as far as
the known features agree with its path, and for each unknown one by the share of training rows
that go the leaf's way. A leaf on whose path m different features are asked for thus is a product of m
factors: 1 or 0 for a known feature, the share z for an unknown one. Its Shapley value for feature j is

    value * (o_j - z_j) * integral over t from 0 to 1 of the product over k != j of (z_k (1 - t) + o_k t),

as the weight s! (m - 1 - s)! / m! of sets of size s is the integral of t^s (1 - t)^(m - 1 - s). The
integrand has degree m - 1, so Gauss-Legendre quadrature with ceil(m / 2) nodes is exact. The work is
quadratic in the length of a path, whatever the number of feature sets.

Leaves are few: they travel with the function. Rows are scored where they are, in batches.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.cloudpickle import cloudpickle
from pyspark.ml import PipelineModel
from pyspark.ml.classification import DecisionTreeClassificationModel, GBTClassificationModel, RandomForestClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygrain.operators.encode import feature_names
from tallygrain.session import scratch_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ENSEMBLES = (GBTClassificationModel, RandomForestClassificationModel)
TREES = (*ENSEMBLES, DecisionTreeClassificationModel)


@dataclass
class Leaf:
    """A leaf's value and, for each feature on its path, the share of rows that go its way and which values do."""

    value: float
    features: np.ndarray
    shares: np.ndarray
    low: np.ndarray  # above this
    high: np.ndarray  # up to this
    categories: dict[int, frozenset]  # by place on the path, for features with categories

    def agrees(self, x: np.ndarray) -> np.ndarray:
        """(rows, features): whether a row's value goes the leaf's way. A missing value goes right."""
        at = x[:, self.features]
        out = ~(at <= self.low) & ((at <= self.high) | np.isinf(self.high))
        for k, allowed in self.categories.items():
            out[:, k] = np.isin(at[:, k], list(allowed))
        return out


def leaves(model) -> list[Leaf]:
    """The leaves of a fitted Spark ML tree model, read from the table that the model is saved as.

    Boosting: a leaf counts with its tree's weight, the sum is the raw margin of class 1. Forest and
    tree: the mean share of class 1 over the trees, which is the probability.
    """
    if not isinstance(model, TREES):
        raise ValueError("exact attributions need a tree model")
    spark = SparkSession.active()
    path = scratch_path(spark, "trees")
    model.write().save(path)
    data = spark.read.parquet(f"{path}/data")
    if isinstance(model, ENSEMBLES):
        rows = data.select("treeID", "nodeData.*").collect()
        weights = list(model.treeWeights) if isinstance(model, GBTClassificationModel) else [1.0 / model.getNumTrees] * model.getNumTrees
    else:
        rows, weights = data.selectExpr("0 as treeID", "*").collect(), [1.0]
    trees: dict[int, dict[int, object]] = {}
    for r in rows:
        trees.setdefault(r["treeID"], {})[r["id"]] = r
    boosted = isinstance(model, GBTClassificationModel)
    found = []
    for t, nodes in trees.items():
        found += _walked(nodes, weights[t], boosted)
    return found


def _walked(nodes: dict, weight: float, boosted: bool) -> list[Leaf]:
    out = []
    cover = {i: (n["rawCount"] if n["rawCount"] > 0 else (n["impurityStats"][0] if boosted else sum(n["impurityStats"]))) for i, n in nodes.items()}
    todo: list[tuple[int, dict]] = [(0, {})]
    while todo:
        i, way = todo.pop()
        node = nodes[i]
        if node["leftChild"] < 0:
            value = node["prediction"] if boosted else node["impurityStats"][1] / sum(node["impurityStats"])
            places = list(way)
            out.append(Leaf(
                weight * value, np.array(places, np.int64), np.array([way[f][0] for f in places], np.float64), np.array([way[f][1] for f in places], np.float64),
                np.array([way[f][2] for f in places], np.float64), {k: way[f][3] for k, f in enumerate(places) if way[f][3] is not None},
            ))
            continue
        feature, cuts, kinds = node["split"]["featureIndex"], node["split"]["leftCategoriesOrThreshold"], node["split"]["numCategories"]
        share, low, high, allowed = way.get(feature, (1.0, -np.inf, np.inf, None))
        for child, left in ((node["leftChild"], True), (node["rightChild"], False)):
            part = share * cover[child] / cover[i]
            if kinds < 0:
                step = (part, low, min(high, cuts[0]), allowed) if left else (part, max(low, cuts[0]), high, allowed)
            else:
                chosen = frozenset(cuts) if left else frozenset(float(k) for k in range(kinds)) - frozenset(cuts)
                step = (part, low, high, chosen if allowed is None else allowed & chosen)
            todo.append((child, {**way, feature: step}))
    return out


def attributions(x: np.ndarray, found: list[Leaf]) -> np.ndarray:
    """(rows, features): Shapley values of the sum of the leaves."""
    out = np.zeros(x.shape)
    nodes: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for leaf in found:
        m = len(leaf.features)
        if not m or not leaf.value:
            continue
        n = (m + 1) // 2
        if n not in nodes:
            t, w = np.polynomial.legendre.leggauss(n)
            nodes[n] = ((t + 1) / 2, w / 2)
        agrees = leaf.agrees(x).astype(np.float64)
        total = np.zeros(agrees.shape)
        for t, w in zip(*nodes[n], strict=True):
            factors = leaf.shares * (1 - t) + agrees * t
            total += w * factors.prod(axis=1, keepdims=True) / factors
        out[:, leaf.features] += leaf.value * (agrees - leaf.shares) * total
    return out


def base_value(found: list[Leaf]) -> float:
    """What the model says of a row of which nothing is known."""
    return float(sum(leaf.value * leaf.shares.prod() for leaf in found))


def margins(x: np.ndarray, found: list[Leaf]) -> np.ndarray:
    return sum((leaf.value * leaf.agrees(x).all(axis=1) for leaf in found), np.zeros(len(x)))


def tree_shapley(model: PipelineModel, df: DataFrame, key: str, features: str = "features") -> DataFrame:
    """(key, feature, shapley, base, margin): exact attributions of every row of ``df``.

    ``model`` is a pipeline whose last stage is a tree model. Over the features of a row, base plus
    all shapley equals margin: of boosting the raw score of class 1 (the probability is
    1 / (1 + exp(-2 margin))), of a forest the probability. Unknown features are averaged by the training rows that went
    each way. No row is sampled; features that no tree asks for have 0.
    """
    found = leaves(model.stages[-1])
    base = base_value(found)
    ready = PipelineModel(model.stages[:-1]).transform(df)
    names = feature_names(ready, features)
    rows = ready.select(F.col(key), vector_to_array(features).alias("_x"))
    kind = rows.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                column = batch.column("_x")
                offsets = column.offsets.to_numpy()
                x = column.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]].reshape(batch.num_rows, -1)
                values = attributions(x, found)
                yield pa.RecordBatch.from_pydict({
                    key: batch.column(key), "_v": pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(values.ravel())),
                    "margin": pa.array(margins(x, found)),
                })

    scored = rows.mapInArrow(run, f"`{key}` {kind}, _v array<double>, margin double")
    labels = F.array(*[F.lit(n) for n in names]) if names else F.array()
    return scored.select(key, "margin", F.posexplode("_v").alias("_i", "shapley")).select(
        key, (F.get(labels, F.col("_i")) if names else F.concat(F.lit("feature_"), F.col("_i"))).alias("feature"), "shapley", F.lit(base).alias("base"), "margin"
    )
