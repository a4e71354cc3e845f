"""Attribution of tree models by the paths of their trees, weighted by how many training rows went each way."""

from __future__ import annotations

import sys
from math import factorial, inf

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.feature import Bucketizer, StandardScalerModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from claimworks import fixed_values as fv
from claimworks.session import scratch_dir


# Functions sent to executors travel by value, so executors need no copy of this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Leaves of all trees with the same number of features on their path: features (leaf, place), low and high (a
# row follows the path in a feature if low < x <= high) and shares (leaf, pattern, place): what a row gains from
# each feature, by which features it follows.
Leaves = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def node_table(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """tree, id, left, right, feature, threshold, cover, value: one row per node of a fitted forest.

    ``cover`` is the weight of the training rows at the node, ``value`` the share of the positive class there.
    """
    forest = model.stages[-1]
    if not isinstance(forest, RandomForestClassificationModel):
        raise ValueError("only a forest adds up its trees' probabilities")
    path = scratch_dir(spark, "forest")
    forest.write().overwrite().save(path)
    stats = F.col("nodeData.impurityStats")
    cover = F.aggregate(stats, F.lit(0.0), lambda a, x: a + x)
    return spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), F.col("nodeData.id").alias("id"), F.col("nodeData.leftChild").alias("left"),
        F.col("nodeData.rightChild").alias("right"), F.col("nodeData.split.featureIndex").alias("feature"),
        F.get("nodeData.split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"),
        cover.alias("cover"), (F.get(stats, F.lit(1)) / cover).alias("value"),
    )


def paths(nodes: DataFrame) -> tuple[list[tuple[dict, float]], float]:
    """Per leaf {feature: [low, high, fraction]} and its share of the probability; the mean over training rows.

    ``fraction`` is the part of the training rows that follows the path at the splits on the feature.
    A model is of fixed size, so its nodes fit the driver.
    """
    trees: dict = {}
    for row in nodes.collect():
        trees.setdefault(row.tree, {})[row.id] = row
    found, mean = [], 0.0
    for tree in trees.values():
        stack = [(tree[0], {}, 1.0)]
        while stack:
            node, held, reach = stack.pop()
            if node.left < 0:
                found.append((held, node.value / len(trees)))
                mean += reach * node.value / len(trees)
                continue
            for child, side in ((tree[node.left], 1), (tree[node.right], 0)):
                low, high, fraction = held.get(node.feature, (-inf, inf, 1.0))
                part = child.cover / node.cover
                bounds = (low, min(high, node.threshold)) if side else (max(low, node.threshold), high)
                stack.append((child, held | {node.feature: (*bounds, fraction * part)}, reach * part))
    return found, mean


def gains(fractions: np.ndarray, values: np.ndarray) -> np.ndarray:
    """(leaf, pattern, place): the value each feature of a path adds, for every set of features that a row follows.

    A feature's share is a sum over the subsets of the others, by size; the sums over all subsets of one
    size come from one polynomial per feature, so the work grows with the cube of the path, not with its subsets.
    """
    leaves, m = fractions.shape
    follows = (np.arange(1 << m)[:, None] >> np.arange(m)) & 1
    one = np.broadcast_to(follows[None], (leaves, 1 << m, m)).astype(float)
    zero = np.broadcast_to(fractions[:, None, :], one.shape)
    out = np.empty(one.shape)
    for i in range(m):
        sums = np.zeros((leaves, 1 << m, m))
        sums[..., 0] = 1.0
        for j in range(m):
            if j != i:
                grown = sums * zero[..., j:j + 1]
                grown[..., 1:] += sums[..., :-1] * one[..., j:j + 1]
                sums = grown
        weights = np.array([factorial(k) * factorial(m - 1 - k) / factorial(m) for k in range(m)])
        out[..., i] = (sums * weights).sum(-1) * (one[..., i] - zero[..., i])
    return out * values[:, None, None]


def leaf_tables(found: list[tuple[dict, float]]) -> list[Leaves]:
    out = []
    for m in sorted({len(path) for path, _ in found if path}):
        same = [(sorted(path.items()), value) for path, value in found if len(path) == m]
        column = lambda k: np.array([[bounds[k] for _, bounds in path] for path, _ in same])
        values = np.array([value for _, value in same])
        features = np.array([[feature for feature, _ in path] for path, _ in same])
        out.append((features, column(0), column(1), gains(column(2), values)))
    return out


def explain_rows(x: np.ndarray, tables: list[Leaves], features: int) -> np.ndarray:
    """(row, feature): contributions of scaled feature rows."""
    total = np.zeros((features, len(x)))
    columns = np.ascontiguousarray(x.T)
    for used, low, high, shares in tables:
        for leaf, places in enumerate(used.tolist()):
            pattern = np.zeros(len(x), np.int64)
            for j, f in enumerate(places):
                pattern |= ((columns[f] > low[leaf, j]) & (columns[f] <= high[leaf, j])).astype(np.int64) << j
            for j, f in enumerate(places):
                total[f] += shares[leaf, :, j][pattern]
    return total.T


class TreeExplainer:
    """Path-dependent attribution of a forest pipeline: contributions add up to probability minus ``mean``.

    Absent features follow both ways of a split in the proportion of the training rows.  Rows with a null
    feature get null contributions.  Only the leaves' tables travel; rows stay where they are.
    """

    def __init__(self, spark: SparkSession, model: PipelineModel):
        found, self.mean = paths(node_table(spark, model))
        scaler = next((s for s in model.stages if isinstance(s, StandardScalerModel)), None)
        self.binner = next((s for s in model.stages if isinstance(s, Bucketizer)), None)
        n = len(fv.FEATURES)
        self.shift = np.array(scaler.mean.toArray()) if scaler else np.zeros(n)
        std = np.array(scaler.std.toArray()) if scaler else np.ones(n)
        self.scale = np.divide(1.0, std, out=np.zeros(n), where=std != 0)
        self.tables = leaf_tables(found)

    def contributions(self, df: DataFrame) -> DataFrame:
        """``df`` with the array column ``contributions``, in the order of the features."""
        shipped = df.sparkSession.sparkContext.broadcast((self.tables, self.shift, self.scale))
        names, count = df.columns, len(fv.FEATURES)
        inner = [f"c{i}" for i in range(len(names))]
        raw = [F.col(f"`{f}`").cast("double") for f in fv.FEATURES]
        # Trees over bins see a row's bins; a null has a bin of its own there, but no contributions.
        seen = raw if self.binner is None else [
            F.when(x.isNotNull(), F.col(b)) for x, b in zip(raw, self.binner.getOutputCols())
        ]
        features = [x.alias(f"x{i}") for i, x in enumerate(seen)]
        schema = df.toDF(*inner).schema.add("contributions", ArrayType(DoubleType()))

        def task(batches):
            tables, shift, scale = shipped.value
            for batch in batches:
                x = np.column_stack([batch.column(len(inner) + i).to_numpy(zero_copy_only=False) for i in range(count)])
                known = ~np.isnan(x).any(1)
                found = np.full(x.shape, np.nan)
                found[known] = explain_rows((x[known] - shift) * scale, tables, count)
                lists = pa.FixedSizeListArray.from_arrays(pa.array(found.ravel()), count).cast(pa.list_(pa.float64()))
                lists = pa.compute.if_else(pa.array(known), lists, pa.scalar(None, lists.type))
                yield pa.RecordBatch.from_arrays([*batch.columns[:len(inner)], lists], schema.names)

        placed = df if self.binner is None else self.binner.transform(df)
        rows = placed.select(*[F.col(f"`{c}`").alias(i) for c, i in zip(names, inner)], *features)
        return rows.mapInArrow(task, schema).toDF(*names, "contributions")
