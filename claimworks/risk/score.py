"""Scorers: each adds ``probability`` and, on request, ``contributions``."""

from __future__ import annotations

import re
from math import factorial, inf

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.feature import Bucketizer, StandardScalerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimworks import fixed_values as fv
from claimworks.risk.trees import TreeExplainer

# --- fixed values: the label formula, in percent points ---
ADDITIVE_POINTS = {
    "billed_amount": 50,
    "prior_auth": 35,
    "diagnosis_code_count": 10,
    "days_since_service": 5,
}
# Means of the training distributions; the reference point attributions start from.
BASELINE = [1025.0, 0.7, 5.5, 3.0, 10.5, 90.0]


SPLIT = re.compile(r"If \(feature (\d+) <= ([^)]+)\)")


def _hit(name: str) -> Column:
    value = F.col(name)
    return {
        "billed_amount": value > 800,
        "prior_auth": value == 0,
        "diagnosis_code_count": value > 5,
        "days_since_service": value > 90,
    }[name]


class AdditiveScorer:
    """The formula the training labels are drawn from, with closed-form attributions.

    Each term depends on one feature, so its Shapley value against an all-clear claim
    is the term itself.
    """

    version = "additive"

    def points(self) -> dict[str, Column]:
        return {
            name: F.when(_hit(name), points).otherwise(0)
            for name, points in ADDITIVE_POINTS.items()
        }

    def score(self, df: DataFrame) -> DataFrame:
        total = sum(self.points().values(), F.lit(0))
        return df.withColumn("probability", total / F.lit(100.0))

    def attribute(self, df: DataFrame, key: str = "claim_id") -> DataFrame:
        points = self.points()
        terms = [points[f].cast("double") if f in points else F.lit(0.0) for f in fv.FEATURES]
        return self.score(df).withColumn("contributions", F.array(*terms))


def probability_of(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Adds the denial probability; the model's own columns are dropped."""
    scored = model.transform(df)
    added = [c for c in scored.columns if c not in df.columns]
    return scored.withColumn("_p", vector_to_array("probability")[1]).drop(*added).withColumnRenamed(
        "_p", "probability"
    )


def coalition_weights(n: int) -> list[list[float]]:
    """``w[i][mask]``: factor of f(mask) in the Shapley value of player i."""
    def share(size: int) -> float:
        return factorial(size) * factorial(n - size - 1) / factorial(n)

    return [
        [
            share(mask.bit_count() - 1) if mask >> i & 1 else -share(mask.bit_count())
            for mask in range(1 << n)
        ]
        for i in range(n)
    ]


def split_points(model: PipelineModel) -> list[list[float]]:
    """Per feature the thresholds of all trees, in the units the trees see."""
    found: list[set[float]] = [set() for _ in fv.FEATURES]
    for feature, threshold in SPLIT.findall(model.stages[-1].toDebugString):
        found[int(feature)].add(float(threshold))
    return [sorted(f) for f in found]


class ModelScorer:
    """A fitted pipeline over the six feature columns.

    A forest is explained by the paths of its trees; boosted trees, whose probability is not a sum over trees,
    and any model given a ``baseline`` claim, by the game against that claim.
    """

    def __init__(
        self, model: PipelineModel, version: str = "v1", baseline: list[float] | None = None
    ) -> None:
        self.model, self.version = model, version
        self.by_paths = baseline is None and isinstance(model.stages[-1], RandomForestClassificationModel)
        self.baseline = BASELINE if baseline is None else baseline
        self._explainer = None

    def explainer(self, spark: SparkSession) -> TreeExplainer:
        if self._explainer is None:
            self._explainer = TreeExplainer(spark, self.model)
        return self._explainer

    def score(self, df: DataFrame) -> DataFrame:
        return probability_of(self.model, df)

    def attribute(self, df: DataFrame, key: str = "claim_id") -> DataFrame:
        """``df``, probability and contributions: Shapley values, exact for either game.

        By paths they add up to probability minus the mean over the training rows; against a baseline to
        f(x) - f(baseline).
        """
        if self.by_paths:
            return self.explainer(df.sparkSession).contributions(self.score(df))
        return self._against_baseline(df)

    def _against_baseline(self, df: DataFrame) -> DataFrame:
        """The game that swaps features for the baseline's.

        Trees do not change between their split points, so rows whose features fall into the same
        intervals have the same values: the game is played once per distinct tuple of intervals,
        and the result joined back.
        """
        rows = self._intervals(df)
        tuples = rows.groupBy("_tuple").agg(F.first(F.struct(*fv.FEATURES)).alias("_x"))
        values = self._game(tuples.select("_tuple", "_x.*"), "_tuple")
        return rows.join(values, "_tuple", "left").select(*df.columns, "probability", "contributions")

    def _intervals(self, df: DataFrame) -> DataFrame:
        """``df`` with ``_tuple``: between which split points of the model each feature lies."""
        scaler = next((s for s in self.model.stages if isinstance(s, StandardScalerModel)), None)
        binner = next((s for s in self.model.stages if isinstance(s, Bucketizer)), None)
        points = split_points(self.model)
        # Splits send x <= t to the left and Bucketizer's bounds belong to the right, so both are negated.
        out = df if binner is None else binner.transform(df)
        seen = fv.FEATURES if binner is None else binner.getOutputCols()
        for i, name in enumerate(seen):
            x = F.col(name).cast("double")
            if scaler is not None:
                std = float(scaler.std[i])
                x = (x - float(scaler.mean[i])) * (1.0 / std if std else 0.0)
            out = out.withColumn(f"_n{i}", -x)
        bounds = [[-inf, *sorted({-t for t in ts}), inf] if ts else [-inf, 0.0, inf] for ts in points]
        n = len(fv.FEATURES)
        found = Bucketizer(
            splitsArray=bounds, inputCols=[f"_n{i}" for i in range(n)], outputCols=[f"_b{i}" for i in range(n)],
            handleInvalid="keep",
        ).transform(out)
        names = [F.col(f"_b{i}").cast("int").cast("string") if points[i] else F.lit("") for i in range(n)]
        return found.select(*df.columns, F.concat_ws(",", *names).alias("_tuple"))

    def _game(self, df: DataFrame, key: str) -> DataFrame:
        """``key, probability, contributions``; every row becomes one row per coalition, which the
        partial aggregation folds back inside the same task."""
        n = len(fv.FEATURES)
        full = (1 << n) - 1
        mask = F.col("_mask")
        mixed = [
            F.when(mask.bitwiseAND(F.lit(1 << i)) != 0, F.col(f))
            .otherwise(F.lit(self.baseline[i]))
            .alias(f)
            for i, f in enumerate(fv.FEATURES)
        ]
        game = probability_of(
            self.model,
            df.withColumn("_mask", F.explode(F.sequence(F.lit(0), F.lit(full)))).select(
                F.col(key).alias("_key"), "_mask", *mixed
            ),
        )
        weights = [
            F.element_at(F.array(*[F.lit(w) for w in row]), mask + 1)
            for row in coalition_weights(n)
        ]
        sums = game.groupBy("_key").agg(
            F.max(F.when(mask == full, F.col("probability"))).alias("probability"),
            *[F.sum(F.col("probability") * w).alias(f"_c{i}") for i, w in enumerate(weights)],
        )
        return sums.select(
            F.col("_key").alias(key), "probability",
            F.array(*[F.col(f"_c{i}") for i in range(n)]).alias("contributions"),
        )


class FailedScorer:
    """Stands in when no model can be loaded: every valid claim gets the error fallback."""

    version = "error"

    def score(self, df: DataFrame) -> DataFrame:
        return df.withColumn("probability", F.lit(None).cast("double"))

    def attribute(self, df: DataFrame, key: str = "claim_id") -> DataFrame:
        none = F.array_repeat(F.lit(0.0), len(fv.FEATURES))
        return self.score(df).withColumn("contributions", none)
