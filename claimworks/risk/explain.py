"""Attribution to percentages, driver, text, and the fallbacks around scoring."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimworks import fixed_values as fv
from claimworks.operators.adjudicate import literal_map


def truncated_score(probability: Column) -> Column:
    return (probability * 100).cast("int")


def percentages(df: DataFrame, contributions: str = "contributions") -> DataFrame:
    """Adds ``percent``: absolute shares in one decimal that add up to 100.

    The rounding residual goes to the largest share, the first one on a tie; with no
    attribution at all the shares are even.  Built in steps, so each value is computed once per
    row, and term by term: functions over arrays would be interpreted for every row.
    """
    n = len(fv.FEATURES)

    def total(names: list[str]) -> Column:
        return sum((F.col(c) for c in names), F.lit(0.0))

    size, share = [f"_abs{i}" for i in range(n)], [f"_pct{i}" for i in range(n)]
    sizes = {c: F.abs(F.get(contributions, F.lit(i))) for i, c in enumerate(size)}
    even = F.bround(F.lit(100.0 / n), 1)
    shares = {
        p: F.when(F.col("_total") == 0, even).otherwise(
            F.bround(F.try_divide(F.col(c), F.col("_total")) * 100, 1)
        )
        for c, p in zip(size, share)
    }
    top = F.lit(None).cast("int")
    for i in reversed(range(n)):
        top = F.when(F.col(share[i]) == F.col("_largest"), i).otherwise(top)
    out = [
        F.when(F.col("_top") == i, F.bround(F.col(c) + F.col("_residual"), 1)).otherwise(F.col(c))
        for i, c in enumerate(share)
    ]
    return (
        df.withColumns(sizes)
        .withColumn("_total", total(size))
        .withColumns(shares)
        .withColumns(
            {"_residual": F.bround(F.lit(100.0) - total(share), 1), "_largest": F.greatest(*share)}
        )
        .withColumn("_top", top)
        .withColumn("percent", F.when(F.col(contributions).isNotNull(), F.array(*out)))
        .drop(*size, *share, "_total", "_residual", "_largest", "_top")
    )


def basis_map(percent: Column) -> Column:
    return F.map_from_arrays(F.array(*[F.lit(f) for f in fv.FEATURES]), percent)


def basis_json(percent: Column) -> Column:
    return F.to_json(F.struct(*[percent[i].alias(f) for i, f in enumerate(fv.FEATURES)]))


def driver(percent: Column) -> tuple[Column, Column]:
    """(label, weight): the largest share, first in feature order on a tie."""
    weight = F.array_max(percent)
    name = F.element_at(
        F.array(*[F.lit(f) for f in fv.FEATURES]), F.array_position(percent, weight).cast("int")
    )
    return F.try_element_at(literal_map(fv.DRIVER_LABELS), name), weight


def explain(df: DataFrame, version: str = "additive", claim_id: str = "claim_id") -> DataFrame:
    """Score, review flag, driver, text and basis for scored rows.

    Reads ``probability`` (NULL when the model failed), ``contributions``, ``errors``
    (first validation errors, empty when valid) and ``can_validate``.  The two
    compliance constants and the review rule never depend on the model.
    """
    steps = percentages(df).withColumn("_score", truncated_score(F.col("probability")))
    label, weight = driver(F.col("percent"))
    steps = steps.withColumns({"_label": label, "_weight": F.bround(weight, 0).cast("int")})

    unavailable = ~F.col("can_validate")
    invalid = F.size("errors") > 0
    failed = F.col("_score").isNull()

    def pick(when_unavailable, when_invalid, when_failed, normal) -> Column:
        def column(x):
            return x if isinstance(x, Column) else F.lit(x)

        return (
            F.when(unavailable, column(when_unavailable))
            .when(invalid, column(when_invalid))
            .when(failed, column(when_failed))
            .otherwise(column(normal))
        )

    # printf gives "null" for a NULL argument, so only real scores reach the templates.
    text_args = (F.col("_score"), F.col("_label"), F.col("_weight"))
    text = F.when(
        F.col("_score") >= fv.REVIEW_SCORE, F.printf(F.lit(fv.EXPLAIN_REVIEW), *text_args)
    ).otherwise(F.printf(F.lit(fv.EXPLAIN_BELOW), *text_args))
    features = F.array(*[F.col(f) for f in fv.FEATURES])
    no_vector = F.array().cast("array<double>")
    return (
        steps.withColumn(
            "denial_risk_score",
            pick(fv.SCORE_UNAVAILABLE, fv.SCORE_INVALID, fv.SCORE_MODEL_ERROR, F.col("_score")),
        )
        .withColumns(
            {
                "human_review_required": F.col("denial_risk_score") >= fv.REVIEW_SCORE,
                "provider_explanation": pick(
                    fv.EXPLAIN_UNAVAILABLE,
                    F.printf(F.lit(fv.EXPLAIN_INVALID), F.col(claim_id), F.get("errors", F.lit(0))),
                    F.printf(F.lit(fv.EXPLAIN_MODEL_ERROR), F.col(claim_id)),
                    text,
                ),
                "ai_decision_only": F.lit(False),
                "reconsideration_right": F.lit(True),
                "primary_driver": pick(
                    fv.DRIVER_UNAVAILABLE, fv.DRIVER_INVALID, fv.DRIVER_MODEL_ERROR, F.col("_label")
                ),
                "primary_driver_weight": pick(
                    "", "100%", "100%", F.concat(F.col("_weight").cast("string"), F.lit("%"))
                ),
                "decision_basis": pick(
                    fv.BASIS_UNAVAILABLE, fv.BASIS_INVALID, fv.BASIS_MODEL_ERROR,
                    basis_json(F.col("percent")),
                ),
                "model_version": pick("none", "none", "error", version),
                "feature_vector": pick(no_vector, no_vector, no_vector, features),
            }
        )
        .drop("_score", "_label", "_weight")
    )
