"""Model inputs read from claim JSON."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimworks import fixed_values as fv
from claimworks.functions import variants as vj
from claimworks.operators import fhir
from claimworks.operators.eligibility import check_eligibility, today


def claim_features() -> dict[str, Column]:
    """The four inputs both paths share, from the parsed claim."""
    v = fhir.CLAIM
    billed = F.when(~vj.present(v, "total.value"), F.lit(0.0)).otherwise(
        vj.get(v, "total.value", "double")
    )
    return {
        "billed_amount": billed,
        "prior_auth": F.when(vj.truthy(v, "_prior_auth"), 1.0).otherwise(0.0),
        "diagnosis_code_count": vj.length(v, "diagnosis").cast("double"),
        "procedure_complexity": vj.length(v, "item").cast("double"),
    }


def batch_features() -> dict[str, Column]:
    """Batch path: specialty and days are constants."""
    return {
        **claim_features(),
        "provider_specialty_code": F.lit(fv.BATCH_SPECIALTY),
        "days_since_service": F.lit(fv.BATCH_DAYS),
    }


def stream_features(
    messages: DataFrame, enrollment: DataFrame, as_of=None, json: str = "value"
) -> DataFrame:
    """Streaming path: the last two slots hold the eligibility flag and 0.

    A message the path cannot read gets the fixed fallback vector.
    """
    v = fhir.CLAIM
    reference = vj.get(v, "patient.reference")
    own = [c for c in messages.columns]
    parsed = fhir.with_variant(messages, json)
    shared = claim_features()
    readable = (
        F.col("is_object")
        & vj.is_object_or_absent(v, "patient", "reference")
        & (reference.isNull() | (vj.kind(v, "patient.reference") == "STRING"))
        & vj.is_object_or_absent(v, "total", "value")
        & F.col("_billed_amount").isNotNull()
        & F.col("_diagnosis_code_count").isNotNull()
        & F.col("_procedure_complexity").isNotNull()
    )
    staged = parsed.select(
        *own,
        *v.columns,
        "is_object",
        F.replace(vj.text(v, "patient.reference", ""), F.lit("Patient/"), F.lit("")).alias(
            "member_id"
        ),
        today(as_of).alias("_as_of"),
        *[c.alias(f"_{n}") for n, c in shared.items()],
    ).withColumn("_readable", F.coalesce(readable, F.lit(False)))
    joined = check_eligibility(staged.drop(*v.columns, "is_object"), enrollment, dos="_as_of")
    values = [
        *[F.col(f"_{n}") for n in shared],
        F.when(F.col("eligible"), 1.0).otherwise(0.0),
        F.lit(0.0),
    ]
    return joined.select(
        *own,
        *[
            F.when(F.col("_readable"), value).otherwise(F.lit(fallback)).alias(name)
            for name, value, fallback in zip(fv.FEATURES, values, fv.STREAM_FALLBACK_FEATURES)
        ],
    )


def assembler(output: str = "raw_features") -> VectorAssembler:
    return VectorAssembler(inputCols=fv.FEATURES, outputCol=output, handleInvalid="keep")
