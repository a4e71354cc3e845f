"""FHIR claim validation as ordered error lists, and the claim-processing split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimworks import fixed_values as fv
from claimworks.functions import variants as vj
from claimworks.functions.scalars import npi_is_valid
from claimworks.operators import adjudicate as adj
from claimworks.operators import fhir
from claimworks.operators.eligibility import check_eligibility


NPI = "provider.identifier.value"


# What a filled field normally holds, so the common case is one lookup.
CHILDREN = {
    "patient": ".reference", "provider": ".identifier", "total": ".value",
    "type": ".coding", "insurer": ".identifier", "priority": ".coding",
}


def _filled(name: str) -> Column:
    return vj.truthy(fhir.CLAIM, name, CHILDREN.get(name, "[0]"))


def can_validate() -> Column:
    """False where a present field has a type the rules cannot look into."""
    v = fhir.CLAIM
    npi_readable = (vj.kind(v, NPI) == "STRING") | ~vj.truthy(v, NPI)
    return (
        F.col("is_object")
        & vj.is_object_or_absent(v, "total", "value")
        & vj.is_object_or_absent(v, "provider", "identifier")
        & vj.is_object_or_absent(v, "provider.identifier", "value")
        & npi_readable
    )


def _errors() -> list[Column]:
    """The error texts in order, NULL where the claim is right; no two rules give the same text."""
    v = fhir.CLAIM
    numeric = vj.kind(v, "total.value").isin("BIGINT", "DECIMAL", "DOUBLE", "FLOAT", "BOOLEAN")
    positive = F.coalesce(numeric & (vj.get(v, "total.value", "double") > 0), F.lit(False))
    npi = F.col("npi")
    missing = [
        F.when(~_filled(name), f"missing_required_field:{name}")
        for name in fv.REQUIRED_FIELDS
    ]
    wrong_type = F.coalesce(vj.text(v, "resourceType"), F.lit("")) != "Claim"
    return [
        *missing,
        F.when(wrong_type, "wrong_resource_type"),
        F.when(~_filled("diagnosis"), "empty_diagnosis_array"),
        F.when(~_filled("item"), "empty_item_array"),
        F.when(~positive, "invalid_total_value"),
        F.when(
            (F.coalesce(npi, F.lit("")) != "") & ~npi_is_valid(npi),
            F.concat(F.lit("invalid_billing_npi:"), npi),
        ),
    ]


def error_list() -> Column:
    """Ordered error texts; an empty array is a valid claim.

    NULLs leave by ``array_except``, which is compiled with the rules; a filter over the array would
    interpret every rule for every claim.
    """
    return F.array_except(F.array(*_errors()), F.array(F.lit(None).cast("string")))


def first_error() -> Column:
    """The first error text; NULL for a valid claim."""
    return F.coalesce(*_errors())


def missing_fields() -> Column:
    """Names of the mapped fields that are missing or empty."""
    return F.array_compact(F.array(*[F.when(~_filled(f), f) for f in fv.MAPPED_FIELDS]))


def validated(claims: DataFrame, json: str = "fhir_json") -> DataFrame:
    """Claims plus ``v, is_object, can_validate, errors, is_valid``."""
    return (
        fhir.with_variant(claims, json)
        .withColumn("can_validate", can_validate())
        .withColumn("errors", F.when(F.col("can_validate"), error_list()))
        .withColumn("is_valid", F.col("can_validate") & (F.size("errors") == 0))
    )


def checked_claims(claims: DataFrame, json: str = "fhir_json") -> DataFrame:
    """``claim_id, reason, errors`` of every claim that can be validated, valid and rejected, in one pass."""
    # The filter does not read the errors, which would be computed for it once more.
    rows = fhir.with_variant(claims, json).where(can_validate()).withColumn("errors", error_list())
    invalid = F.size("errors") > 0
    return rows.select(
        F.when(invalid, vj.text(fhir.CLAIM, "id", "UNKNOWN")).otherwise(F.col("claim_id")).alias("claim_id"),
        F.when(invalid, "validation_failed").otherwise("valid").alias("reason"),
        "errors",
    )


def split_valid(claims: DataFrame, json: str = "fhir_json") -> tuple[DataFrame, DataFrame]:
    """(valid, rejected); both sides filter the same lazily parsed claims."""
    checked = validated(claims, json)
    rejected = checked.where(F.col("can_validate") & ~F.col("is_valid")).select(
        vj.text(fhir.CLAIM, "id", "UNKNOWN").alias("claim_id"),
        F.lit("validation_failed").alias("reason"),
        "errors",
    )
    return checked.where("is_valid").select(*claims.columns), rejected


def _message(*names: str) -> Column:
    return F.to_json(F.struct(*names), {"ignoreNullFields": "false"})


def process_messages(
    messages: DataFrame,
    enrollment: DataFrame,
    as_of=None,
    fees: dict[str, float] | None = None,
    json: str = "value",
    keep: list[str] | None = None,
    keep_failed: list[str] | None = None,
) -> DataFrame:
    """One outcome row per raw claim message: ``topic, key, value, outcome``, ``keep``, and ``keep_failed``,
    which only a failed message keeps: a message's text does not go through the join for nothing.

    Validation rejects and ineligible claims go to the rejected topic, the rest is
    adjudicated and goes to the remittance topic.  A message that cannot be read has
    the outcome ``failed`` and no topic.  Each message makes exactly one row, so the
    same projection serves a batch and a stream.
    """
    keep = keep or []
    checked = validated(messages, json)
    columns = fhir.adjudication_columns(as_of)
    of_failed = [F.when(~F.col("can_validate"), F.col(n)).alias(n) for n in keep_failed or []]
    claims = checked.select(
        *keep, *of_failed, "can_validate", "is_valid", "errors",
        *[c.alias(n) for n, c in columns.items()],
    )
    joined = check_eligibility(claims, enrollment)
    keep = [*keep, *(keep_failed or [])]
    state = ["can_validate", "is_valid", "errors", "eligible", "eligibility_reason", *keep]
    decided = adj.decide(joined, as_of, fees, keep=state).withColumns(
        {n: F.col(n).cast("double") for n in ("billed_amount", "paid_amount", "cas_amount")}
    )
    outcome = (
        F.when(~F.col("can_validate"), "failed")
        .when(~F.col("is_valid"), "rejected_validation")
        .when(~F.col("eligible"), "rejected_eligibility")
        .otherwise(F.col("status"))
    )
    invalid = F.to_json(
        F.struct("claim_id", F.lit("validation_failed").alias("reason"), "errors"),
        {"ignoreNullFields": "false"},
    )
    ineligible = F.to_json(
        F.struct(
            "claim_id", F.lit("eligibility_failed").alias("reason"), "eligibility_reason",
            "member_id",
        )
    )
    record = _message(*adj.REMITTANCE_KEYS)
    return decided.withColumn("outcome", outcome).select(
        F.when(F.col("outcome").isin("paid", "denied"), fv.TOPIC_REMITTANCE)
        .when(F.col("outcome") != "failed", fv.TOPIC_REJECTED)
        .alias("topic"),
        F.col("claim_id").alias("key"),
        F.when(F.col("outcome") == "rejected_validation", invalid)
        .when(F.col("outcome") == "rejected_eligibility", ineligible)
        .when(F.col("outcome") != "failed", record)
        .alias("value"),
        "outcome",
        *keep,
    )


def run_statistics(outcomes: DataFrame) -> DataFrame:
    """Counts of a run in one row."""
    outcome = F.col("outcome")
    return outcomes.agg(
        F.count_if(outcome.isin("paid", "denied")).alias("processed"),
        F.count_if(outcome == "paid").alias("paid"),
        F.count_if(outcome == "denied").alias("denied"),
        F.count_if(outcome.startswith("rejected")).alias("rejected"),
        F.count_if(outcome == "failed").alias("failed"),
    )
