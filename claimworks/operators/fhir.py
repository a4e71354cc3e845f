"""Parsed claims to FHIR claim JSON, and FHIR claim JSON to typed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimworks import fixed_values as fv
from claimworks.functions import variants as vj
from claimworks.functions.scalars import iso_date_text
from claimworks.operators.eligibility import member_of_reference, service_date, today

_CODED = {"coding": [{"code": "string"}]}
#: The variant column of a claim, and what the rules ask of nearly every claim.
CLAIM = vj.Shape(
    "v",
    {
        "resourceType": "string", "id": "string", "status": "string", "created": "string",
        "_prior_auth": "string",
        "patient": {"reference": "variant"},
        "insurer": {"identifier": {"value": "string"}},
        "provider": {"identifier": {"value": "variant"}},
        "diagnosis": ["boolean"],  # of the elements only how many there are
        "item": [{"productOrService": _CODED, "servicedDate": "string"}],
        "total": {"value": "number"},
    },
    texts=("diagnosis[0].diagnosisCodeableConcept.coding[0].code",),
)


# --- parsed claim -> FHIR --------------------------------------------------------


def _coding(system: str, code: Column) -> Column:
    return F.struct(
        F.array(F.struct(F.lit(system).alias("system"), code.alias("code"))).alias("coding")
    )


def fhir_struct(payer_id: str | None = None) -> Column:
    """The claim resource built from the parsed-claim columns, sequences from 1."""
    day = iso_date_text(F.coalesce("date_of_service", F.lit("")))
    usd = F.struct(F.col("billed_amount").alias("value"), F.lit("USD").alias("currency"))
    diagnoses = F.transform(
        "diagnosis_codes",
        lambda code, i: F.struct(
            (i + 1).alias("sequence"),
            _coding(fv.SYSTEM_ICD10, code).alias("diagnosisCodeableConcept"),
        ),
    )
    items = F.transform(
        "procedure_codes",
        lambda code, i: F.struct(
            (i + 1).alias("sequence"),
            _coding(fv.SYSTEM_CPT, code).alias("productOrService"),
            day.alias("servicedDate"),
            usd.alias("unitPrice"),
            usd.alias("net"),
        ),
    )
    identifier = F.struct(
        F.lit(fv.SYSTEM_NPI).alias("system"), F.col("billing_npi").alias("value")
    )
    return F.struct(
        F.lit("Claim").alias("resourceType"),
        F.col("transaction_id").alias("id"),
        F.lit("active").alias("status"),
        _coding(fv.SYSTEM_CLAIM_TYPE, F.lit("professional")).alias("type"),
        F.lit("claim").alias("use"),
        F.struct(
            F.concat(F.lit("Patient/"), F.col("patient_member_id")).alias("reference")
        ).alias("patient"),
        day.alias("created"),
        F.struct(
            F.struct(F.lit(payer_id).cast("string").alias("value")).alias("identifier")
        ).alias("insurer"),
        F.struct(identifier.alias("identifier")).alias("provider"),
        F.struct(F.array(F.struct(F.lit("normal").alias("code"))).alias("coding")).alias(
            "priority"
        ),
        diagnoses.alias("diagnosis"),
        items.alias("item"),
        usd.alias("total"),
        F.lit(None).cast("int").alias("_denial_risk_score"),
        F.col("prior_auth_number").alias("_prior_auth"),
        F.col("rendering_npi").alias("_rendering_npi"),
    )


def map_to_fhir(parsed: DataFrame, payer_id: str | None = None, keep=()) -> DataFrame:
    """``claim_id, fhir_json`` (plus ``keep``), one row per parsed claim."""
    text = F.to_json(fhir_struct(payer_id), {"ignoreNullFields": "false"})
    return parsed.select(
        F.col("transaction_id").alias("claim_id"), text.alias("fhir_json"), *keep
    )


# --- FHIR -> columns ---------------------------------------------------------------


def with_variant(df: DataFrame, json: str = "fhir_json") -> DataFrame:
    """Adds the parsed ``v``, what is read of it at once, whether its root is an object, and the NPI text.

    The parse goes through a one-element explode: a later filter on ``v`` cannot be
    pushed below it, where the optimizer would repeat the parse per reference.
    """
    parsed = df.withColumn(CLAIM, F.explode(F.array(vj.parse(F.col(json)))))
    return CLAIM.read(parsed).withColumns(
        {
            "is_object": vj.is_object_text(F.col(json)) & F.col(CLAIM).isNotNull(),
            "npi": vj.text(CLAIM, "provider.identifier.value"),
        }
    )


def _bad_first_code(v: str, array: str, concept: str) -> Column:
    """The path to the first code meets a value that cannot be indexed that way."""
    def wrong(path: str, allowed: list[str]) -> Column:
        return vj.kind_not_in(v, path, allowed)

    first = f"{array}[0]"
    no_code = ~vj.present(v, f"{first}.{concept}.coding[0].code")
    return no_code & vj.truthy(v, array) & (
        wrong(array, ["ARRAY", "OBJECT"])
        | wrong(first, ["OBJECT"])
        | wrong(f"{first}.{concept}", ["OBJECT"])
        | wrong(f"{first}.{concept}.coding", ["ARRAY", "OBJECT"])
        | wrong(f"{first}.{concept}.coding[0]", ["OBJECT"])
    )


def drop_reason(json: str = "fhir_json") -> Column:
    """Why a Bronze row cannot become a Silver row; NULL when it can."""
    v = CLAIM
    def malformed(path: str, child: str) -> Column:
        return ~vj.is_object_or_absent(v, path, child)

    bad_reference = (vj.kind(v, "patient.reference") != "STRING") & vj.truthy(
        v, "patient.reference"
    )
    unreadable_total = (
        vj.get(v, "total.value", "double").isNull() & vj.present(v, "total.value")
    )
    return (
        F.when(F.col("v").isNull(), "unparseable")
        .when(~F.col("is_object"), "not_an_object")
        .when(malformed("patient", "reference") | bad_reference, "bad_patient")
        .when(_bad_first_code(v, "diagnosis", "diagnosisCodeableConcept"), "bad_diagnosis")
        .when(_bad_first_code(v, "item", "productOrService"), "bad_item")
        .when(
            malformed("insurer", "identifier") | malformed("insurer.identifier", "value"),
            "bad_insurer",
        )
        .when(
            malformed("provider", "identifier") | malformed("provider.identifier", "value"),
            "bad_provider",
        )
        .when(malformed("total", "value") | unreadable_total, "bad_total")
        .when(F.coalesce(vj.text(v, "id"), F.lit("")) == "", "blank_claim_id")
    )


def extract_columns(json: str = "fhir_json") -> dict[str, Column]:
    """Silver base columns read from the variant."""
    v = CLAIM
    reference = vj.text(v, "patient.reference")
    return {
        "claim_id": vj.text(v, "id", ""),
        "patient_id": F.when(
            vj.truthy(v, "patient.reference"),
            F.replace(reference, F.lit("Patient/"), F.lit("")),
        ),
        "billing_npi": vj.text(v, "provider.identifier.value", ""),
        "primary_diagnosis_code": vj.text(
            v, "diagnosis[0].diagnosisCodeableConcept.coding[0].code"
        ),
        "procedure_code": vj.text(v, "item[0].productOrService.coding[0].code"),
        "billed_amount": F.coalesce(vj.get(v, "total.value", "double"), F.lit(0.0)),
        "service_date": F.try_to_date(vj.text(v, "created"), "yyyy-MM-dd"),
        "prior_auth_number": vj.text(v, "_prior_auth"),
        "fhir_resource_type": vj.text(v, "resourceType", ""),
        "payer_id": F.when(
            vj.truthy(v, "insurer.identifier.value"), vj.text(v, "insurer.identifier.value")
        ).otherwise(vj.text(v, "insurer.reference", "")),
        "source_system": F.lit(fv.SOURCE_SYSTEM),
    }


def first_line_date(v: str) -> Column:
    return vj.text(v, "item[0].servicedDate")


def adjudication_columns(as_of=None) -> dict[str, Column]:
    """What adjudication reads from a claim: member, service date, codes, amounts."""
    v = CLAIM
    codes = F.flatten(
        F.transform(
            vj.part(v, "item"),
            lambda it: F.coalesce(
                F.transform(it["productOrService"]["coding"], lambda c: c["code"]),
                F.array().cast("array<string>"),
            ),
        )
    )
    return {
        "claim_id": vj.text(v, "id", "UNKNOWN"),
        "member_id": member_of_reference(vj.text(v, "patient.reference")),
        "dos": service_date(first_line_date(v), today(as_of)),
        "billed_amount": F.coalesce(vj.get(v, "total.value", "double"), F.lit(0.0)),
        "prior_auth": vj.text(v, "_prior_auth"),
        "cpts": F.coalesce(codes, F.array().cast("array<string>")),
    }
