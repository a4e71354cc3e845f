"""Explicit table schemas, as DDL strings."""

BRONZE = "claim_id string not null, fhir_json string, ingest_ts timestamp, received_ts timestamp"

SILVER = (
    "claim_id string not null, patient_id string, billing_npi string, "
    "primary_diagnosis_code string, procedure_code string, billed_amount double, "
    "service_date date, prior_auth_number string, fhir_resource_type string, payer_id string, "
    "ingest_ts timestamp, processed_ts timestamp, source_system string, denial_risk_score int, "
    "human_review_required boolean, provider_explanation string, ai_decision_only boolean, "
    "reconsideration_right boolean, primary_driver string, decision_basis string"
)

REMITTANCE = (
    "claim_id string not null, member_id string, date_of_service string, "
    "status string not null, billed_amount double, paid_amount double, cas_amount double, "
    "cas_code string, denial_reason string, processed_ts timestamp"
)

# Typed tables over bare Parquet: money as decimal(12,2), dates as date.
SILVER_TYPED = SILVER.replace("billed_amount double", "billed_amount decimal(12,2)")
REMITTANCE_TYPED = (
    REMITTANCE.replace("_amount double", "_amount decimal(12,2)")
    .replace("date_of_service string", "date_of_service date")
)

ENROLLMENT = (
    "member_id string, coverage_start date, coverage_end date, plan_type string, "
    "payer_id string, group_number string"
)

MESSAGE = "key string, value string, ts timestamp"


def columns(ddl: str) -> list[str]:
    return [part.split()[0] for part in _split(ddl)]


def types(ddl: str) -> dict[str, str]:
    return {part.split()[0]: part.split()[1] for part in _split(ddl)}


def _split(ddl: str) -> list[str]:
    # The comma inside decimal(12,2) has no space after it.
    return [part.strip() for part in ddl.split(", ")]
