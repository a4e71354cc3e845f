"""Codes, thresholds, names and texts that decide results."""

# --- fixed values: feature order of the risk model, and the label of each feature ---
FEATURES = [
    "billed_amount",
    "prior_auth",
    "diagnosis_code_count",
    "procedure_complexity",
    "provider_specialty_code",
    "days_since_service",
]
DRIVER_LABELS = {
    "billed_amount": "elevated billed amount",
    "prior_auth": "missing prior authorization",
    "diagnosis_code_count": "high diagnosis code count",
    "procedure_complexity": "procedure complexity level",
    "provider_specialty_code": "provider specialty category",
    "days_since_service": "days elapsed since service date",
}
BATCH_SPECIALTY = 11.0
BATCH_DAYS = 30.0
STREAM_FALLBACK_FEATURES = [0.0, 0.0, 1.0, 1.0, 0.0, 0.0]

# --- fixed values: score thresholds, fallbacks and topics ---
REVIEW_SCORE = 70
MEDIUM_SCORE = 40
SCORE_INVALID = 99
SCORE_MODEL_ERROR = 70
SCORE_UNAVAILABLE = 0
STREAM_FALLBACK_PROBABILITY = 0.5
TOPIC_RAW = "claims.raw"
TOPIC_VALIDATED = "claims.validated"
TOPIC_REVIEW = "claims.review_queue"
TOPIC_REJECTED = "claims.rejected"
TOPIC_REMITTANCE = "remittance.835"
TOPICS = [TOPIC_RAW, TOPIC_VALIDATED, TOPIC_REVIEW, TOPIC_REJECTED, TOPIC_REMITTANCE]

# --- fixed values: explanation texts ---
EXPLAIN_REVIEW = (
    "This claim was flagged for human review (risk score %d/100). "
    "The primary contributing factor was %s (%d%% of risk attribution). "
    "A qualified reviewer will evaluate before any adverse determination."
)
EXPLAIN_BELOW = (
    "Claim scored %d/100 — below human review threshold. "
    "Primary risk factor: %s (%d%% attribution)."
)
EXPLAIN_INVALID = "Claim %s failed validation: %s."
EXPLAIN_MODEL_ERROR = "Automated scoring unavailable for %s. Routed to human review."
EXPLAIN_UNAVAILABLE = "scoring_unavailable"
DRIVER_INVALID = "failed FHIR validation"
DRIVER_MODEL_ERROR = "model scoring error"
DRIVER_UNAVAILABLE = "unknown"
BASIS_INVALID = '{"validation_failed":100.0}'
BASIS_MODEL_ERROR = '{"model_error":100.0}'
BASIS_UNAVAILABLE = "{}"

# --- fixed values: validation ---
REQUIRED_FIELDS = [
    "resourceType", "id", "status", "patient", "provider", "diagnosis", "item", "total",
]
MAPPED_FIELDS = [
    "resourceType", "id", "status", "type", "use", "patient", "created", "insurer",
    "provider", "priority", "diagnosis", "item", "total",
]
NPI_PREFIX = "80840"

# --- fixed values: adjudication ---
AUTH_REQUIRED_CPTS = ["93458", "27447"]
AUTH_REQUIRED_ABOVE = 1000
NON_COVERED_CPTS = [
    "15820", "15821", "15822", "15823", "17340", "21120", "21121", "11950", "11951", "11952",
]
EXPERIMENTAL_CPTS = ["0191T", "0195T", "0301T"]
TIMELY_FILING_DAYS = 180
CAS_CODES = {
    "prior_auth_required": "CO-197",
    "service_not_covered": "CO-49",
    "timely_filing_exceeded": "CO-29",
    "experimental_procedure": "CO-50",
    "coverage_not_active_on_dos": "OA-23",
    "member_not_found": "OA-23",
}
CAS_DEFAULT = "CO-97"
CAS_PAID = "CO-45"
FEE_DEFAULT = 150.00
FEES = {
    "99201": 75.00, "99202": 110.00, "99203": 155.00, "99204": 215.00, "99205": 275.00,
    "99211": 40.00, "99212": 75.00, "99213": 280.00, "99214": 350.00, "99215": 425.00,
    "99221": 200.00, "99222": 275.00, "99223": 360.00,
    "99231": 90.00, "99232": 145.00, "99233": 200.00,
    "99281": 85.00, "99282": 125.00, "99283": 175.00, "99284": 240.00, "99285": 310.00,
    "99291": 390.00, "99292": 195.00,
    "93000": 85.00, "93458": 2500.00,
    "27447": 8000.00,
    "15820": 850.00, "15821": 950.00, "15822": 1100.00, "15823": 1250.00,
    "17340": 320.00,
    "21120": 2200.00, "21121": 2800.00,
    "0191T": 1200.00, "0195T": 1800.00, "0301T": 2400.00,
}

# --- fixed values: FHIR system addresses and constants ---
SYSTEM_NPI = "http://hl7.org/fhir/sid/us-npi"
SYSTEM_ICD10 = "http://hl7.org/fhir/sid/icd-10-cm"
SYSTEM_CPT = "http://www.ama-assn.org/go/cpt"
SYSTEM_CLAIM_TYPE = "http://terminology.hl7.org/CodeSystem/claim-type"
SOURCE_SYSTEM = "kafka/fhir"

# --- fixed values: X12 ---
DIAGNOSIS_QUALIFIERS = ["ABK", "BK", "ABF", "BF"]
PLAN_TYPES = ["PPO", "HMO", "EPO", "POS"]
OPEN_COVERAGE_END = "9999-12-31"

# --- fixed values: billed tiers (USD) ---
TIER_HIGH_USD = 5000
TIER_MEDIUM_USD = 1000

# --- fixed values: prompt texts of the explanation mart ---
PROMPT_ROLE = (
    "You are a healthcare claims specialist. Write a 2-sentence provider-facing "
    "explanation for this claim decision in plain English for a billing specialist. "
)
PROMPT_ACTION = "In one sentence, what action should the provider take? Risk: "

# --- fixed values: data-quality suites ---
BRONZE_SUITE = [
    {"type": "column_exists", "column": "claim_id"},
    {"type": "not_null", "column": "claim_id"},
    {"type": "not_null", "column": "fhir_json"},
    {"type": "not_null", "column": "ingest_ts"},
    {"type": "matches_regex", "column": "fhir_json", "regex": ".*resourceType.*Claim.*"},
    {"type": "row_count_between", "min": 1, "max": 100000},
]
SILVER_SUITE = [
    {"type": "not_null", "column": "claim_id"},
    {"type": "between", "column": "denial_risk_score", "min": 0, "max": 100},
    {"type": "not_null", "column": "denial_risk_score"},
    {"type": "not_null", "column": "human_review_required"},
    {"type": "column_type", "column": "human_review_required", "dtype": "boolean"},
    {"type": "not_null", "column": "provider_explanation"},
    {"type": "length_between", "column": "provider_explanation", "min": 1},
    {"type": "in_set", "column": "ai_decision_only", "values": [False]},
    {"type": "in_set", "column": "reconsideration_right", "values": [True]},
    {"type": "between", "column": "billed_amount", "min": 0.01, "max": 999999},
    {"type": "not_null", "column": "primary_driver"},
    {"type": "not_null", "column": "decision_basis"},
]
