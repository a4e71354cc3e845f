"""SQL twins of the derived tables, as named common table expressions."""

from __future__ import annotations

CTES: dict[str, tuple[list[str], str]] = {}


def cte(name: str, text: str, *needs: str) -> None:
    CTES[name] = (list(needs), text)


def with_ctes(select: str, *names: str) -> str:
    """``select`` with the named expressions and everything they need in front."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered:
            return
        for need in CTES[name][0]:
            visit(need)
        ordered.append(name)

    for name in names:
        visit(name)
    body = ",\n".join(f"{name} AS ({CTES[name][1]})" for name in ordered)
    return f"WITH {body}\n{select}"


def _npi_digit(place: int) -> str:
    digit = f"((s % 100000000) // {10**place}) % 10"
    return digit if place % 2 else f"(2 * ({digit}) - CASE WHEN {digit} >= 5 THEN 9 ELSE 0 END)"


NPI_DIGITS = " + ".join(_npi_digit(place) for place in range(8))

cte("sup", "SELECT l_orderkey, min(l_suppkey) AS s FROM lineitem GROUP BY l_orderkey")
cte(
    "claims0",
    f"""
    SELECT 'CLM-' || printf('%08d', o_orderkey) AS claim_id,
      'MBR' || printf('%08d', o_custkey) AS patient_id,
      '1' || printf('%08d', s % 100000000) || CAST((10 - (26 + {NPI_DIGITS}) % 10
        + CASE WHEN s % 10 = 7 THEN 1 ELSE 0 END) % 10 AS VARCHAR)
        AS billing_npi,
      ['I21.09','M79.3','J06.9','M54.5','Z00.00'][CAST(substr(o_orderpriority, 1, 1) AS INT)]
        AS primary_diagnosis_code,
      ['99211','99212','99213','99214','99215','99291','93000','93458','27447','15820',
       '0191T','99999'][o_orderkey % 12 + 1] AS procedure_code,
      CAST(floor(o_totalprice * 2) / 100 AS DECIMAL(12,2)) AS billed_amount,
      CAST(o_orderdate AS DATE) AS service_date,
      CAST(o_orderdate AS DATE) + CAST(o_orderkey % 240 AS INT) AS filed_date,
      CASE WHEN CAST(substr(o_orderpriority, 1, 1) AS INT) <= 2
        THEN 'AUTH' || printf('%08d', o_orderkey) END AS prior_auth_number,
      CAST(o_orderkey % 10 + 1 AS INT) AS dx_count,
      CAST(substr(o_orderpriority, 1, 1) AS INT) - 1 AS dx_first,
      CAST(o_orderkey % 240 AS INT) AS lag_days,
      o_orderkey AS order_key, o_orderstatus AS order_status, s AS supplier
    FROM orders LEFT JOIN sup ON l_orderkey = o_orderkey
    """,
    "sup",
)
cte(
    "claims1",
    """
    SELECT *, CAST(CASE WHEN billed_amount > 800 THEN 50 ELSE 0 END
      + CASE WHEN prior_auth_number IS NULL THEN 35 ELSE 0 END
      + CASE WHEN dx_count > 5 THEN 10 ELSE 0 END
      + CASE WHEN lag_days > 90 THEN 5 ELSE 0 END AS INT) AS denial_risk_score
    FROM claims0
    """,
    "claims0",
)
cte("claims", "SELECT *, denial_risk_score >= 70 AS human_review_required FROM claims1", "claims1")
cte(
    "enrollment",
    """
    SELECT 'MBR' || printf('%08d', c_custkey) AS member_id,
      DATE '1995-01-01' + CAST(c_custkey % 365 AS INT) AS coverage_start,
      DATE '2000-12-31' + CAST(c_custkey % 200 AS INT) AS coverage_end,
      ['PPO','HMO','EPO','POS'][c_custkey % 4 + 1] AS plan_type,
      'PYR0001' AS payer_id, 'GRP' || CAST(c_nationkey AS VARCHAR) AS group_number
    FROM customer WHERE c_custkey % 20 <> 0
    """,
)
cte(
    "elig",
    """
    SELECT c.*, CASE WHEN e.member_id IS NULL THEN 'member_not_found'
        WHEN c.service_date BETWEEN e.coverage_start AND e.coverage_end THEN 'active_coverage'
        ELSE 'coverage_not_active_on_dos' END AS eligibility_reason,
      coalesce(e.plan_type, '') AS plan_type, coalesce(e.payer_id, '') AS payer_id,
      coalesce(e.group_number, '') AS group_number
    FROM claims c LEFT JOIN enrollment e ON c.patient_id = e.member_id
    """,
    "claims", "enrollment",
)
FEE_CASE = """CASE {c} WHEN '99211' THEN 40 WHEN '99212' THEN 75 WHEN '99213' THEN 280
      WHEN '99214' THEN 350 WHEN '99215' THEN 425 WHEN '99291' THEN 390 WHEN '93000' THEN 85
      WHEN '93458' THEN 2500 WHEN '27447' THEN 8000 WHEN '15820' THEN 850
      WHEN '0191T' THEN 1200 ELSE 150 END"""
cte(
    "ruled",
    f"""
    SELECT *, CAST({FEE_CASE.format(c='procedure_code')} AS DECIMAL(12,2)) AS allowed,
      CASE WHEN eligibility_reason <> 'active_coverage' THEN eligibility_reason
        WHEN filed_date - service_date > 180 THEN 'timely_filing_exceeded'
        WHEN procedure_code = '15820' THEN 'service_not_covered'
        WHEN procedure_code = '0191T' THEN 'experimental_procedure'
        WHEN (procedure_code IN ('93458','27447') OR billed_amount > 1000)
          AND prior_auth_number IS NULL THEN 'prior_auth_required'
        ELSE '' END AS denial_reason
    FROM elig
    """,
    "elig",
)
cte(
    "adjudicated",
    """
    SELECT claim_id, patient_id AS member_id, strftime(service_date, '%Y-%m-%d') AS date_of_service,
      CASE WHEN denial_reason = '' THEN 'paid' ELSE 'denied' END AS status,
      billed_amount,
      CAST(CASE WHEN denial_reason = '' THEN least(allowed, billed_amount) ELSE 0 END
        AS DECIMAL(12,2)) AS paid_amount,
      CAST(billed_amount - CASE WHEN denial_reason = '' THEN least(allowed, billed_amount)
        ELSE 0 END AS DECIMAL(12,2)) AS cas_amount,
      CASE denial_reason WHEN '' THEN 'CO-45' WHEN 'prior_auth_required' THEN 'CO-197'
        WHEN 'service_not_covered' THEN 'CO-49' WHEN 'timely_filing_exceeded' THEN 'CO-29'
        WHEN 'experimental_procedure' THEN 'CO-50' ELSE 'OA-23' END AS cas_code,
      denial_reason, procedure_code, allowed, order_key, order_status
    FROM ruled
    """,
    "ruled",
)
REMIT_COLUMNS = (
    "claim_id, member_id, date_of_service, status, billed_amount, paid_amount, cas_amount, "
    "cas_code, denial_reason"
)
cte("remittance", f"SELECT {REMIT_COLUMNS} FROM adjudicated WHERE order_status <> 'P'", "adjudicated")
cte(
    "orphan_remittance",
    f"""
    SELECT * FROM remittance UNION ALL
    SELECT 'X-' || CAST(order_key AS VARCHAR) AS claim_id, {REMIT_COLUMNS.split(', ', 1)[1]}
    FROM adjudicated WHERE order_key % 1000 = 0
    """,
    "remittance", "adjudicated",
)
cte(
    "stg_claims",
    """
    SELECT claim_id, patient_id, billing_npi, CAST(NULL AS VARCHAR) AS rendering_npi,
      service_date AS date_of_service, CAST(billed_amount AS DECIMAL(10,2)) AS billed_amount,
      prior_auth_number AS prior_auth, primary_diagnosis_code AS diagnosis_codes,
      procedure_code AS procedure_codes, denial_risk_score, human_review_required,
      'Score ' || CAST(denial_risk_score AS VARCHAR) AS provider_explanation,
      CASE WHEN denial_risk_score >= 70 THEN 'HIGH' WHEN denial_risk_score >= 40 THEN 'MEDIUM'
        ELSE 'LOW' END AS risk_tier
    FROM claims WHERE claim_id IS NOT NULL
    """,
    "claims",
)
cte(
    "int_adj",
    """
    SELECT c.claim_id, c.patient_id, c.billing_npi, c.rendering_npi, c.date_of_service,
      CAST(date_trunc('month', c.date_of_service) AS DATE) AS claim_month,
      c.billed_amount,
      CAST(coalesce(r.paid_amount, 0) AS DECIMAL(12,2)) AS paid_amount,
      CAST(coalesce(r.cas_amount, c.billed_amount) AS DECIMAL(12,2)) AS cas_amount,
      coalesce(r.cas_code, 'PENDING') AS cas_code,
      coalesce(r.status, 'pending') AS adjudication_status,
      coalesce(r.denial_reason, '') AS denial_reason,
      c.denial_risk_score, c.risk_tier, c.human_review_required, c.provider_explanation,
      c.prior_auth,
      CASE WHEN r.status = 'paid' THEN 1 ELSE 0 END AS is_paid,
      CASE WHEN r.status = 'denied' THEN 1 ELSE 0 END AS is_denied,
      round(CAST(coalesce(r.paid_amount, 0) AS DOUBLE) * 100
        / nullif(CAST(c.billed_amount AS DOUBLE), 0), 2) AS collection_rate_pct
    FROM stg_claims c LEFT JOIN remittance r ON c.claim_id = r.claim_id
    """,
    "stg_claims", "remittance",
)
PCT = "round(CAST({n} AS DOUBLE) * 100 / nullif(CAST({d} AS DOUBLE), 0), 2)"
MONEY = "CAST({x} AS DECIMAL(18,2))"
cte(
    "by_provider",
    f"""
    SELECT billing_npi, count(DISTINCT claim_id) AS claim_count,
      count(DISTINCT patient_id) AS unique_patients,
      {MONEY.format(x='sum(billed_amount)')} AS total_billed,
      {MONEY.format(x='sum(paid_amount)')} AS total_paid,
      {MONEY.format(x='sum(cas_amount)')} AS total_adjustments,
      {PCT.format(n='sum(paid_amount)', d='sum(billed_amount)')} AS collection_rate_pct,
      CAST(sum(is_denied) AS BIGINT) AS denied_claim_count,
      {PCT.format(n='sum(is_denied)', d='count(*)')} AS denial_rate,
      round(avg(denial_risk_score), 2) AS avg_denial_risk,
      CAST(sum(CASE WHEN human_review_required THEN 1 ELSE 0 END) AS BIGINT)
        AS review_required_count
    FROM int_adj GROUP BY billing_npi
    """,
    "int_adj",
)
cte(
    "rates",
    f"""
    SELECT claim_month, billing_npi, count(claim_id) AS total_claims,
      CAST(sum(is_denied) AS BIGINT) AS denied_claims,
      {PCT.format(n='sum(is_denied)', d='count(*)')} AS denial_rate_pct,
      CAST(sum(CASE WHEN denial_risk_score >= 70 THEN 1 ELSE 0 END) AS BIGINT)
        AS high_risk_claims,
      CAST(sum(CASE WHEN denial_risk_score BETWEEN 40 AND 69 THEN 1 ELSE 0 END) AS BIGINT)
        AS medium_risk_claims,
      round(avg(denial_risk_score), 2) AS avg_risk_score
    FROM int_adj WHERE claim_month IS NOT NULL GROUP BY claim_month, billing_npi
    """,
    "int_adj",
)
cte(
    "revenue",
    f"""
    SELECT claim_month, count(DISTINCT claim_id) AS claim_count,
      count(DISTINCT billing_npi) AS provider_count,
      {MONEY.format(x='sum(billed_amount)')} AS total_billed,
      {MONEY.format(x='sum(paid_amount)')} AS total_paid,
      {MONEY.format(x='sum(cas_amount)')} AS total_adjustments,
      {PCT.format(n='sum(paid_amount)', d='sum(billed_amount)')} AS collection_rate_pct,
      CAST(sum(is_denied) AS BIGINT) AS denied_claims,
      {PCT.format(n='sum(is_denied)', d='count(*)')} AS denial_rate_pct
    FROM int_adj WHERE claim_month IS NOT NULL GROUP BY claim_month
    """,
    "int_adj",
)
