"""Gold, staging, marts, analyst queries and the metric layer."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimworks.fixtures import star
from claimworks.functions.scalars import safe_divide
from claimworks.operators.numbering import numbered
from claimworks.plans import gold, marts, semantic
from claimworks.registry.sql_base import MONEY, PCT, with_ctes
from claimworks.session import scratch_dir
from claimworks.sources import catalog

TOTAL = "decimal(18,2)"


def silver(spark: SparkSession, sf: str) -> DataFrame:
    return star.claims(spark, sf).withColumn(
        "provider_explanation",
        F.concat(F.lit("Score "), F.col("denial_risk_score").cast("string")),
    )


def adjudication(spark: SparkSession, sf: str) -> DataFrame:
    return marts.int_claim_adjudication(
        marts.stg_claims(silver(spark, sf)), marts.stg_remittance(star.remittance(spark, sf))
    )


def _money(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast(TOTAL) for n in names})


def _rounded(df: DataFrame, *names: str, digits: int = 2) -> DataFrame:
    return df.withColumns({n: F.round(F.col(n).cast("double"), digits) for n in names})


def a1(spark, sf):
    out = gold.provider_summary(star.claims(spark, sf))
    return _rounded(_money(out, "total_billed"), "avg_billed", "denial_rate")


def a2(spark, sf):
    out = gold.denial_summary(star.claims(spark, sf))
    return _rounded(_money(out, "total_billed"), "avg_billed", "denial_rate")


def f10(spark, sf):
    return gold.claims_summary(star.claims(spark, sf))


def f7(spark, sf):
    return marts.stg_claims(silver(spark, sf)).drop("processed_ts")


def f8(spark, sf):
    return marts.stg_remittance(star.remittance(spark, sf))


def f9(spark, sf):
    return marts.stg_providers(star.claims(spark, sf))


def j1(spark, sf):
    return _money(adjudication(spark, sf), "paid_amount", "cas_amount")


def a3(spark, sf):
    out = marts.claims_by_provider(adjudication(spark, sf))
    out = _money(out, "total_billed", "total_paid", "total_adjustments")
    return _rounded(out, "avg_denial_risk")


def a4(spark, sf):
    return marts.denial_rates(adjudication(spark, sf))


def a5(spark, sf):
    out = marts.revenue_summary(adjudication(spark, sf))
    return _money(out, "total_billed", "total_paid", "total_adjustments")


def a7(spark, sf):
    out = marts.high_risk_months(marts.denial_rates(adjudication(spark, sf)))
    return _rounded(out, "avg_risk", digits=6)


def r1(spark, sf):
    """Multi-key sort with mixed direction; the position proves the order."""
    ordered = marts.denial_rates(adjudication(spark, sf)).select(
        "claim_month", "denial_rate_pct", "billing_npi", "total_claims"
    )
    return numbered(ordered)


def r2(spark, sf):
    return _rounded(
        marts.top_denial_providers(marts.claims_by_provider(adjudication(spark, sf))),
        "avg_denial_risk",
    )


def r3(spark, sf):
    """The worklist with each claim's place in it."""
    return numbered(marts.review_worklist(marts.denial_explanations(adjudication(spark, sf))))


def r4(spark, sf):
    """Months with their place, latest first."""
    out = numbered(marts.revenue_by_month(marts.revenue_summary(adjudication(spark, sf))))
    return _money(out, "total_billed", "total_paid")


def r5(spark, sf):
    return star.claims(spark, sf).select("billing_npi", "primary_diagnosis_code").distinct()


def b6(spark, sf):
    return marts.denial_explanations(adjudication(spark, sf), with_prompts=True)


def b7(spark, sf):
    out = star.remittance(spark, sf)
    return out.select(
        "claim_id",
        safe_divide(
            F.col("cas_amount").cast("double"), F.col("paid_amount").cast("double")
        ).alias("cas_per_paid"),
    )


def s9(spark, sf):
    """Rebuild a Gold table and read it back."""
    where = scratch_dir(spark, "gold")
    gold.denial_summary(star.claims(spark, sf)).write.mode("overwrite").parquet(where)
    return _rounded(
        _money(spark.read.parquet(where), "total_billed"), "avg_billed", "denial_rate"
    )


def s16(spark, sf):
    """Models as views and tables; the marts read the written join."""
    models = marts.materialize(
        spark, silver(spark, sf), star.remittance(spark, sf), scratch_dir(spark, "models")
    )
    out = _money(models["revenue_summary"], "total_billed", "total_paid", "total_adjustments")
    return out


def s16_catalog(spark, sf):
    """The models of a schema of their own: kind in the catalog, and rows when read by name."""
    location = scratch_dir(spark, "models")
    schema = marts.schema_name("analytics", " claims_" + location[-12:] + " ")
    for _ in range(2):  # the second run replaces the first one's tables
        marts.materialize(spark, silver(spark, sf), star.remittance(spark, sf), location, schema)
    tables = catalog.listed(spark, schema)
    views = [(name, "TEMPORARY") for name in marts.VIEWS]
    rows = [
        spark.table(name if kind == "TEMPORARY" else catalog.quoted(schema, name))
        .agg(F.count("*").alias("n_rows"))
        .select(F.lit(name).alias("model"), F.lit(kind).alias("kind"), "n_rows")
        for name, kind in views + tables
    ]
    return reduce(DataFrame.unionByName, rows)


def q1(spark, sf):
    out = semantic.metric_select(
        {"CLAIMS_BY_PROVIDER": marts.claims_by_provider(adjudication(spark, sf))},
        "CLAIMS_BY_PROVIDER",
        dimensions=["provider_npi"],
        measures=["claim_count", "denial_rate", "total_billed", "total_paid"],
        where="claim_count > 1",
        order=["total_billed desc", "provider_npi"],
    )
    return _money(out, "total_billed", "total_paid")


def q1_regrouped(spark, sf):
    """Measures of providers by quarter and of all claims by year, both from one table of monthly states."""
    states = semantic.measure_states(adjudication(spark, sf), ["billing_npi", "claim_month"])
    path = scratch_dir(spark, "states")
    states.write.mode("overwrite").parquet(path)
    states = spark.read.parquet(path)
    names = ["claim_count", "denial_rate", "total_billed", "total_paid", "collection_rate_pct", "avg_denial_risk"]
    by_quarter = semantic.regroup(states, names, ["billing_npi"], "quarter")
    by_year = semantic.regroup(states, names, grain="year").withColumn("billing_npi", F.lit(None).cast("string"))
    both = by_quarter.withColumn("grain", F.lit("quarter")).unionByName(
        by_year.withColumn("grain", F.lit("year"))
    )
    return _money(both, "total_billed", "total_paid")


QUERIES = {
    "A1_provider_summary": a1,
    "A2_denial_summary": a2,
    "A3_claims_by_provider": a3,
    "A4_denial_rates": a4,
    "A5_revenue_summary": a5,
    "A7_high_risk_months": a7,
    "B6_explanation_prompts": b6,
    "B7_safe_divide": b7,
    "F7_stg_claims": f7,
    "F8_stg_remittance": f8,
    "F9_stg_providers": f9,
    "F10_billed_tier": f10,
    "J1_claim_adjudication_join": j1,
    "Q1_metric_select": q1,
    "Q1_regrouped_metrics": q1_regrouped,
    "R1_multi_key_sort": r1,
    "R2_top_denial_providers": r2,
    "R3_review_worklist": r3,
    "R4_revenue_by_month": r4,
    "R5_distinct": r5,
    "S9_gold_rebuild": s9,
    "S16_materialize_models": s16,
    "S16_catalog_tables": s16_catalog,
}

_GOLD = f"""count(claim_id) AS claim_count, {MONEY.format(x='sum(billed_amount)')} AS total_billed,
  round(CAST(sum(billed_amount) AS DOUBLE) / count(*), 2) AS avg_billed,
  count(prior_auth_number) AS prior_auth_count,
  round(CAST(count(prior_auth_number) AS DOUBLE) / count(claim_id), 2) AS denial_rate"""
_REVENUE = with_ctes("SELECT * FROM revenue", "revenue")
_REGROUPED = f"""count(claim_id) AS claim_count,
  {PCT.format(n='sum(is_denied)', d='count(*)')} AS denial_rate,
  {MONEY.format(x='sum(billed_amount)')} AS total_billed,
  {MONEY.format(x='sum(paid_amount)')} AS total_paid,
  {PCT.format(n='sum(paid_amount)', d='sum(billed_amount)')} AS collection_rate_pct,
  round(avg(denial_risk_score), 2) AS avg_denial_risk"""
_DENIAL_SUMMARY = with_ctes(
    f"SELECT primary_diagnosis_code, {_GOLD} FROM claims GROUP BY primary_diagnosis_code", "claims"
)

SQL = {
    "A1_provider_summary": with_ctes(
        f"""SELECT billing_npi, {_GOLD}, count(DISTINCT patient_id) AS unique_patients
        FROM claims GROUP BY billing_npi""",
        "claims",
    ),
    "A2_denial_summary": _DENIAL_SUMMARY,
    "A3_claims_by_provider": with_ctes("SELECT * FROM by_provider", "by_provider"),
    "A4_denial_rates": with_ctes("SELECT * FROM rates", "rates"),
    "A5_revenue_summary": _REVENUE,
    "A7_high_risk_months": with_ctes(
        """SELECT claim_month, CAST(sum(high_risk_claims) AS BIGINT) AS total_high_risk,
        round(avg(avg_risk_score), 6) AS avg_risk FROM rates GROUP BY claim_month""",
        "rates",
    ),
    "B6_explanation_prompts": with_ctes(
        """SELECT claim_id, billing_npi, date_of_service, denial_risk_score, risk_tier,
          human_review_required, cas_code, adjudication_status,
          provider_explanation AS shap_explanation,
          CAST(NULL AS VARCHAR) AS cortex_provider_explanation,
          CAST(NULL AS VARCHAR) AS recommended_action,
          'You are a healthcare claims specialist. Write a 2-sentence provider-facing '
          || 'explanation for this claim decision in plain English for a billing specialist. '
          || 'Claim ID: ' || claim_id || '. Risk score: ' || CAST(denial_risk_score AS VARCHAR)
          || '/100. Risk category: ' || risk_tier || '. Adjustment code: ' || cas_code
          || '. Base explanation: ' || provider_explanation AS explanation_prompt,
          'In one sentence, what action should the provider take? Risk: ' || risk_tier
          || '. Adjustment: ' || cas_code || '.' AS action_prompt
        FROM int_adj WHERE human_review_required""",
        "int_adj",
    ),
    "B7_safe_divide": with_ctes(
        """SELECT claim_id, CAST(cas_amount AS DOUBLE)
          / nullif(CAST(paid_amount AS DOUBLE), 0) AS cas_per_paid FROM remittance""",
        "remittance",
    ),
    "F7_stg_claims": with_ctes("SELECT * FROM stg_claims", "stg_claims"),
    "F8_stg_remittance": with_ctes(
        f"""SELECT claim_id, member_id, CAST(date_of_service AS DATE) AS date_of_service, status,
          CAST(billed_amount AS DECIMAL(10,2)) AS billed_amount,
          CAST(paid_amount AS DECIMAL(10,2)) AS paid_amount,
          CAST(cas_amount AS DECIMAL(10,2)) AS cas_amount, cas_code, denial_reason,
          CASE WHEN billed_amount > 0 THEN {PCT.format(n='cas_amount', d='billed_amount')}
            ELSE 0 END AS adjustment_rate_pct FROM remittance""",
        "remittance",
    ),
    "F9_stg_providers": with_ctes(
        """SELECT billing_npi AS provider_npi, CAST(NULL AS VARCHAR) AS rendering_npi,
          concat('Provider-', billing_npi) AS provider_name,
          'GENERAL_PRACTICE' AS provider_specialty, 'TX' AS provider_state,
          min(service_date) AS first_claim_date, max(service_date) AS last_claim_date,
          count(DISTINCT claim_id) AS total_claims
        FROM claims WHERE length(billing_npi) = 10 GROUP BY billing_npi""",
        "claims",
    ),
    "F10_billed_tier": with_ctes(
        """SELECT claim_id, billing_npi, billed_amount, service_date, prior_auth_number,
          CASE WHEN billed_amount >= 5000 THEN 'HIGH' WHEN billed_amount >= 1000 THEN 'MEDIUM'
            ELSE 'LOW' END AS risk_tier FROM claims""",
        "claims",
    ),
    "J1_claim_adjudication_join": with_ctes(
        f"""SELECT * REPLACE ({MONEY.format(x='paid_amount')} AS paid_amount,
          {MONEY.format(x='cas_amount')} AS cas_amount) FROM int_adj""",
        "int_adj",
    ),
    "Q1_regrouped_metrics": with_ctes(
        f"""SELECT 'quarter' AS grain, billing_npi,
          CAST(date_trunc('quarter', claim_month) AS DATE) AS period, {_REGROUPED}
        FROM int_adj GROUP BY billing_npi, period
        UNION ALL SELECT 'year', NULL, CAST(date_trunc('year', claim_month) AS DATE) AS period, {_REGROUPED}
        FROM int_adj GROUP BY period""",
        "int_adj",
    ),
    "Q1_metric_select": with_ctes(
        """SELECT billing_npi AS provider_npi, claim_count, denial_rate, total_billed, total_paid
        FROM by_provider WHERE claim_count > 1""",
        "by_provider",
    ),
    "R1_multi_key_sort": with_ctes(
        """SELECT claim_month, denial_rate_pct, billing_npi, total_claims, row_number() OVER (
          ORDER BY claim_month DESC, denial_rate_pct DESC, billing_npi NULLS FIRST) AS position
        FROM rates""",
        "rates",
    ),
    "R2_top_denial_providers": with_ctes(
        """SELECT billing_npi, denial_rate, claim_count, avg_denial_risk FROM by_provider
        ORDER BY denial_rate DESC, billing_npi NULLS FIRST LIMIT 10""",
        "by_provider",
    ),
    "R3_review_worklist": with_ctes(
        """SELECT claim_id, billing_npi, denial_risk_score,
          CAST(NULL AS VARCHAR) AS cortex_provider_explanation,
          CAST(NULL AS VARCHAR) AS recommended_action,
          row_number() OVER (ORDER BY denial_risk_score DESC, claim_id) AS position
        FROM int_adj WHERE human_review_required AND denial_risk_score >= 70""",
        "int_adj",
    ),
    "R4_revenue_by_month": with_ctes(
        """SELECT claim_month, total_billed, total_paid, collection_rate_pct, claim_count,
          row_number() OVER (ORDER BY claim_month DESC) AS position FROM revenue""",
        "revenue",
    ),
    "R5_distinct": with_ctes(
        "SELECT DISTINCT billing_npi, primary_diagnosis_code FROM claims", "claims"
    ),
    "S9_gold_rebuild": _DENIAL_SUMMARY,
    "S16_materialize_models": _REVENUE,
    "S16_catalog_tables": with_ctes(
        """SELECT 'stg_claims' AS model, 'TEMPORARY' AS kind, (SELECT count(*) FROM stg_claims) AS n_rows
        UNION ALL SELECT 'stg_remittance', 'TEMPORARY', (SELECT count(*) FROM remittance)
        UNION ALL SELECT 'stg_providers', 'TEMPORARY',
          (SELECT count(DISTINCT billing_npi) FROM claims WHERE billing_npi IS NOT NULL)
        UNION ALL SELECT 'int_claim_adjudication', 'EXTERNAL', (SELECT count(*) FROM int_adj)
        UNION ALL SELECT 'claims_by_provider', 'EXTERNAL', (SELECT count(*) FROM by_provider)
        UNION ALL SELECT 'denial_rates', 'EXTERNAL', (SELECT count(*) FROM rates)
        UNION ALL SELECT 'revenue_summary', 'EXTERNAL', (SELECT count(*) FROM revenue)
        UNION ALL SELECT 'denial_explanations', 'EXTERNAL',
          (SELECT count(*) FROM int_adj WHERE human_review_required)""",
        "int_adj", "by_provider", "rates", "revenue",
    ),
}
