"""Staging views, the claim-adjudication join and the reporting marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimworks import fixed_values as fv
from claimworks.functions.scalars import percent, score_tier
from claimworks.sources import catalog

MONEY = "decimal(10,2)"


def null_text() -> Column:
    return F.lit(None).cast("string")


# --- staging -------------------------------------------------------------------


def stg_claims(silver: DataFrame) -> DataFrame:
    processed = F.col("processed_ts") if "processed_ts" in silver.columns else F.lit(None)
    explanation = (
        F.col("provider_explanation") if "provider_explanation" in silver.columns else null_text()
    )
    return silver.where(F.col("claim_id").isNotNull()).select(
        "claim_id",
        "patient_id",
        "billing_npi",
        null_text().alias("rendering_npi"),
        F.col("service_date").alias("date_of_service"),
        F.col("billed_amount").try_cast(MONEY).alias("billed_amount"),
        F.col("prior_auth_number").alias("prior_auth"),
        F.col("primary_diagnosis_code").alias("diagnosis_codes"),
        F.col("procedure_code").alias("procedure_codes"),
        F.col("denial_risk_score").cast("int").alias("denial_risk_score"),
        F.col("human_review_required").cast("boolean").alias("human_review_required"),
        explanation.alias("provider_explanation"),
        processed.cast("timestamp").alias("processed_ts"),
        score_tier(F.col("denial_risk_score")).alias("risk_tier"),
    )


def stg_remittance(remittance: DataFrame) -> DataFrame:
    rate = F.when(
        F.col("billed_amount") > 0, percent(F.col("cas_amount"), F.col("billed_amount"))
    ).otherwise(F.lit(0.0))
    return remittance.where(F.col("claim_id").isNotNull()).select(
        "claim_id",
        "member_id",
        F.col("date_of_service").try_cast("date").alias("date_of_service"),
        "status",
        F.col("billed_amount").try_cast(MONEY).alias("billed_amount"),
        F.col("paid_amount").try_cast(MONEY).alias("paid_amount"),
        F.col("cas_amount").try_cast(MONEY).alias("cas_amount"),
        "cas_code",
        "denial_reason",
        rate.alias("adjustment_rate_pct"),
    )


def stg_providers(silver: DataFrame) -> DataFrame:
    return (
        silver.where(F.length("billing_npi") == 10)
        .groupBy(F.col("billing_npi").alias("provider_npi"))
        .agg(
            F.min("service_date").alias("first_claim_date"),
            F.max("service_date").alias("last_claim_date"),
            F.countDistinct("claim_id").alias("total_claims"),
        )
        .select(
            "provider_npi",
            null_text().alias("rendering_npi"),
            F.concat(F.lit("Provider-"), F.col("provider_npi")).alias("provider_name"),
            F.lit("GENERAL_PRACTICE").alias("provider_specialty"),
            F.lit("TX").alias("provider_state"),
            "first_claim_date",
            "last_claim_date",
            "total_claims",
        )
    )


# --- intermediate --------------------------------------------------------------


def int_claim_adjudication(claims: DataFrame, remittance: DataFrame) -> DataFrame:
    """Every staged claim with its remittance, or pending defaults."""
    zero = F.lit(0).cast(MONEY)
    r = remittance.select(
        "claim_id",
        F.col("paid_amount").alias("r_paid"),
        F.col("cas_amount").alias("r_cas"),
        F.col("cas_code").alias("r_code"),
        F.col("status").alias("r_status"),
        F.col("denial_reason").alias("r_reason"),
    )
    paid = F.coalesce("r_paid", zero)
    return claims.join(r, "claim_id", "left").select(
        "claim_id",
        "patient_id",
        "billing_npi",
        "rendering_npi",
        "date_of_service",
        F.trunc("date_of_service", "MM").alias("claim_month"),
        "billed_amount",
        paid.alias("paid_amount"),
        F.coalesce("r_cas", "billed_amount").alias("cas_amount"),
        F.coalesce("r_code", F.lit("PENDING")).alias("cas_code"),
        F.coalesce("r_status", F.lit("pending")).alias("adjudication_status"),
        F.coalesce("r_reason", F.lit("")).alias("denial_reason"),
        "denial_risk_score",
        "risk_tier",
        "human_review_required",
        "provider_explanation",
        "prior_auth",
        F.when(F.col("r_status") == "paid", 1).otherwise(0).alias("is_paid"),
        F.when(F.col("r_status") == "denied", 1).otherwise(0).alias("is_denied"),
        percent(paid, F.col("billed_amount")).alias("collection_rate_pct"),
    )


# --- marts ---------------------------------------------------------------------


def claims_by_provider(adjudication: DataFrame) -> DataFrame:
    return (
        adjudication.groupBy("billing_npi")
        .agg(
            F.countDistinct("claim_id").alias("claim_count"),
            F.countDistinct("patient_id").alias("unique_patients"),
            F.sum("billed_amount").alias("total_billed"),
            F.sum("paid_amount").alias("total_paid"),
            F.sum("cas_amount").alias("total_adjustments"),
            percent(F.sum("paid_amount"), F.sum("billed_amount")).alias("collection_rate_pct"),
            F.sum("is_denied").alias("denied_claim_count"),
            percent(F.sum("is_denied"), F.count("*")).alias("denial_rate"),
            F.avg("denial_risk_score").alias("avg_denial_risk"),
            F.count_if(F.col("human_review_required")).alias("review_required_count"),
        )
        .orderBy(F.col("total_billed").desc(), "billing_npi")
    )


def denial_rates(adjudication: DataFrame) -> DataFrame:
    score = F.col("denial_risk_score")
    return (
        adjudication.where(F.col("claim_month").isNotNull())
        .groupBy("claim_month", "billing_npi")
        .agg(
            F.count("claim_id").alias("total_claims"),
            F.sum("is_denied").alias("denied_claims"),
            percent(F.sum("is_denied"), F.count("*")).alias("denial_rate_pct"),
            F.count_if(score >= fv.REVIEW_SCORE).alias("high_risk_claims"),
            F.count_if(score.between(fv.MEDIUM_SCORE, fv.REVIEW_SCORE - 1)).alias(
                "medium_risk_claims"
            ),
            F.round(F.avg(score), 2).alias("avg_risk_score"),
        )
        .orderBy(F.col("claim_month").desc(), F.col("denial_rate_pct").desc(), "billing_npi")
    )


def revenue_summary(adjudication: DataFrame) -> DataFrame:
    return (
        adjudication.where(F.col("claim_month").isNotNull())
        .groupBy("claim_month")
        .agg(
            F.countDistinct("claim_id").alias("claim_count"),
            F.countDistinct("billing_npi").alias("provider_count"),
            F.sum("billed_amount").alias("total_billed"),
            F.sum("paid_amount").alias("total_paid"),
            F.sum("cas_amount").alias("total_adjustments"),
            percent(F.sum("paid_amount"), F.sum("billed_amount")).alias("collection_rate_pct"),
            F.sum("is_denied").alias("denied_claims"),
            percent(F.sum("is_denied"), F.count("*")).alias("denial_rate_pct"),
        )
        .orderBy(F.col("claim_month").desc())
    )


def denial_explanations(adjudication: DataFrame, with_prompts: bool = False) -> DataFrame:
    """Claims under review.  The completion columns need a hosted model and stay NULL;
    ``with_prompts`` adds the two prompt texts such a model would be given."""
    prompts = []
    if with_prompts:
        prompts = [
            F.concat(
                F.lit(fv.PROMPT_ROLE), F.lit("Claim ID: "), "claim_id", F.lit(". Risk score: "),
                F.col("denial_risk_score").cast("string"), F.lit("/100. Risk category: "),
                "risk_tier", F.lit(". Adjustment code: "), "cas_code",
                F.lit(". Base explanation: "), "provider_explanation",
            ).alias("explanation_prompt"),
            F.concat(
                F.lit(fv.PROMPT_ACTION), "risk_tier", F.lit(". Adjustment: "), "cas_code",
                F.lit("."),
            ).alias("action_prompt"),
        ]
    return adjudication.where(
        F.col("human_review_required") & F.col("claim_id").isNotNull()
    ).select(
        "claim_id",
        "billing_npi",
        "date_of_service",
        "denial_risk_score",
        "risk_tier",
        "human_review_required",
        "cas_code",
        "adjudication_status",
        F.col("provider_explanation").alias("shap_explanation"),
        null_text().alias("cortex_provider_explanation"),
        null_text().alias("recommended_action"),
        *prompts,
    )


# --- analyst queries -----------------------------------------------------------


def top_denial_providers(by_provider: DataFrame, n: int = 10) -> DataFrame:
    return (
        by_provider.select("billing_npi", "denial_rate", "claim_count", "avg_denial_risk")
        .orderBy(F.col("denial_rate").desc(), "billing_npi")
        .limit(n)
    )


def review_worklist(explanations: DataFrame) -> DataFrame:
    """The claim id in the sort key lets the range partitioner cut inside one score."""
    return (
        explanations.where(F.col("denial_risk_score") >= fv.REVIEW_SCORE)
        .select(
            "claim_id", "billing_npi", "denial_risk_score",
            "cortex_provider_explanation", "recommended_action",
        )
        .orderBy(F.col("denial_risk_score").desc(), "claim_id")
    )


def revenue_by_month(revenue: DataFrame) -> DataFrame:
    return revenue.select(
        "claim_month", "total_billed", "total_paid", "collection_rate_pct", "claim_count"
    ).orderBy(F.col("claim_month").desc())


def high_risk_months(rates: DataFrame) -> DataFrame:
    return (
        rates.groupBy("claim_month")
        .agg(
            F.sum("high_risk_claims").alias("total_high_risk"),
            F.avg("avg_risk_score").alias("avg_risk"),
        )
        .orderBy(F.col("total_high_risk").desc(), F.col("claim_month").desc())
    )


# --- materialization -----------------------------------------------------------

VIEWS = ["stg_claims", "stg_remittance", "stg_providers"]
TABLES = [
    "int_claim_adjudication", "claims_by_provider", "denial_rates", "revenue_summary",
    "denial_explanations",
]


def build_models(silver: DataFrame, remittance: DataFrame) -> dict[str, DataFrame]:
    staged, paid = stg_claims(silver), stg_remittance(remittance)
    adjudication = int_claim_adjudication(staged, paid)
    return {
        "stg_claims": staged,
        "stg_remittance": paid,
        "stg_providers": stg_providers(silver),
        "int_claim_adjudication": adjudication,
        "claims_by_provider": claims_by_provider(adjudication),
        "denial_rates": denial_rates(adjudication),
        "revenue_summary": revenue_summary(adjudication),
        "denial_explanations": denial_explanations(adjudication),
    }


def schema_name(target: str, custom: str | None = None) -> str:
    """A custom schema replaces the target's default instead of extending it."""
    return target if custom is None else custom.strip()


def materialize(
    spark: SparkSession,
    silver: DataFrame,
    remittance: DataFrame,
    location: str,
    schema: str | None = None,
) -> dict[str, DataFrame]:
    """Staging as temp views, everything else as Parquet tables below ``location``.

    With ``schema`` (see ``schema_name``) the tables are also tables of that schema in the catalog, external ones,
    so that a dropped schema leaves the files; a second run replaces them.

    The adjudication join is written once and the four marts read that table, so the
    join runs once and not per mart.
    """
    staged, paid = stg_claims(silver), stg_remittance(remittance)
    models = {"stg_claims": staged, "stg_remittance": paid, "stg_providers": stg_providers(silver)}
    for name in VIEWS:
        models[name].createOrReplaceTempView(name)

    def write(name: str, df: DataFrame) -> DataFrame:
        if schema is None:
            df.write.mode("overwrite").parquet(f"{location}/{name}")
            models[name] = spark.read.parquet(f"{location}/{name}")
            models[name].createOrReplaceTempView(name)
        else:
            full = catalog.quoted(catalog.ensure_schema(spark, schema), name)
            df.write.mode("overwrite").option("path", f"{location}/{name}").format("parquet").saveAsTable(full)
            models[name] = spark.table(full)
        return models[name]

    adjudication = write("int_claim_adjudication", int_claim_adjudication(staged, paid))
    write("claims_by_provider", claims_by_provider(adjudication))
    write("denial_rates", denial_rates(adjudication))
    write("revenue_summary", revenue_summary(adjudication))
    write("denial_explanations", denial_explanations(adjudication))
    return models
