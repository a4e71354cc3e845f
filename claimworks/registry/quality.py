"""Expectation suites and model tests over the derived tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimworks import fixed_values as fv
from claimworks.fixtures import star
from claimworks.plans import lake, marts, quality
from claimworks.registry.marts import silver
from claimworks.registry.sql_base import with_ctes
from claimworks.session import scratch_dir


def _models(spark, sf):
    claims, remittance = silver(spark, sf), star.orphan_remittance(spark, sf)
    models = {"silver_claims": claims, "gold_remittance": remittance}
    path = scratch_dir(spark, "models")
    for name, df in models.items():
        df.write.parquet(f"{path}/{name}")
        models[name] = spark.read.parquet(f"{path}/{name}")
    return models | marts.materialize(
        spark, models["silver_claims"], models["gold_remittance"], f"{path}/marts"
    )


def _suite(spark, sf, kind):
    """The expectations of one kind, run on the silver rows of the damaged claims."""
    damaged = star.spoiled(star.claims(spark, sf)).select(
        F.concat(F.lit("CLM-"), F.col("order_key").cast("string")).alias("claim_id"),
        "fhir_json",
        F.when(F.col("order_key") % 16 != 3, F.col("service_date").cast("timestamp")).alias(
            "ingest_ts"
        ),
        F.col("service_date").cast("timestamp").alias("received_ts"),
    )
    out = quality.run_checkpoint(damaged, lake.to_silver(damaged), [kind])
    return out.select("suite", "column_name", "observed", "success")


def _suite_query(kind):
    return lambda spark, sf: _suite(spark, sf, kind)


def _stored(df, path):
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def v13(spark, sf):
    """Two runs of the checkpoint over the tables, appended to a history; the later one is returned."""
    root = scratch_dir(spark, "checkpoint")
    path, bronze = f"{root}/results", _stored(star.bronze(spark, sf), f"{root}/bronze")
    silver = _stored(lake.to_silver(bronze), f"{root}/silver")
    for _ in range(2):
        quality.store_results(quality.run_checkpoint(bronze, silver), path)
    kept = spark.read.parquet(path)
    last = kept.agg(F.max("run_ts").alias("run_ts"))
    return kept.join(last, "run_ts").drop("run_ts")


def v14(spark, sf):
    return quality.run_model_tests(_models(spark, sf), kinds=["not_null", "unique"])


def v15(spark, sf):
    return quality.run_model_tests(_models(spark, sf), kinds=["accepted_values"])


def v16(spark, sf):
    """Scores shifted by the filing lag, so that some leave the range."""
    shifted = star.claims(spark, sf).withColumn(
        "denial_risk_score", F.col("denial_risk_score") + F.col("lag_days") - 120
    )
    return quality.score_out_of_range(shifted)


def v17(spark, sf):
    return quality.orphan_remittance(
        marts.stg_remittance(star.orphan_remittance(spark, sf)),
        marts.stg_claims(silver(spark, sf)),
    )


QUERIES = {
    "V5_column_exists": _suite_query("column_exists"),
    "V6_not_null": _suite_query("not_null"),
    "V7_matches_regex": _suite_query("matches_regex"),
    "V8_row_count": _suite_query("row_count_between"),
    "V9_value_between": _suite_query("between"),
    "V10_column_type": _suite_query("column_type"),
    "V11_length_between": _suite_query("length_between"),
    "V12_in_set": _suite_query("in_set"),
    "V13_checkpoint": v13,
    "V14_not_null_unique": v14,
    "V15_accepted_values": v15,
    "V16_score_range": v16,
    "V17_orphan_remittance": v17,
}

def _rows(*rows: str) -> str:
    return " UNION ALL ".join(f"SELECT {r} FROM way" for r in rows)


def _row(suite: str, column: str, observed: str, success: str) -> str:
    name = "CAST(NULL AS VARCHAR)" if column == "NULL" else f"'{column}'"
    return (
        f"'{suite}' AS suite, {name} AS column_name, CAST({observed} AS BIGINT) AS observed, "
        f"{success} AS success"
    )


_B, _S = "bronze_claims_suite", "silver_claims_suite"
_SILVER_NOT_NULL = [
    "claim_id", "denial_risk_score", "human_review_required", "provider_explanation",
    "primary_driver", "decision_basis",
]
_CHECKPOINT = [
    (_B, i, s["type"], s.get("column")) for i, s in enumerate(fv.BRONZE_SUITE)
] + [(_S, i, s["type"], s.get("column")) for i, s in enumerate(fv.SILVER_SUITE)]


def _checkpoint_sql() -> str:
    parts = []
    for suite, i, kind, column in _CHECKPOINT:
        observed = {
            "column_exists": "1", "column_type": "1",
            "row_count_between": "count(*) + count(*) FILTER (order_key % 10 = 0)",
        }.get(kind, "0")
        in_range = f"{observed} BETWEEN 1 AND 100000"
        ok = in_range if kind == "row_count_between" else "count(*) > 0"
        name = f"'{column}'" if column else "CAST(NULL AS VARCHAR)"
        parts.append(
            f"SELECT '{suite}' AS suite, {i} AS position, '{kind}' AS expectation, "
            f"{name} AS column_name, CAST({observed} AS BIGINT) AS observed, {ok} AS success "
            "FROM claims"
        )
    return " UNION ALL ".join(parts)


_MODEL_SQL = {
    ("claims_by_provider", "billing_npi", "not_null"):
        "(SELECT max(CASE WHEN billing_npi IS NULL THEN 1 ELSE 0 END) FROM claims)",
}


def _model_sql(unique_and_null: bool) -> str:
    parts = []
    for model, column, kind, _ in quality.MART_TESTS:
        if (kind == "accepted_values") == unique_and_null:
            continue
        failures = _MODEL_SQL.get((model, column, kind), "0")
        parts.append(
            f"SELECT '{model}' AS model, '{column}' AS column_name, '{kind}' AS test, "
            f"CAST({failures} AS BIGINT) AS failures, {failures} = 0 AS passed"
        )
    return " UNION ALL ".join(parts)


SQL = {
    "V5_column_exists": with_ctes(
        _rows(_row(_B, "claim_id", "1", "count(*) > 0")), "way"
    ),
    "V6_not_null": with_ctes(
        _rows(
            _row(_B, "claim_id", "0", "count(*) > 0"),
            _row(_B, "fhir_json", "0", "count(*) > 0"),
            _row(_B, "ingest_ts", "count(*) FILTER (w = 3)", "count(*) FILTER (w = 3) = 0"),
            *[_row(_S, c, "0", "count(*) > 0") for c in _SILVER_NOT_NULL],
        ),
        "way",
    ),
    "V7_matches_regex": with_ctes(
        # The truncated text still names the claim; the empty object and the renamed
        # resource type do not.
        _rows(
            _row(
                _B, "fhir_json",
                "count(*) FILTER (NOT regexp_matches(t, '.*resourceType.*Claim.*'))",
                "count(*) FILTER (NOT regexp_matches(t, '.*resourceType.*Claim.*')) = 0",
            )
        ).replace(
            "FROM way",
            """FROM (SELECT CASE w WHEN 0 THEN substr(f.fhir_json, 1, 40) WHEN 1 THEN '{}'
              WHEN 11 THEN replace(f.fhir_json, '"resourceType":"Claim"',
                '"resourceType":"Coverage"') ELSE f.fhir_json END AS t
              FROM way JOIN fhir f ON f.order_key = way.order_key)""",
        ),
        "way", "fhir",
    ),
    "V8_row_count": with_ctes(
        _rows(_row(_B, "NULL", "count(*)", "count(*) BETWEEN 1 AND 100000")), "way"
    ),
    "V9_value_between": with_ctes(
        _rows(
            _row(_S, "denial_risk_score", "0", "count(*) >= 0"),
            _row(
                _S, "billed_amount", "count(*) FILTER (w IN (5, 6))",
                "count(*) FILTER (w IN (5, 6)) = 0",
            ),
        ),
        "way",
    ),
    "V10_column_type": with_ctes(
        _rows(_row(_S, "human_review_required", "1", "count(*) > 0")), "way"
    ),
    "V11_length_between": with_ctes(
        _rows(_row(_S, "provider_explanation", "0", "count(*) > 0")), "way"
    ),
    "V12_in_set": with_ctes(
        _rows(
            _row(_S, "ai_decision_only", "0", "count(*) > 0"),
            _row(_S, "reconsideration_right", "0", "count(*) > 0"),
        ),
        "way",
    ),
    "V13_checkpoint": with_ctes(_checkpoint_sql(), "claims"),
    "V14_not_null_unique": with_ctes(_model_sql(True), "claims"),
    "V15_accepted_values": _model_sql(False),
    "V16_score_range": with_ctes(
        """SELECT claim_id, CAST(denial_risk_score + lag_days - 120 AS INT) AS denial_risk_score
        FROM claims WHERE denial_risk_score + lag_days - 120 NOT BETWEEN 0 AND 100""",
        "claims",
    ),
    "V17_orphan_remittance": with_ctes(
        """SELECT r.claim_id FROM orphan_remittance r LEFT JOIN stg_claims c
        ON r.claim_id = c.claim_id WHERE c.claim_id IS NULL""",
        "orphan_remittance", "stg_claims",
    ),
}
