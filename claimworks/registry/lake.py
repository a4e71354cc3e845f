"""FHIR files, Bronze to Silver, keyed upsert, clustering, typed tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimworks import schemas
from claimworks.fixtures import star
from claimworks.operators.dedup import latest_per_key
from claimworks.plans import lake
from claimworks.registry import records  # noqa: F401  (registers the fhir expression)
from claimworks.registry.sql_base import cte, with_ctes
from claimworks.session import scratch_dir
from claimworks.sources import catalog, fhir_files, tables
from claimworks.streaming import jobs


def s3(spark, sf):
    """Bundles of a patient's claims, and of other resources, unwrapped."""
    claims = star.fhir_claims(star.claims(spark, sf))
    # A bundle per order holds the claim and an entry that is none; every fifth document
    # is the bare claim, every seventh some other resource.
    entry = F.concat(
        F.lit('{"resourceType":"Bundle","entry":[{"resource":{"resourceType":"Patient","id":"P"}},'
              '{"fullUrl":"x","resource":'), "fhir_json", F.lit('},{"fullUrl":"empty"}]}'),
    )
    document = (
        F.when(F.col("order_key") % 5 == 0, F.col("fhir_json"))
        .when(F.col("order_key") % 7 == 0, F.lit('{"resourceType":"Patient","id":"P"}'))
        .otherwise(entry)
    )
    path = scratch_dir(spark, "fhir")
    claims.select(document.alias("value")).write.mode("overwrite").text(path)
    return fhir_files.read_fhir(spark, path, per_line=True, require_claims=False)


def w1(spark, sf):
    bronze = star.bronze(spark, sf)
    latest = latest_per_key(
        bronze, "claim_id", [F.col("received_ts"), F.col("ingest_ts"), F.xxhash64("fhir_json")]
    )
    return latest.select(
        "claim_id",
        F.to_date("received_ts").alias("received"),
        F.get_json_object("fhir_json", "$.total.value").cast("double").alias("billed_amount"),
    )


def f3(spark, sf):
    return lake.to_silver(star.bronze(spark, sf)).drop("ingest_ts", "processed_ts")


def f3_incremental(spark, sf):
    """Silver after two runs of one stream: Bronze up to a day, then the Bronze rows that came later."""
    bronze, silver, checkpoint = (scratch_dir(spark, n) for n in ("bronze", "silver", "checkpoint"))
    rows = star.bronze(spark, sf)
    cut = F.lit("1995-06-17").cast("timestamp")
    for part in (F.col("received_ts") < cut, F.col("received_ts") >= cut):
        rows.where(part).select(*schemas.columns(schemas.BRONZE)).write.mode("append").parquet(bronze)
        jobs.bronze_to_silver(spark, bronze, silver, checkpoint)
    return lake.silver_table(spark, silver).read().drop("ingest_ts", "processed_ts")


def _silver(spark, sf):
    """Silver columns straight from the claims, for the table queries."""
    return star.claims(spark, sf).select(
        *[
            (F.col(n) if n in ("claim_id", "patient_id", "billing_npi", "primary_diagnosis_code",
                               "procedure_code", "service_date", "prior_auth_number",
                               "denial_risk_score", "human_review_required")
             else F.col(n).cast("double") if n == "billed_amount"
             else F.lit(None)).cast(t).alias(n)
            for n, t in schemas.types(schemas.SILVER).items()
        ]
    )


def s8(spark, sf):
    """First load of the F orders' claims, then an upsert of all with changed amounts
    for O orders; a repeated upsert changes nothing."""
    claims = star.claims(spark, sf)
    status = claims.select("claim_id", "order_status")
    rows = _silver(spark, sf).join(status, "claim_id")
    table = lake.silver_table(spark, scratch_dir(spark, "upsert"))
    table.upsert(rows.where("order_status <> 'O'").drop("order_status"))
    second = rows.where("order_status <> 'F'").withColumn(
        "billed_amount", F.col("billed_amount") + 1
    )
    table.upsert(second.drop("order_status"))
    table.upsert(second.drop("order_status"))
    return table.read().select("claim_id", "billed_amount", "service_date", "denial_risk_score")


def s10(spark, sf):
    """Clustered in sixteen files and read back: rows, sums of the keys, and whether a look-up by either column skips
    more than half of the files, by the least and greatest value of each file.

    The share is the mean over one look-up per file and column: for the values of one row of each file.
    """
    path = scratch_dir(spark, "clustered")
    rows = _silver(spark, sf)
    tables.cluster(rows, "claim_id", "service_date", partitions=16).write.mode("overwrite").parquet(path)
    back = spark.read.parquet(path).withColumn("file", F.col("_metadata.file_path"))
    spans = back.groupBy("file").agg(
        F.min("claim_id").alias("a0"), F.max("claim_id").alias("a1"),
        F.min("service_date").alias("b0"), F.max("service_date").alias("b1"),
        F.max_by("claim_id", F.xxhash64("claim_id")).alias("a"), F.max_by("service_date", F.xxhash64("claim_id")).alias("b"),
    )
    probes, spans = spans.select("a", "b"), spans.drop("a", "b")  # a row per file, sixteen
    met = spans.join(F.broadcast(probes), F.col("a").between(F.col("a0"), F.col("a1")) | F.col("b").between(F.col("b0"), F.col("b1")))
    files = back.agg(F.count_distinct("file").alias("files"))
    skipped = met.agg(
        F.count_if(F.col("a").between(F.col("a0"), F.col("a1"))).alias("by_claim"),
        F.count_if(F.col("b").between(F.col("b0"), F.col("b1"))).alias("by_date"),
    ).join(F.broadcast(files)).select(
        *[(1 - F.col(c) / (F.col("files") * F.col("files")) > 0.5).alias(f"skips_{c}") for c in ("by_claim", "by_date")]
    )
    totals = back.agg(F.count("*").alias("claims"), F.count_distinct("claim_id").alias("keys"), F.min("service_date").alias("first_day"))
    return totals.join(F.broadcast(skipped))


def s12(spark, sf):
    path = scratch_dir(spark, "typed")
    _silver(spark, sf).withColumn("service_date", F.col("service_date").cast("string")).drop(
        "payer_id"
    ).write.mode("overwrite").parquet(path)
    return tables.typed_table(spark, path, schemas.SILVER_TYPED).select(
        "claim_id", "billed_amount", "service_date", "payer_id", "human_review_required"
    )


def s12_remittance(spark, sf):
    """Remittance whose files hold texts only, read under the types of its table."""
    path = scratch_dir(spark, "typed")
    rows = star.remittance(spark, sf)
    rows.select(*[F.col(c).cast("string") for c in rows.columns]).write.mode("overwrite").parquet(path)
    return tables.typed_table(spark, path, schemas.REMITTANCE_TYPED).select(*rows.columns)


def s13(spark, sf):
    """External tables, plain and partitioned, read after more files have come: ``before`` and ``unrefreshed`` count
    what the table held and still shows before the refresh, ``claims`` what it shows after."""
    rows = star.remittance(spark, sf).select("claim_id", "status")
    parts = []
    for kind, by in (("plain", ()), ("partitioned", ("status",))):
        path = scratch_dir(spark, "refreshed")
        rows.where("status = 'paid'").write.mode("overwrite").partitionBy(*by).parquet(path)
        name = catalog.external_table(
            spark, "remittance_" + path[-12:], "files", path, "claim_id STRING, status STRING", by
        )
        catalog.refresh_table(spark, name)
        before = spark.table(name).count()
        rows.where("status <> 'paid'").write.mode("append").partitionBy(*by).parquet(path)
        unrefreshed = spark.table(name).count()
        catalog.refresh_table(spark, name)
        parts.append(
            spark.table(name).groupBy("status").agg(F.count("*").alias("claims")).select(
                F.lit(kind).alias("kind"), "status", "claims",
                F.lit(before).cast("long").alias("before"), F.lit(unrefreshed).cast("long").alias("unrefreshed"),
            )
        )
    return parts[0].unionByName(parts[1])


QUERIES = {
    "F3_bronze_to_silver": f3,
    "F3_incremental": f3_incremental,
    "S3_fhir_bundle": s3,
    "S8_keyed_upsert": s8,
    "S10_cluster": s10,
    "S12_typed_table": s12,
    "S12_typed_remittance": s12_remittance,
    "S13_refresh": s13,
    "W1_latest_per_key": w1,
}

_LATEST = "CASE WHEN order_key % 10 = 0 THEN 1 ELSE 0 END"
# Silver scores with the constants of the batch path: days never counts.
cte(
    "latest",
    f"""
    SELECT *, billed_amount + {_LATEST} AS amount,
      CASE WHEN billed_amount + {_LATEST} > 800 THEN 50 ELSE 0 END AS p_billed,
      CASE WHEN prior_auth_number IS NULL THEN 35 ELSE 0 END AS p_auth,
      CASE WHEN dx_count > 5 THEN 10 ELSE 0 END AS p_dx,
      supplier % 10 = 7 AS bad_npi
    FROM claims
    """,
    "claims",
)
cte("scored0", "SELECT *, p_billed + p_auth + p_dx AS points FROM latest", "latest")
cte(
    "shares0",
    """
    SELECT *, CASE WHEN points = 0 THEN 16.7 ELSE round(p_billed / points * 100, 1) END AS s1,
      CASE WHEN points = 0 THEN 16.7 ELSE round(p_auth / points * 100, 1) END AS s2,
      CASE WHEN points = 0 THEN 16.7 ELSE round(p_dx / points * 100, 1) END AS s3,
      CASE WHEN points = 0 THEN 16.7 ELSE 0 END AS s0
    FROM scored0
    """,
    "scored0",
)
cte(
    "shares1",
    """SELECT *, greatest(s1, s2, s3) AS top, round(100 - (s1 + s2 + s3 + 3 * s0), 1) AS rest
    FROM shares0""",
    "shares0",
)
cte(
    "shares2",
    """
    SELECT * EXCLUDE (s1, s2, s3, s0),
      CAST(CASE WHEN s1 = top THEN round(s1 + rest, 1) ELSE s1 END AS DOUBLE) AS b1,
      CAST(CASE WHEN s1 < top AND s2 = top THEN round(s2 + rest, 1) ELSE s2 END AS DOUBLE) AS b2,
      CAST(CASE WHEN s1 < top AND s2 < top AND s3 = top THEN round(s3 + rest, 1) ELSE s3 END
        AS DOUBLE) AS b3,
      CAST(s0 AS DOUBLE) AS b0
    FROM shares1
    """,
    "shares1",
)
# The driver is the largest share after the residual, the first on a tie.
cte(
    "shares",
    """
    SELECT *, CASE WHEN b1 = greatest(b1, b2, b3) THEN 'elevated billed amount'
        WHEN b2 = greatest(b1, b2, b3) THEN 'missing prior authorization'
        ELSE 'high diagnosis code count' END AS driver
    FROM shares2
    """,
    "shares2",
)
_SILVER_SQL = """
    SELECT claim_id, patient_id, coalesce(billing_npi, '') AS billing_npi,
      primary_diagnosis_code, procedure_code, CAST(amount AS DOUBLE) AS billed_amount,
      service_date, prior_auth_number, 'Claim' AS fhir_resource_type, 'PYR0001' AS payer_id,
      'kafka/fhir' AS source_system,
      CAST(CASE WHEN bad_npi THEN 99 ELSE points END AS INT) AS denial_risk_score,
      bad_npi OR points >= 70 AS human_review_required,
      CASE WHEN bad_npi THEN 'Claim ' || claim_id || ' failed validation: invalid_billing_npi:'
          || billing_npi || '.'
        WHEN points >= 70 THEN 'This claim was flagged for human review (risk score '
          || points || '/100). The primary contributing factor was ' || driver || ' ('
          || CAST(round_even(greatest(b1, b2, b3), 0) AS INT) || '% of risk attribution). '
          || 'A qualified reviewer will evaluate before any adverse determination.'
        ELSE 'Claim scored ' || points || '/100 — below human review threshold. '
          || 'Primary risk factor: ' || driver || ' ('
          || CAST(round_even(greatest(b1, b2, b3), 0) AS INT) || '% attribution).' END
        AS provider_explanation,
      false AS ai_decision_only, true AS reconsideration_right,
      CASE WHEN bad_npi THEN 'failed FHIR validation' ELSE driver END AS primary_driver,
      CASE WHEN bad_npi THEN '{"validation_failed":100.0}'
        ELSE '{"billed_amount":' || b1 || ',"prior_auth":' || b2 || ',"diagnosis_code_count":'
          || b3 || ',"procedure_complexity":' || b0 || ',"provider_specialty_code":' || b0
          || ',"days_since_service":' || b0 || '}' END AS decision_basis
    FROM (SELECT * REPLACE (coalesce(bad_npi, false) AS bad_npi) FROM shares)
"""

SQL = {
    "F3_bronze_to_silver": with_ctes(_SILVER_SQL, "shares"),
    "F3_incremental": with_ctes(_SILVER_SQL, "shares"),
    "S3_fhir_bundle": with_ctes(
        """SELECT claim_id, fhir_json FROM fhir WHERE order_key % 5 = 0 OR order_key % 7 <> 0""",
        "fhir",
    ),
    "S8_keyed_upsert": with_ctes(
        """SELECT claim_id, CAST(billed_amount AS DOUBLE)
          + CASE WHEN order_status <> 'F' THEN 1 ELSE 0 END AS billed_amount, service_date,
          denial_risk_score FROM claims""",
        "claims",
    ),
    "S10_cluster": with_ctes(
        """SELECT count(*) AS claims, count(DISTINCT claim_id) AS keys, min(service_date) AS first_day,
          true AS skips_by_claim, true AS skips_by_date FROM claims""",
        "claims",
    ),
    "S12_typed_table": with_ctes(
        """SELECT claim_id, billed_amount, service_date, CAST(NULL AS VARCHAR) AS payer_id,
          human_review_required FROM claims""",
        "claims",
    ),
    "S12_typed_remittance": with_ctes(
        "SELECT * REPLACE (CAST(date_of_service AS DATE) AS date_of_service) FROM remittance",
        "remittance",
    ),
    "S13_refresh": with_ctes(
        """SELECT kind, status, count(*) AS claims, any_value(paid) AS before, any_value(paid) AS unrefreshed
        FROM remittance, (SELECT count(*) AS paid FROM remittance WHERE status = 'paid'),
          (VALUES ('plain'), ('partitioned')) t(kind)
        GROUP BY kind, status""",
        "remittance",
    ),
    "W1_latest_per_key": with_ctes(
        f"""SELECT claim_id, service_date + {_LATEST} AS received,
          CAST(billed_amount + {_LATEST} AS DOUBLE) AS billed_amount FROM claims""",
        "claims",
    ),
}
