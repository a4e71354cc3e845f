"""X12 scans and parses over files rendered from the derived tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimworks.fixtures import edi, star
from claimworks.operators import fhir
from claimworks.registry.sql_base import cte, with_ctes
from claimworks.session import scratch_dir
from claimworks.sources import x12, x12_claims, x12_enrollment


def files_837(spark, sf):
    return edi.write_837(star.claims(spark, sf), scratch_dir(spark, "edi837"))


def files_834(spark, sf):
    return edi.write_834(star.enrollment(spark, sf), scratch_dir(spark, "edi834"))


def _parsed(spark, sf):
    return x12_claims.parse_837(spark, files_837(spark, sf))


def s1(spark, sf):
    segments = x12.with_tag(x12.read_segments(spark, files_837(spark, sf)))
    return segments.groupBy("tag").agg(F.count("*").alias("segments"))


def p1(spark, sf):
    return x12_claims.isa_envelopes(spark, files_837(spark, sf)).drop("file")


def p2(spark, sf):
    return x12_claims.transaction_sets(spark, files_837(spark, sf)).select("claims", "billing_npi")


def p3(spark, sf):
    return x12_claims.name_loops(spark, files_837(spark, sf), "85").drop("file", "set_no")


def p4(spark, sf):
    return _parsed(spark, sf).select(
        "transaction_id", "billing_npi", "rendering_npi", "patient_member_id"
    )


def p5(spark, sf):
    return _parsed(spark, sf).select("transaction_id", "date_of_service")


def p6(spark, sf):
    return _parsed(spark, sf).select(
        "transaction_id", F.array_join("diagnosis_codes", "|").alias("codes")
    )


def p7(spark, sf):
    return _parsed(spark, sf).select(
        "transaction_id", F.array_join("procedure_codes", "|").alias("codes"), "billed_amount"
    )


def p8(spark, sf):
    return _parsed(spark, sf).select("transaction_id", "prior_auth_number")


def p9(spark, sf):
    """Every claim as a file of its own, read at whole-file scope."""
    out = x12_claims.single_claims(edi.single_claim_segments(star.claims(spark, sf)))
    return out.select(
        "transaction_id", "billing_npi", "rendering_npi", "patient_member_id", "date_of_service",
        F.array_join("diagnosis_codes", "|").alias("diagnoses"),
        F.array_join("procedure_codes", "|").alias("procedures"),
        "billed_amount", "prior_auth_number", "error",
    )


def p10(spark, sf):
    return x12_enrollment.parse_834(
        spark, files_834(spark, sf), as_of=F.lit("2000-01-01").cast("date")
    )


def s2(spark, sf):
    """837 files to keyed claim messages."""
    return fhir.map_to_fhir(_parsed(spark, sf), star.PAYER).select(
        F.col("claim_id").alias("key"), F.col("fhir_json").alias("value")
    )


def w2(spark, sf):
    """Loop numbers of every claim segment in its file."""
    segments = x12.with_tag(x12.read_segments(spark, files_837(spark, sf)))
    numbered = x12.number_loops(segments, ["ST", "HL", "CLM"])
    own = numbered.where("tag = 'CLM'")
    # Every claim has its own HL, and each set one more.
    return own.select(
        F.get(F.split("segment", r"\*"), F.lit(1)).alias("claim_id"),
        F.col("no_CLM").alias("clm_no"),
        (F.col("no_HL") - F.col("no_ST")).alias("own_hl_no"),
    )


QUERIES = {
    "P1_isa_envelope": p1,
    "P2_transaction_sets": p2,
    "P3_name_loop": p3,
    "P4_claim_loops": p4,
    "P5_service_date": p5,
    "P6_diagnosis_list": p6,
    "P7_procedure_list": p7,
    "P8_prior_auth": p8,
    "P9_single_claim_file": p9,
    "P10_enrollment_834": p10,
    "S1_segment_scan": s1,
    "S2_claims_from_837": s2,
    "W2_loop_numbers": w2,
}

cte(
    "keyed",
    """
    SELECT *, order_key // 5000 AS file_no, order_key // 1000 AS stretch,
      coalesce(supplier, -1) AS sup,
      CASE WHEN order_key % 3 = 0 THEN coalesce(billing_npi, '') ELSE '' END AS rendering
    FROM claims
    """,
    "claims",
)
cte(
    "sets",
    """SELECT file_no, stretch, sup, max(billing_npi) AS npi, count(*) AS claims
    FROM keyed GROUP BY file_no, stretch, sup""",
    "keyed",
)
_DX = """array_to_string(list_transform(range(0, dx_count), lambda i:
  ['I21.09','M79.3','J06.9','M54.5','Z00.00'][(dx_first + i) % 5 + 1]), '|')"""
_S2 = with_ctes(
    """SELECT claim_id AS key, replace(fhir_json, '"_rendering_npi":""',
      '"_rendering_npi":"' || rendering || '"') AS value
    FROM fhir JOIN (SELECT claim_id AS c, rendering FROM keyed) ON c = claim_id""",
    "fhir", "keyed",
)

SQL = {
    "P1_isa_envelope": with_ctes(
        """SELECT DISTINCT 'SUBMITTER01' AS sender_id, 'PAYER01' AS receiver_id,
          '260412' AS interchange_date, lpad(CAST(file_no AS VARCHAR), 9, '0')
          AS interchange_ctrl, '00501' AS version, CAST(NULL AS VARCHAR) AS error FROM keyed""",
        "keyed",
    ),
    "P2_transaction_sets": with_ctes("SELECT claims, npi AS billing_npi FROM sets", "sets"),
    "P3_name_loop": with_ctes(
        """SELECT CASE WHEN npi IS NULL THEN '' ELSE '2' END AS entity_type,
          CASE WHEN npi IS NULL THEN '' ELSE 'GROUP' END AS last_name, '' AS first_name,
          CASE WHEN npi IS NULL THEN '' ELSE 'XX' END AS id_code_qual,
          coalesce(npi, '') AS id_code FROM sets""",
        "sets",
    ),
    "P4_claim_loops": with_ctes(
        """SELECT claim_id AS transaction_id, coalesce(billing_npi, '') AS billing_npi,
          rendering AS rendering_npi, patient_id AS patient_member_id FROM keyed""",
        "keyed",
    ),
    "P5_service_date": with_ctes(
        """SELECT claim_id AS transaction_id, strftime(service_date, '%Y%m%d')
          AS date_of_service FROM claims""",
        "claims",
    ),
    "P6_diagnosis_list": with_ctes(
        f"SELECT claim_id AS transaction_id, {_DX} AS codes FROM claims", "claims"
    ),
    "P7_procedure_list": with_ctes(
        """SELECT claim_id AS transaction_id, procedure_code AS codes,
          CAST(billed_amount AS DOUBLE) AS billed_amount FROM claims""",
        "claims",
    ),
    "P8_prior_auth": with_ctes(
        "SELECT claim_id AS transaction_id, prior_auth_number FROM claims", "claims"
    ),
    "P9_single_claim_file": with_ctes(
        f"""SELECT claim_id AS transaction_id, coalesce(billing_npi, '') AS billing_npi,
          rendering AS rendering_npi, patient_id AS patient_member_id,
          strftime(service_date, '%Y%m%d') AS date_of_service, {_DX} AS diagnoses,
          procedure_code AS procedures, CAST(billed_amount AS DOUBLE) AS billed_amount,
          prior_auth_number, CAST(NULL AS VARCHAR) AS error FROM keyed""",
        "keyed",
    ),
    "P10_enrollment_834": with_ctes(
        """SELECT member_id, coverage_start,
          CASE WHEN k % 50 = 1 THEN coverage_end + 365 ELSE coverage_end END AS coverage_end,
          CASE WHEN k % 50 = 1 THEN 'CUSTOM' ELSE plan_type END AS plan_type, payer_id,
          group_number
        FROM (SELECT *, CAST(substr(member_id, 4) AS BIGINT) AS k FROM enrollment)""",
        "enrollment",
    ),
    "S1_segment_scan": with_ctes(
        """, n AS (SELECT count(*) AS claims, count(prior_auth_number) AS auths,
            count(DISTINCT file_no) AS files,
            count(*) FILTER (order_key % 3 = 0) AS rendered FROM keyed),
          m AS (SELECT count(*) AS sets, count(npi) AS billed FROM sets)
        SELECT unnest(['ISA', 'GS', 'GE', 'IEA', 'ST', 'BHT', 'SE', 'HL', 'NM1', 'N3', 'CLM',
            'REF', 'HI', 'LX', 'SV1', 'DTP']) AS tag,
          unnest([files, files, files, files, sets, sets, sets, sets + claims,
            claims + billed + rendered, claims, claims, auths, claims, claims, claims, claims])
            AS segments FROM n, m""",
        "sets",
    ),
    "S2_claims_from_837": _S2,
    "W2_loop_numbers": with_ctes(
        """SELECT claim_id, row_number() OVER w AS clm_no, row_number() OVER w AS own_hl_no
        FROM keyed WINDOW w AS (PARTITION BY file_no ORDER BY stretch, sup, order_key)""",
        "keyed",
    ),
}
