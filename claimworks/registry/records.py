"""Claim JSON: mapping, extraction, validation, and the record-level projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimworks import fixed_values as fv
from claimworks.fixtures import star
from claimworks.functions import scalars
from claimworks.operators import adjudicate as adj
from claimworks.operators import fhir, remit, validate
from claimworks.plans import lake
from claimworks.registry.sql_base import REMIT_COLUMNS, cte, with_ctes
from claimworks.session import scratch_dir


def f1(spark, sf):
    out = fhir.map_to_fhir(star.parsed_claims(star.claims(spark, sf)), star.PAYER)
    return out.select("claim_id", "fhir_json")


def _spoiled(spark, sf):
    return star.spoiled(star.claims(spark, sf))


def f2(spark, sf):
    """Typed columns of the readable rows among the damaged ones."""
    columns = fhir.extract_columns()
    return (
        lake.parse_bronze(_spoiled(spark, sf))
        .where("drop_reason IS NULL")
        .select("order_key", *[c.alias(n) for n, c in columns.items()])
    )


def f2_quarantine(spark, sf):
    return lake.quarantine(_spoiled(spark, sf)).select("order_key", "drop_reason")


def v1(spark, sf):
    return star.claims(spark, sf).select(
        "claim_id", "billing_npi", scalars.npi_is_valid(F.col("billing_npi")).alias("npi_valid")
    )


def v2(spark, sf):
    return validate.validated(_spoiled(spark, sf)).select(
        "order_key", "is_valid", F.array_join("errors", "|").alias("errors")
    )


def v3(spark, sf):
    return (
        fhir.with_variant(_spoiled(spark, sf))
        .where("is_object")
        .select("order_key", F.array_join(validate.missing_fields(), "|").alias("missing"))
    )


def v4(spark, sf):
    claims = star.fhir_claims(star.claims(spark, sf)).select("claim_id", "fhir_json")
    return validate.checked_claims(claims).withColumn("errors", F.array_join("errors", "|"))


def f4(spark, sf):
    """Member and service date; unreadable dates fall back to the filing date."""
    return fhir.with_variant(_spoiled(spark, sf)).where("is_object").select(
        "order_key",
        *[
            fhir.adjudication_columns(F.col("filed_date"))[n].alias(n)
            for n in ("member_id", "dos")
        ],
    )


def b4(spark, sf):
    claims = star.fhir_claims(star.claims(spark, sf))
    out = validate.process_messages(
        claims, star.enrollment(spark, sf), as_of=F.col("filed_date"), json="fhir_json",
        keep=["filed_date"],
    )
    return out.select("topic", "key", "value", "outcome")


def a8(spark, sf):
    spoiled = _spoiled(spark, sf)
    out = validate.process_messages(
        spoiled, star.enrollment(spark, sf), as_of=F.col("filed_date"), json="fhir_json",
        keep=["filed_date"],
    )
    return validate.run_statistics(out)


def f5(spark, sf):
    """Remittance messages back to typed rows; damaged messages drop out."""
    records = star.remittance(spark, sf)
    texts = records.select(
        F.to_json(
            F.struct(*[
                F.col(n).cast("double").alias(n) if n.endswith("amount") else F.col(n)
                for n in adj.REMITTANCE_KEYS
            ])
        ).alias("value")
    )
    broken = texts.select(F.substring("value", 1, 30).alias("value"))
    return remit.parse_records(texts.unionByName(broken)).drop("processed_ts")


def f6(spark, sf):
    return adj.remittance_record(star.adjudicated(spark, sf))


def s15(spark, sf):
    stamp = F.to_timestamp(F.lit("2026-04-12 09:00:00"))
    parties = remit.Parties(payer_id=star.PAYER, submitter_id="SUB0001")
    return star.adjudicated(spark, sf).select(
        "claim_id", remit.text_835(stamp, parties).alias("edi")
    )


def s15_interchanges(spark, sf):
    """Interchanges of seven claims, written as files, read back and cut at their first segment."""
    stamp = F.to_timestamp(F.lit("2026-04-12 09:00:00"))
    parties = remit.Parties(payer_id=star.PAYER, submitter_id="SUB0001")
    path = scratch_dir(spark, "remittance")
    remit.write_835(star.adjudicated(spark, sf), path, stamp, parties, per_file=7, first=101)
    texts = spark.read.option("lineSep", "ISA*00*").text(path).where("value <> ''")
    control = F.regexp_extract("value", r"IEA\*1\*(\d+)~", 1)
    return texts.select(control.alias("control"), F.rtrim(F.col("value"), F.lit("\n")).alias("edi"))


def p11(spark, sf):
    code = F.concat_ws("-", F.lit("PLN"), "c_mktsegment", star._pick(
        ["ppo", "HMO", "xEPOx", "POS", "ABC"], F.col("c_custkey") % 5))
    blank = F.when(F.col("c_custkey") % 5 == 4, F.lit("")).otherwise(code)
    return star.table(spark, sf, "customer").select(
        "c_custkey",
        scalars.plan_type(code).alias("plan_type"),
        scalars.plan_type(blank).alias("plan_or_unknown"),
    )


def p12(spark, sf):
    raw = F.when(F.col("o_orderkey") % 7 == 0, "20011340").otherwise(
        F.date_format("o_orderdate", "yyyyMMdd")
    )
    return star.table(spark, sf, "orders").select(
        "o_orderkey", scalars.edi_date(raw, F.lit("1999-09-09").cast("date")).alias("day")
    )


def p13(spark, sf):
    raw = F.when(F.col("o_orderkey") % 7 == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise(
        F.date_format("o_orderdate", "yyyyMMdd")
    )
    return star.table(spark, sf, "orders").select(
        "o_orderkey", scalars.iso_date_text(raw).alias("iso")
    )


QUERIES = {
    "A8_run_statistics": a8,
    "B4_process_claims": b4,
    "F1_fhir_claim": f1,
    "F2_fhir_extract": f2,
    "F2_quarantine": f2_quarantine,
    "F4_member_service_date": f4,
    "F5_remittance_parse": f5,
    "F6_remittance_record": f6,
    "P11_plan_type": p11,
    "P12_edi_date": p12,
    "P13_iso_date": p13,
    "S15_remittance_835": s15,
    "S15_interchanges": s15_interchanges,
    "V1_npi_check": v1,
    "V2_claim_validation": v2,
    "V3_missing_fields": v3,
    "V4_split_valid": v4,
}

# The n-th diagnosis of a claim cycles through the five codes from the primary one.
_DX = "['I21.09','M79.3','J06.9','M54.5','Z00.00'][(dx_first + i) % 5 + 1]"
_BILLED = "CAST(CAST(billed_amount AS DOUBLE) AS VARCHAR)"
_USD = f"""'{{"value":' || {_BILLED} || ',"currency":"USD"}}'"""
_DAY = "strftime(service_date, '%Y-%m-%d')"
cte(
    "fhir",
    f"""
    SELECT claim_id, order_key, '{{"resourceType":"Claim","id":"' || claim_id
      || '","status":"active","type":{{"coding":[{{"system":"{fv.SYSTEM_CLAIM_TYPE}",'
      || '"code":"professional"}}]}},"use":"claim","patient":{{"reference":"Patient/'
      || patient_id || '"}},"created":"' || {_DAY}
      || '","insurer":{{"identifier":{{"value":"PYR0001"}}}},"provider":{{"identifier":'
      || '{{"system":"{fv.SYSTEM_NPI}","value":"' || coalesce(billing_npi, '')
      || '"}}}},"priority":{{"coding":[{{"code":"normal"}}]}},"diagnosis":['
      || array_to_string(list_transform(range(0, dx_count), lambda i:
           '{{"sequence":' || CAST(i + 1 AS VARCHAR) || ',"diagnosisCodeableConcept":'
           || '{{"coding":[{{"system":"{fv.SYSTEM_ICD10}","code":"' || {_DX} || '"}}]}}}}'), ',')
      || '],"item":[{{"sequence":1,"productOrService":{{"coding":[{{"system":'
      || '"{fv.SYSTEM_CPT}","code":"' || procedure_code || '"}}]}},"servicedDate":"' || {_DAY}
      || '","unitPrice":' || {_USD} || ',"net":' || {_USD} || '}}],"total":' || {_USD}
      || ',"_denial_risk_score":null,"_prior_auth":'
      || coalesce('"' || prior_auth_number || '"', 'null') || ',"_rendering_npi":""}}'
      AS fhir_json
    FROM claims
    """,
    "claims",
)
cte("way", "SELECT *, order_key % 16 AS w FROM claims", "claims")
_NPI_ERROR = (
    "CASE WHEN supplier % 10 = 7 THEN ['invalid_billing_npi:' || billing_npi] ELSE [] END"
)
_ALL_MISSING = "[" + ", ".join(f"'missing_required_field:{f}'" for f in fv.REQUIRED_FIELDS) + "]"
cte(
    "errors",
    f"""
    SELECT order_key, w, CASE WHEN w = 0 THEN NULL
      WHEN w = 1 THEN {_ALL_MISSING} || ['wrong_resource_type', 'empty_diagnosis_array',
        'empty_item_array', 'invalid_total_value']
      WHEN w = 12 THEN ['invalid_billing_npi:9990000001']
      ELSE CASE w WHEN 2 THEN ['missing_required_field:patient']
        WHEN 3 THEN ['invalid_total_value'] WHEN 4 THEN ['invalid_total_value']
        WHEN 5 THEN ['invalid_total_value'] WHEN 6 THEN ['invalid_total_value']
        WHEN 7 THEN ['missing_required_field:diagnosis', 'empty_diagnosis_array']
        WHEN 8 THEN ['missing_required_field:item', 'empty_item_array']
        WHEN 9 THEN ['missing_required_field:id'] WHEN 10 THEN ['missing_required_field:id']
        WHEN 11 THEN ['wrong_resource_type'] ELSE [] END || {_NPI_ERROR} END AS errors
    FROM way
    """,
    "way",
)
cte(
    "processed",
    f"""
    SELECT a.*, c.billing_npi, c.supplier, r.eligibility_reason,
      CASE WHEN c.supplier % 10 = 7 THEN 'rejected_validation'
        WHEN r.eligibility_reason <> 'active_coverage' THEN 'rejected_eligibility'
        ELSE a.status END AS outcome
    FROM adjudicated a JOIN claims c ON a.claim_id = c.claim_id
      JOIN ruled r ON r.claim_id = a.claim_id
    """,
    "adjudicated", "claims", "ruled",
)


def _amount(name: str) -> str:
    return f"CAST(CAST({name} AS DOUBLE) AS VARCHAR)"


PROCESSED_MESSAGES = f"""
    SELECT CASE WHEN outcome IN ('paid', 'denied') THEN 'remittance.835' ELSE 'claims.rejected'
      END AS topic, claim_id AS key,
      CASE outcome WHEN 'rejected_validation' THEN '{{"claim_id":"' || claim_id
          || '","reason":"validation_failed","errors":["invalid_billing_npi:' || billing_npi
          || '"]}}'
        WHEN 'rejected_eligibility' THEN '{{"claim_id":"' || claim_id
          || '","reason":"eligibility_failed","eligibility_reason":"' || eligibility_reason
          || '","member_id":"' || member_id || '"}}'
        ELSE '{{"claim_id":"' || claim_id || '","member_id":"' || member_id
          || '","date_of_service":"' || date_of_service || '","status":"' || status
          || '","billed_amount":' || {_amount('billed_amount')} || ',"paid_amount":'
          || {_amount('paid_amount')} || ',"cas_amount":' || {_amount('cas_amount')}
          || ',"cas_code":"' || cas_code || '","denial_reason":"' || denial_reason || '"}}'
      END AS value, outcome
    FROM processed
"""

SQL = {
    "F1_fhir_claim": with_ctes("SELECT claim_id, fhir_json FROM fhir", "fhir"),
    "F2_fhir_extract": with_ctes(
        """SELECT order_key, claim_id, patient_id,
          CASE WHEN w = 12 THEN '9990000001' ELSE coalesce(billing_npi, '') END AS billing_npi,
          CASE WHEN w = 7 THEN NULL ELSE primary_diagnosis_code END AS primary_diagnosis_code,
          CASE WHEN w = 8 THEN NULL ELSE procedure_code END AS procedure_code,
          CASE w WHEN 4 THEN 350 WHEN 5 THEN 0 WHEN 6 THEN -5
            ELSE CAST(billed_amount AS DOUBLE) END AS billed_amount,
          CASE WHEN w IN (13, 14) THEN NULL ELSE service_date END AS service_date,
          CASE WHEN w = 15 THEN '' ELSE prior_auth_number END AS prior_auth_number,
          CASE WHEN w = 11 THEN 'Coverage' ELSE 'Claim' END AS fhir_resource_type,
          'PYR0001' AS payer_id, 'kafka/fhir' AS source_system
        FROM way WHERE w NOT IN (0, 1, 2, 3, 9, 10)""",
        "way",
    ),
    "F2_quarantine": with_ctes(
        """SELECT order_key, CASE w WHEN 0 THEN 'unparseable' WHEN 2 THEN 'bad_patient'
          WHEN 3 THEN 'bad_total' ELSE 'blank_claim_id' END AS drop_reason
        FROM way WHERE w IN (0, 1, 2, 3, 9, 10)""",
        "way",
    ),
    "F4_member_service_date": with_ctes(
        """SELECT order_key, CASE WHEN w IN (1, 2) THEN '' ELSE patient_id END AS member_id,
          CASE WHEN w IN (1, 8) THEN filed_date ELSE service_date END AS dos
        FROM way WHERE w <> 0""",
        "way",
    ),
    "F5_remittance_parse": with_ctes(
        f"""SELECT {REMIT_COLUMNS} FROM remittance""".replace(
            "billed_amount", "CAST(billed_amount AS DOUBLE) AS billed_amount"
        ).replace("paid_amount", "CAST(paid_amount AS DOUBLE) AS paid_amount").replace(
            "cas_amount", "CAST(cas_amount AS DOUBLE) AS cas_amount"
        ),
        "remittance",
    ),
    "F6_remittance_record": with_ctes(f"SELECT {REMIT_COLUMNS} FROM adjudicated", "adjudicated"),
    "V1_npi_check": with_ctes(
        """SELECT claim_id, billing_npi, billing_npi IS NOT NULL AND supplier % 10 <> 7
          AS npi_valid FROM claims""",
        "claims",
    ),
    "V2_claim_validation": with_ctes(
        """SELECT order_key, errors IS NOT NULL AND len(errors) = 0 AS is_valid,
          CASE WHEN errors IS NOT NULL THEN array_to_string(errors, '|') END AS errors
        FROM errors""",
        "errors",
    ),
    "V3_missing_fields": with_ctes(
        f"""SELECT order_key, CASE w WHEN 1 THEN '{"|".join(fv.MAPPED_FIELDS)}'
          WHEN 2 THEN 'patient' WHEN 7 THEN 'diagnosis' WHEN 8 THEN 'item' WHEN 9 THEN 'id'
          WHEN 10 THEN 'id' WHEN 13 THEN 'created' ELSE '' END AS missing
        FROM way WHERE w <> 0""",
        "way",
    ),
    "V4_split_valid": with_ctes(
        """SELECT claim_id, CASE WHEN supplier % 10 = 7 THEN 'validation_failed' ELSE 'valid' END
          AS reason, CASE WHEN supplier % 10 = 7 THEN 'invalid_billing_npi:' || billing_npi
          ELSE '' END AS errors FROM claims""",
        "claims",
    ),
    "B4_process_claims": with_ctes(PROCESSED_MESSAGES, "processed"),
    "A8_run_statistics": with_ctes(
        """SELECT count(*) FILTER (outcome IN ('paid', 'denied')) AS processed,
          count(*) FILTER (outcome = 'paid') AS paid,
          count(*) FILTER (outcome = 'denied') AS denied,
          count(*) FILTER (outcome = 'rejected') AS rejected,
          count(*) FILTER (outcome = 'failed') AS failed
        FROM (SELECT e.order_key, CASE WHEN e.w = 0 THEN 'failed'
            WHEN len(e.errors) > 0 THEN 'rejected'
            WHEN r.eligibility_reason <> 'active_coverage' THEN 'rejected'
            WHEN r.filed_date - r.service_date > 180 THEN 'denied'
            WHEN r.procedure_code IN ('15820', '0191T') THEN 'denied'
            WHEN (r.procedure_code IN ('93458', '27447') OR r.billed_amount > 1000)
              AND (r.prior_auth_number IS NULL OR e.w = 15) THEN 'denied'
            ELSE 'paid' END AS outcome
          FROM errors e JOIN ruled r ON e.order_key = r.order_key) AS outcomes""",
        "errors", "ruled",
    ),
    "S15_remittance_835": with_ctes(
        """SELECT claim_id,
          'ISA*00*          *00*          *30*PYR0001        *30*SUB0001        *260412*0900*^'
          || '*00501*412090000*0*P*:~' || chr(10)
          || 'GS*HP*PYR0001*SUB0001*20260412*0900*412090000*X*005010X221A1~' || chr(10)
          || 'ST*835*412090000~' || chr(10)
          || 'BPR*I*' || CAST(paid_amount AS VARCHAR) || '*C*CHK*01*000000000*DA*000000000*1*'
          || 'PYR0001*01*000000000*DA*000000000*20260412~' || chr(10)
          || 'TRN*1*412090000*PYR0001~' || chr(10)
          || 'CLP*' || claim_id || '*' || CASE WHEN status = 'paid' THEN '1' ELSE '4' END || '*'
          || CAST(billed_amount AS VARCHAR) || '*' || CAST(paid_amount AS VARCHAR)
          || '**PYR0001*HC*' || claim_id || '*11~' || chr(10)
          || 'NM1*QC*1*UNKNOWN*UNKNOWN****MI*' || member_id || '~' || chr(10)
          || CASE WHEN cas_amount > 0 THEN 'CAS*' || split_part(cas_code, '-', 1) || '*'
            || split_part(cas_code, '-', 2) || '*' || CAST(cas_amount AS VARCHAR) || '~' || chr(10)
            ELSE '' END
          || 'SVC*HC:' || procedure_code || '*' || CAST(allowed AS VARCHAR) || '*0~' || chr(10)
          || 'SE*' || CASE WHEN cas_amount > 0 THEN '8' ELSE '7' END || '*412090000~' || chr(10)
          || 'GE*1*412090000~' || chr(10) || 'IEA*1*412090000~' AS edi
        FROM adjudicated""",
        "adjudicated",
    ),
    "S15_interchanges": with_ctes(
        """SELECT control,
          '          *00*          *30*PYR0001        *30*SUB0001        *260412*0900*^*00501*' || control
          || '*0*P*:~' || chr(10) || 'GS*HP*PYR0001*SUB0001*20260412*0900*' || control
          || '*X*005010X221A1~' || chr(10) || string_agg(
            'ST*835*' || st || '~' || chr(10)
            || 'BPR*I*' || CAST(paid_amount AS VARCHAR) || '*C*CHK*01*000000000*DA*000000000*1*'
            || 'PYR0001*01*000000000*DA*000000000*20260412~' || chr(10)
            || 'TRN*1*' || control || st || '*PYR0001~' || chr(10)
            || 'CLP*' || claim_id || '*' || CASE WHEN status = 'paid' THEN '1' ELSE '4' END || '*'
            || CAST(billed_amount AS VARCHAR) || '*' || CAST(paid_amount AS VARCHAR)
            || '**PYR0001*HC*' || claim_id || '*11~' || chr(10)
            || 'NM1*QC*1*UNKNOWN*UNKNOWN****MI*' || member_id || '~' || chr(10)
            || CASE WHEN cas_amount > 0 THEN 'CAS*' || split_part(cas_code, '-', 1) || '*'
              || split_part(cas_code, '-', 2) || '*' || CAST(cas_amount AS VARCHAR) || '~' || chr(10)
              ELSE '' END
            || 'SVC*HC:' || procedure_code || '*' || CAST(allowed AS VARCHAR) || '*0~' || chr(10)
            || 'SE*' || CASE WHEN cas_amount > 0 THEN '8' ELSE '7' END || '*' || st || '~' || chr(10),
            '' ORDER BY claim_id)
          || 'GE*' || CAST(count(*) AS VARCHAR) || '*' || control || '~' || chr(10)
          || 'IEA*1*' || control || '~' AS edi
        FROM (SELECT *, printf('%09d', (n // 7) + 101) AS control, printf('%04d', n % 7 + 1) AS st
          FROM (SELECT *, row_number() OVER (ORDER BY claim_id) - 1 AS n FROM adjudicated))
        GROUP BY control""",
        "adjudicated",
    ),
    "P11_plan_type": """SELECT c_custkey,
        CASE c_custkey % 5 WHEN 0 THEN 'PPO' WHEN 1 THEN 'HMO' WHEN 2 THEN 'EPO' WHEN 3 THEN 'POS'
          ELSE 'PLN-' || c_mktsegment || '-ABC' END AS plan_type,
        CASE c_custkey % 5 WHEN 0 THEN 'PPO' WHEN 1 THEN 'HMO' WHEN 2 THEN 'EPO' WHEN 3 THEN 'POS'
          ELSE 'UNKNOWN' END AS plan_or_unknown
      FROM customer""",
    "P12_edi_date": """SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN DATE '1999-09-09'
        ELSE CAST(o_orderdate AS DATE) END AS day FROM orders""",
    "P13_iso_date": """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS iso FROM orders""",
}
