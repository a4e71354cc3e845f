"""Eligibility, fee lookup, code sets, adjudication, roll-up and routing."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimworks import fixed_values as fv
from claimworks.fixtures import star
from claimworks.functions import scalars
from claimworks.operators import adjudicate as adj
from claimworks.operators import eligibility, rollup
from claimworks.plans import quality
from claimworks.registry.sql_base import FEE_CASE, REMIT_COLUMNS, cte, with_ctes


def _lines(spark, sf):
    """Service lines: one per order line, coded by part, charged at the extended price."""
    key = F.col("l_orderkey")
    return star.table(spark, sf, "lineitem").select(
        star._padded("CLM-", key).alias("claim_id"),
        F.col("l_linenumber").alias("ord"),
        star._pick(star.PROCEDURES, F.col("l_partkey") % 12).alias("cpt"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("charge"),
    )


def j2(spark, sf):
    return quality.orphan_remittance(
        star.orphan_remittance(spark, sf), star.claims(spark, sf)
    )


def j3(spark, sf):
    out = eligibility.check_eligibility(
        star.adjudication_input(star.claims(spark, sf)), star.enrollment(spark, sf)
    )
    return out.select(
        "claim_id", "member_id", "dos", "eligible", "eligibility_reason", "plan_type",
        "payer_id", "group_number",
    )


def j3_spans(spark, sf):
    """Coverage in several spans; every third claim names one and the same member."""
    hot = F.when(F.col("order_key") % 3 == 0, "MBR00000001").otherwise(F.col("member_id"))
    claims = star.adjudication_input(star.claims(spark, sf)).withColumn("member_id", hot)
    return eligibility.check_spans(claims, star.coverage_spans(spark, sf)).select(
        "claim_id", "member_id", "dos", "eligible", "eligibility_reason", "plan_type",
        "payer_id", "group_number",
    )


def j4(spark, sf):
    """Fee lookup of whole claims, each with the codes of all its order lines."""
    claims = rollup.roll_up_lines(_lines(spark, sf))
    fees = spark.createDataFrame(list(fv.FEES.items()), "cpt string, allowed double")
    priced = adj.price_lines(claims.withColumnRenamed("procedure_codes", "cpts"), fees)
    return priced.select(
        "claim_id",
        F.array_join(
            F.transform(
                "procedures",
                lambda p: F.concat_ws("=", p["cpt"], p["allowed"].cast("string")),
            ),
            "|",
        ).alias("priced"),
        adj.allowed_total(F.col("procedures")).alias("allowed_total"),
    )


def j4_literal(spark, sf):
    """The same lookup with the schedule inside the plan: no join, no regrouping."""
    claims = rollup.roll_up_lines(_lines(spark, sf))
    priced = adj.price_codes(F.col("procedure_codes"))
    return claims.select("claim_id", adj.allowed_total(priced).alias("allowed_total"))


def j5(spark, sf):
    claims = rollup.roll_up_lines(_lines(spark, sf))
    codes = F.col("procedure_codes")
    return claims.select(
        "claim_id",
        adj.any_code_in(codes, fv.NON_COVERED_CPTS).alias("non_covered"),
        adj.any_code_in(codes, fv.EXPERIMENTAL_CPTS).alias("experimental"),
        adj.any_code_in(codes, fv.AUTH_REQUIRED_CPTS).alias("auth_required"),
    )


def a6(spark, sf):
    return rollup.roll_up_lines(_lines(spark, sf)).select(
        "claim_id",
        F.array_join("procedure_codes", "|").alias("codes"),
        F.col("billed_amount").cast("decimal(18,2)").alias("billed_amount"),
    )


def b1(spark, sf):
    out = star.adjudicated(spark, sf)
    text = F.transform(
        "procedures", lambda p: F.concat_ws("=", p["cpt"], p["allowed"].cast("string"))
    )
    return out.select(*adj.REMITTANCE_KEYS, F.array_join(text, "|").alias("procedures"))


def b2(spark, sf):
    return star.adjudicated(spark, sf).groupBy("denial_reason", "cas_code").agg(
        F.count("*").alias("claims")
    )


def b3(spark, sf):
    return (
        star.adjudicated(spark, sf)
        .groupBy("denial_reason")
        .agg(
            F.count("*").alias("claims"),
            F.sum("billed_amount").cast("decimal(18,2)").alias("billed"),
            F.sum("paid_amount").cast("decimal(18,2)").alias("paid"),
            F.sum("cas_amount").cast("decimal(18,2)").alias("adjusted"),
        )
    )


def b5(spark, sf):
    return star.table(spark, sf, "events").select(
        "event_id", scalars.route_topic(F.col("value") / 500).alias("topic")
    )


QUERIES = {
    "A6_line_rollup": a6,
    "B1_adjudicate": b1,
    "B2_cas_codes": b2,
    "B3_amounts": b3,
    "B5_route_topic": b5,
    "J2_orphan_anti_join": j2,
    "J3_eligibility": j3,
    "J3_coverage_spans": j3_spans,
    "J4_fee_lookup": j4,
    "J4_fee_literal": j4_literal,
    "J5_code_sets": j5,
}

cte(
    "lines",
    f"""
    SELECT 'CLM-' || printf('%08d', l_orderkey) AS claim_id, l_linenumber AS ord,
      ['99211','99212','99213','99214','99215','99291','93000','93458','27447','15820',
       '0191T','99999'][l_partkey % 12 + 1] AS cpt,
      CAST(l_extendedprice AS DECIMAL(12,2)) AS charge
    FROM lineitem
    """,
)
_ALLOWED = f"CAST({FEE_CASE.format(c='cpt')} AS DECIMAL(12,2))"

SQL = {
    "A6_line_rollup": with_ctes(
        """SELECT claim_id, string_agg(cpt, '|' ORDER BY ord, cpt) AS codes,
          CAST(sum(charge) AS DECIMAL(18,2)) AS billed_amount FROM lines GROUP BY claim_id""",
        "lines",
    ),
    "B1_adjudicate": with_ctes(
        f"""SELECT {REMIT_COLUMNS}, procedure_code || '=' || CAST(allowed AS VARCHAR)
          AS procedures FROM adjudicated""",
        "adjudicated",
    ),
    "B2_cas_codes": with_ctes(
        """SELECT denial_reason, cas_code, count(*) AS claims FROM adjudicated
        GROUP BY denial_reason, cas_code""",
        "adjudicated",
    ),
    "B3_amounts": with_ctes(
        """SELECT denial_reason, count(*) AS claims,
          CAST(sum(billed_amount) AS DECIMAL(18,2)) AS billed,
          CAST(sum(paid_amount) AS DECIMAL(18,2)) AS paid,
          CAST(sum(cas_amount) AS DECIMAL(18,2)) AS adjusted
        FROM adjudicated GROUP BY denial_reason""",
        "adjudicated",
    ),
    "B5_route_topic": """SELECT event_id, CASE
        WHEN CAST(trunc(value / 500 * 100) AS INT) >= 70 THEN 'claims.rejected'
        WHEN CAST(trunc(value / 500 * 100) AS INT) >= 40 THEN 'claims.review_queue'
        ELSE 'claims.validated' END AS topic FROM events""",
    "J2_orphan_anti_join": with_ctes(
        """SELECT r.claim_id FROM orphan_remittance r LEFT JOIN claims c
        ON r.claim_id = c.claim_id WHERE c.claim_id IS NULL""",
        "orphan_remittance", "claims",
    ),
    "J3_eligibility": with_ctes(
        """SELECT claim_id, patient_id AS member_id, service_date AS dos,
          eligibility_reason = 'active_coverage' AS eligible, eligibility_reason, plan_type,
          payer_id, group_number FROM elig""",
        "elig",
    ),
    "J3_coverage_spans": """
        WITH spans AS (
          SELECT 'MBR' || printf('%08d', c_custkey) AS member_id,
            DATE '1992-01-01' + CAST(i * 900 + c_custkey % 200 AS INT) AS coverage_start,
            DATE '1992-01-01' + CAST(i * 900 + c_custkey % 200 + 500 + c_custkey % 7 * 100 AS INT)
              AS coverage_end,
            ['PPO','HMO','EPO','POS'][(c_custkey + i) % 4 + 1] AS plan_type,
            'GRP' || CAST(c_nationkey AS VARCHAR) AS group_number
          FROM customer, range(3) AS r(i) WHERE c_custkey % 20 <> 0),
        visits AS (
          SELECT 'CLM-' || printf('%08d', o_orderkey) AS claim_id,
            CASE WHEN o_orderkey % 3 = 0 THEN 'MBR00000001'
              ELSE 'MBR' || printf('%08d', o_custkey) END AS member_id,
            CAST(o_orderdate AS DATE) AS dos
          FROM orders),
        picked AS (
          SELECT claim_id, arg_max(s, s.coverage_start) AS s FROM visits v JOIN spans s
            ON v.member_id = s.member_id AND s.coverage_start <= v.dos GROUP BY claim_id)
        SELECT v.claim_id, v.member_id, v.dos,
          coalesce(v.dos <= s.coverage_end, false) AS eligible,
          CASE WHEN v.member_id NOT IN (SELECT member_id FROM spans) THEN 'member_not_found'
            WHEN v.dos <= s.coverage_end THEN 'active_coverage'
            ELSE 'coverage_not_active_on_dos' END AS eligibility_reason,
          coalesce(s.plan_type, '') AS plan_type,
          CASE WHEN s IS NULL THEN '' ELSE 'PYR0001' END AS payer_id,
          coalesce(s.group_number, '') AS group_number
        FROM visits v LEFT JOIN picked p ON v.claim_id = p.claim_id""",
    "J4_fee_lookup": with_ctes(
        f"""SELECT claim_id, string_agg(cpt || '=' || CAST({_ALLOWED} AS VARCHAR), '|'
            ORDER BY ord, cpt) AS priced,
          CAST(sum({_ALLOWED}) AS DECIMAL(12,2)) AS allowed_total FROM lines GROUP BY claim_id""",
        "lines",
    ),
    "J4_fee_literal": with_ctes(
        f"""SELECT claim_id, CAST(sum({_ALLOWED}) AS DECIMAL(12,2)) AS allowed_total
        FROM lines GROUP BY claim_id""",
        "lines",
    ),
    "J5_code_sets": with_ctes(
        """SELECT claim_id, bool_or(cpt = '15820') AS non_covered,
          bool_or(cpt = '0191T') AS experimental,
          bool_or(cpt IN ('93458', '27447')) AS auth_required FROM lines GROUP BY claim_id""",
        "lines",
    ),
}
