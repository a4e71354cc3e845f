"""Claims, enrollment and remittance derived from the star-schema tables.

One claim per order, one enrolled member per customer.  Every table grows with its
star-schema source, so queries over them scale with the data they are pointed at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimworks.operators import adjudicate as adj
from claimworks.operators import fhir

DIAGNOSES = ["I21.09", "M79.3", "J06.9", "M54.5", "Z00.00"]
PROCEDURES = [
    "99211", "99212", "99213", "99214", "99215", "99291",
    "93000", "93458", "27447", "15820", "0191T", "99999",
]
PAYER = "PYR0001"
MONEY = "decimal(12,2)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _padded(prefix: str, key: Column) -> Column:
    """``prefix`` and the key, filled up to eight digits; longer keys stay whole."""
    text = key.cast("string")
    return F.concat(F.lit(prefix), F.lpad(text, F.greatest(F.length(text), F.lit(8)), F.lit("0")))


def _doubled(digit: Column) -> Column:
    return digit * 2 - F.when(digit >= 5, 9).otherwise(0)


def npi_of_supplier(s: Column) -> Column:
    """A ten-digit identifier; suppliers ending in 7 get a wrong check digit.

    An identifier has room for eight supplier digits, so numbers wrap at 100,000,000.
    """
    number = s % 100_000_000
    luhn = F.lit(26)  # the issuer prefix and the leading 1
    for place in range(8):
        digit = F.floor(number / 10**place) % 10
        luhn = luhn + (_doubled(digit) if place % 2 == 0 else digit)
    check = (F.lit(10) - luhn % 10 + F.when(s % 10 == 7, 1).otherwise(0)) % 10
    return F.concat(_padded("1", number), check.cast("string"))


def claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.min("l_suppkey").alias("s"))
        # Both sides by key at any size: orders may come in few splits, and the text made and parsed
        # from each claim afterwards is worth the exchange.
        .hint("merge")
    )
    key = F.col("o_orderkey")
    priority = F.substring("o_orderpriority", 1, 1).cast("int")
    billed = (F.floor(F.col("o_totalprice") * 2) / 100).cast(MONEY)
    base = (
        table(spark, sf_dir, "orders")
        .join(suppliers, "o_orderkey", "left")
        .select(
            _padded("CLM-", key).alias("claim_id"),
            _padded("MBR", F.col("o_custkey")).alias("patient_id"),
            npi_of_supplier(F.col("s")).alias("billing_npi"),
            _pick(DIAGNOSES, priority - 1).alias("primary_diagnosis_code"),
            _pick(PROCEDURES, key % 12).alias("procedure_code"),
            billed.alias("billed_amount"),
            F.to_date("o_orderdate").alias("service_date"),
            F.date_add(F.to_date("o_orderdate"), (key % 240).cast("int")).alias("filed_date"),
            F.when(priority <= 2, _padded("AUTH", key)).alias("prior_auth_number"),
            (key % 10 + 1).cast("int").alias("dx_count"),
            (priority - 1).alias("dx_first"),
            (key % 240).cast("int").alias("lag_days"),
            key.alias("order_key"),
            F.col("o_orderstatus").alias("order_status"),
            F.col("s").alias("supplier"),
        )
    )
    score = (
        F.when(F.col("billed_amount") > 800, 50).otherwise(0)
        + F.when(F.col("prior_auth_number").isNull(), 35).otherwise(0)
        + F.when(F.col("dx_count") > 5, 10).otherwise(0)
        + F.when(F.col("lag_days") > 90, 5).otherwise(0)
    )
    return (
        base.withColumn("denial_risk_score", score.cast("int"))
        .withColumn("human_review_required", F.col("denial_risk_score") >= 70)
    )


def diagnosis_list(dx_first: Column, dx_count: Column) -> Column:
    """``dx_count`` codes, cycling from the primary one."""
    return F.transform(
        F.sequence(F.lit(0), dx_count - 1), lambda i: _pick(DIAGNOSES, (dx_first + i) % 5)
    )


def parsed_claims(claims_df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Claims in the shape of a parsed X12 claim."""
    return claims_df.select(
        *keep,
        F.col("claim_id").alias("transaction_id"),
        F.coalesce("billing_npi", F.lit("")).alias("billing_npi"),
        F.lit("").alias("rendering_npi"),
        F.col("patient_id").alias("patient_member_id"),
        F.date_format("service_date", "yyyyMMdd").alias("date_of_service"),
        diagnosis_list(F.col("dx_first"), F.col("dx_count")).alias("diagnosis_codes"),
        F.array("procedure_code").alias("procedure_codes"),
        F.col("billed_amount").cast("double").alias("billed_amount"),
        F.col("prior_auth_number"),
    )


def enrollment(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return (
        table(spark, sf_dir, "customer")
        .where(key % 20 != 0)
        .select(
            _padded("MBR", key).alias("member_id"),
            F.date_add(F.lit("1995-01-01").cast("date"), (key % 365).cast("int")).alias(
                "coverage_start"
            ),
            F.date_add(F.lit("2000-12-31").cast("date"), (key % 200).cast("int")).alias(
                "coverage_end"
            ),
            _pick(["PPO", "HMO", "EPO", "POS"], key % 4).alias("plan_type"),
            F.lit(PAYER).alias("payer_id"),
            F.concat(F.lit("GRP"), F.col("c_nationkey").cast("string")).alias("group_number"),
        )
    )


def coverage_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three coverage spans per enrolled customer, some with gaps between them, some overlapping."""
    key, i = F.col("c_custkey"), F.col("i")
    start = F.date_add(F.lit("1992-01-01").cast("date"), (i * 900 + key % 200).cast("int"))
    return (
        table(spark, sf_dir, "customer")
        .where(key % 20 != 0)
        .withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(2))))
        .select(
            _padded("MBR", key).alias("member_id"),
            start.alias("coverage_start"),
            F.date_add(start, (500 + key % 7 * 100).cast("int")).alias("coverage_end"),
            _pick(["PPO", "HMO", "EPO", "POS"], (key + i) % 4).alias("plan_type"),
            F.lit(PAYER).alias("payer_id"),
            F.concat(F.lit("GRP"), F.col("c_nationkey").cast("string")).alias("group_number"),
        )
    )


def adjudication_input(claims_df: DataFrame) -> DataFrame:
    """Claims under the column names adjudication reads."""
    return claims_df.select(
        "claim_id",
        F.col("patient_id").alias("member_id"),
        F.col("service_date").alias("dos"),
        "filed_date",
        F.col("billed_amount"),
        F.col("prior_auth_number").alias("prior_auth"),
        F.array("procedure_code").alias("cpts"),
        "order_key",
        "order_status",
    )


def adjudicated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adj.adjudicate(
        adjudication_input(claims(spark, sf_dir)),
        enrollment(spark, sf_dir),
        as_of=F.col("filed_date"),
        keep=["order_key", "order_status"],
    )


def remittance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adjudication results of the orders that are not pending."""
    return adj.remittance_record(
        adjudicated(spark, sf_dir).where(F.col("order_status") != "P")
    )


def orphan_remittance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Remittance plus rows whose claim does not exist."""
    rows = adjudicated(spark, sf_dir)
    orphans = rows.where(F.col("order_key") % 1000 == 0).withColumn(
        "claim_id", F.concat(F.lit("X-"), F.col("order_key").cast("string"))
    )
    return adj.remittance_record(
        rows.where(F.col("order_status") != "P")
    ).unionByName(adj.remittance_record(orphans))


def fhir_claims(claims_df: DataFrame) -> DataFrame:
    """``claim_id, fhir_json`` of every claim, with the keys later steps need."""
    keys = ("order_key", "service_date", "filed_date")
    return fhir.map_to_fhir(parsed_claims(claims_df, keys), PAYER, keep=keys)


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One Bronze row per claim, and a later one with a higher amount for every tenth."""
    rows = claims(spark, sf_dir)
    first = F.struct(F.col("billed_amount"), F.col("service_date").cast("timestamp").alias("received_ts"))
    later = F.struct(
        (F.col("billed_amount") + 1).cast(MONEY).alias("billed_amount"),
        F.date_add("service_date", 1).cast("timestamp").alias("received_ts"),
    )
    # Both rows of a claim come from one pass; a union would join and aggregate the tables once more.
    versions = F.when(F.col("order_key") % 10 == 0, F.array(first, later)).otherwise(F.array(first))
    both = rows.withColumn("version", F.explode(versions)).withColumns(
        {"billed_amount": F.col("version.billed_amount"), "received_ts": F.col("version.received_ts")}
    )
    return fhir.map_to_fhir(
        parsed_claims(both, ("received_ts",)), PAYER, keep=["received_ts"]
    ).select("claim_id", "fhir_json", F.col("received_ts").alias("ingest_ts"), "received_ts")


TOTAL_VALUE = r'"total":\{"value":[^,]*'
# (pattern, replacement) per way a claim's JSON is damaged.
DAMAGE = [
    (r"^(.{40}).*$", "$1"),
    (r"^.*$", "{}"),
    (r'"patient":\{[^}]*\}', '"patient":null'),
    (TOTAL_VALUE, '"total":{"value":null'),
    (TOTAL_VALUE, '"total":{"value":"350"'),
    (TOTAL_VALUE, '"total":{"value":0'),
    (TOTAL_VALUE, '"total":{"value":-5'),
    (r'"diagnosis":\[.*\],"item"', '"diagnosis":[],"item"'),
    (r'"item":\[.*\],"total"', '"item":[],"total"'),
    (r'"id":"[^"]*",', ""),
    (r'"id":"[^"]*",', '"id":"",'),
    ('"resourceType":"Claim"', '"resourceType":"Coverage"'),
    (r'us-npi","value":"[^"]*"', 'us-npi","value":"9990000001"'),
    (r'"created":"[^"]*"', '"created":""'),
    (r'"created":"[^"]*"', '"created":"2026-13-01"'),
    (r'"_prior_auth":("[^"]*"|null)', '"_prior_auth":""'),
]


def spoiled(claims_df: DataFrame) -> DataFrame:
    """Every claim's JSON damaged in one of sixteen ways, by order key."""
    way = F.col("order_key") % len(DAMAGE)
    # A pattern that is a literal is compiled once; one that comes from a column, at every change of row.
    damaged = F.col("fhir_json")
    for i, (pattern, replacement) in enumerate(DAMAGE):
        damaged = F.when(way == i, F.regexp_replace("fhir_json", pattern, replacement)).otherwise(damaged)
    # Behind a one-element explode, so that later references do not repeat the JSON in every branch.
    return fhir_claims(claims_df).withColumn("fhir_json", F.explode(F.array(damaged)))
