"""Adjudication: fee lookup, code-set rules and one CASE cascade."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimworks import fixed_values as fv
from claimworks.operators.eligibility import check_eligibility, today

MONEY = "decimal(12,2)"
REMITTANCE_KEYS = [
    "claim_id", "member_id", "date_of_service", "status", "billed_amount",
    "paid_amount", "cas_amount", "cas_code", "denial_reason",
]
def literal_map(values: dict[str, object], cast: str = "string") -> Column:
    """A constant map, as one expression."""
    def quoted(x) -> str:
        return "'" + str(x).replace("\\", "\\\\").replace("'", "\\'") + "'"

    pairs = [f"{quoted(k)}, cast({quoted(v)} AS {cast})" for k, v in values.items()]
    return F.expr(f"map({', '.join(pairs)})")


def fee_of(code: Column, fees: dict[str, float], default: float = fv.FEE_DEFAULT) -> Column:
    allowed = F.try_element_at(literal_map(fees, MONEY), code)
    return F.coalesce(allowed, F.lit(default).cast(MONEY))


def price_codes(codes: Column, fees: dict[str, float] | None = None) -> Column:
    """Codes to ``array<struct<cpt, allowed>>``, in order and without a shuffle.

    The schedule becomes a constant map inside the plan; one that is data is joined (``priced``).
    """
    fees = fv.FEES if fees is None else fees
    named = F.filter(codes, lambda c: c.isNotNull() & (c != ""))
    return F.transform(
        named, lambda c: F.struct(c.alias("cpt"), fee_of(c, fees).alias("allowed"))
    )


def price_lines(
    claims: DataFrame,
    fees: DataFrame,
    key: str = "claim_id",
    codes: str = "cpts",
    default: float = fv.FEE_DEFAULT,
) -> DataFrame:
    """Fee lookup against a schedule of any size: ``key, procedures``.

    Lines are exploded, joined on the code and regrouped by claim.  A code on a third
    of all lines is no hot spot: its schedule side is one row, which AQE replicates
    over the split line partitions.  The regrouped lists hold one claim's lines.
    """
    lines = claims.where(f"{key} is not null and {key} <> ''").select(
        key, F.posexplode(codes).alias("_pos", "cpt")
    ).where("cpt <> ''")
    one_each = fees.groupBy("cpt").agg(F.max("allowed").alias("allowed"))
    priced = lines.join(one_each, "cpt", "left").withColumn(
        "allowed", F.coalesce("allowed", F.lit(default)).cast(MONEY)
    )
    ordered = F.sort_array(F.collect_list(F.struct("_pos", "cpt", "allowed")))
    return priced.groupBy(key).agg(
        F.transform(ordered, lambda p: F.struct(p["cpt"].alias("cpt"), p["allowed"].alias("allowed")))
        .alias("procedures")
    )


def read_fee_schedule(spark: SparkSession, path: str) -> DataFrame:
    """``cpt, allowed`` from a JSON object of code to fee; names that start with ``_`` are comments."""
    text = spark.read.option("wholetext", True).text(path)
    fees = text.select(F.explode(F.from_json("value", "map<string,string>")).alias("cpt", "fee"))
    return fees.where("cpt NOT LIKE '\\_%'").select("cpt", F.col("fee").try_cast(MONEY).alias("allowed"))


def priced(claims: DataFrame, fees: dict[str, float] | DataFrame | None) -> DataFrame:
    """``claims`` with ``procedures``, from a constant schedule or one that is a table.

    A table may hold a DEFAULT row.  Rows are told apart by a number of their own, so claims that
    share an id, or have none, keep their own codes.
    """
    if not isinstance(fees, DataFrame):
        return claims.withColumn("procedures", price_codes(F.col("cpts"), fees))
    found = fees.where("cpt = 'DEFAULT'").agg(F.max("allowed")).first()[0]
    one_each = fees.groupBy(F.col("cpt").alias("_cpt")).agg(F.max("allowed").alias("_allowed"))
    rows = claims.withColumn("_row", F.monotonically_increasing_id())
    lines = rows.select("*", F.posexplode_outer(
        F.filter("cpts", lambda c: c.isNotNull() & (c != ""))).alias("_pos", "_cpt"))
    allowed = F.coalesce("_allowed", F.lit(fv.FEE_DEFAULT if found is None else found)).cast(MONEY)
    line = F.struct("_pos", F.col("_cpt").alias("cpt"), allowed.alias("allowed"))
    grouped = lines.join(one_each, "_cpt", "left").groupBy("_row").agg(
        F.first(F.struct(*claims.columns)).alias("_claim"),
        F.sort_array(F.collect_list(F.when(F.col("_cpt").isNotNull(), line))).alias("_lines"),
    )
    short = F.transform("_lines", lambda p: F.struct(p["cpt"].alias("cpt"), p["allowed"].alias("allowed")))
    return grouped.select("_claim.*", short.alias("procedures"))


def any_code_in(codes: Column, wanted: list[str]) -> Column:
    return F.coalesce(F.arrays_overlap(codes, F.array(*[F.lit(c) for c in wanted])), F.lit(False))


def cas_code(reason: Column) -> Column:
    """Adjustment code of a denial reason; a blank reason is a paid claim."""
    known = F.try_element_at(literal_map(fv.CAS_CODES), reason)
    return F.when(reason == "", fv.CAS_PAID).otherwise(F.coalesce(known, F.lit(fv.CAS_DEFAULT)))


def denial_reason(as_of: Column) -> Column:
    """First matching rule over a claim already joined with its eligibility."""
    cpts, billed = F.col("cpts"), F.col("billed_amount")
    needs_auth = any_code_in(cpts, fv.AUTH_REQUIRED_CPTS) | (billed > fv.AUTH_REQUIRED_ABOVE)
    no_auth = F.coalesce("prior_auth", F.lit("")) == ""
    return (
        F.when(~F.col("eligible"), F.col("eligibility_reason"))
        .when(F.datediff(as_of, F.col("dos")) > fv.TIMELY_FILING_DAYS, "timely_filing_exceeded")
        .when(any_code_in(cpts, fv.NON_COVERED_CPTS), "service_not_covered")
        .when(any_code_in(cpts, fv.EXPERIMENTAL_CPTS), "experimental_procedure")
        .when(needs_auth & no_auth, "prior_auth_required")
        .otherwise("")
    )


def allowed_total(procedures: Column) -> Column:
    return F.aggregate(
        procedures, F.lit(0).cast(MONEY), lambda a, p: (a + p["allowed"]).cast(MONEY)
    )


def decide(
    eligible_claims: DataFrame,
    as_of=None,
    fees: dict[str, float] | None = None,
    keep: list[str] | None = None,
) -> DataFrame:
    """The ten adjudication columns for claims that already carry their eligibility.

    Reads ``claim_id, member_id, dos, billed_amount, prior_auth, cpts, eligible,
    eligibility_reason``.
    """
    billed = F.col("billed_amount").try_cast(MONEY)
    paid = F.when(
        F.col("denial_reason") == "", F.least(allowed_total(F.col("procedures")), billed)
    ).otherwise(F.lit(0).cast(MONEY))
    return (
        priced(eligible_claims.withColumn("denial_reason", denial_reason(today(as_of))), fees)
        .withColumn("paid_amount", paid.cast(MONEY))
        .select(
            "claim_id",
            F.when(F.col("denial_reason") == "", "paid").otherwise("denied").alias("status"),
            "denial_reason",
            "paid_amount",
            billed.alias("billed_amount"),
            cas_code(F.col("denial_reason")).alias("cas_code"),
            (billed - F.col("paid_amount")).cast(MONEY).alias("cas_amount"),
            "member_id",
            F.date_format("dos", "yyyy-MM-dd").alias("date_of_service"),
            "procedures",
            *(keep or []),
        )
    )


def adjudicate(
    claims: DataFrame,
    enrollment: DataFrame,
    as_of=None,
    fees: dict[str, float] | None = None,
    keep: list[str] | None = None,
) -> DataFrame:
    """Adjudicate claims directly: ineligible members become denials too."""
    return decide(check_eligibility(claims, enrollment), as_of, fees, keep)


def remittance_record(adjudication: DataFrame) -> DataFrame:
    return adjudication.select(*REMITTANCE_KEYS)
