"""Scalar expressions: safe arithmetic, tiers, dates, NPI check digit, plan type."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from claimworks import fixed_values as fv

WHITESPACE = " \t\n\r\x0b\x0c"


def as_column(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """NULL where the denominator is 0 or NULL."""
    return F.try_divide(numerator, denominator)


def percent(numerator: Column, denominator: Column, digits: int = 2) -> Column:
    return F.round(
        safe_divide(numerator.cast("double") * 100, denominator.cast("double")), digits
    )


def strip(value: Column) -> Column:
    return F.btrim(value, F.lit(WHITESPACE))


def element(parts: Column, index: int) -> Column:
    """Element of a split segment, stripped; blank when the segment is too short."""
    return F.coalesce(strip(F.get(parts, F.lit(index))), F.lit(""))


def billed_tier(
    billed: Column, high: float = fv.TIER_HIGH_USD, medium: float = fv.TIER_MEDIUM_USD
) -> Column:
    """Tier by billed USD; a NULL amount is LOW."""
    return F.when(billed >= high, "HIGH").when(billed >= medium, "MEDIUM").otherwise("LOW")


def score_tier(score: Column) -> Column:
    """Tier by denial-risk score."""
    return (
        F.when(score >= fv.REVIEW_SCORE, "HIGH")
        .when(score >= fv.MEDIUM_SCORE, "MEDIUM")
        .otherwise("LOW")
    )


def route_topic(
    probability: Column, high: int = fv.REVIEW_SCORE, medium: int = fv.MEDIUM_SCORE
) -> Column:
    """Output topic of a scored claim; the score is the truncated percentage."""
    score = (probability * 100).cast("int")
    return (
        F.when(score >= high, fv.TOPIC_REJECTED)
        .when(score >= medium, fv.TOPIC_REVIEW)
        .otherwise(fv.TOPIC_VALIDATED)
    )


def plan_type(code: Column) -> Column:
    """First known plan word contained in the code, else the code, else UNKNOWN."""
    upper = F.upper(code)
    found = None
    for word in fv.PLAN_TYPES:
        found = (F if found is None else found).when(upper.contains(word), word)
    return found.otherwise(F.coalesce(F.nullif(code, F.lit("")), F.lit("UNKNOWN")))


def edi_date(text: Column, as_of: Column) -> Column:
    """CCYYMMDD to date; anything unreadable becomes ``as_of``."""
    return F.coalesce(F.try_to_date(F.substring(text, 1, 8), "yyyyMMdd"), as_of)


def iso_date_text(text: Column) -> Column:
    """CCYYMMDD to yyyy-MM-dd; other lengths pass unchanged."""
    dashed = F.concat_ws(
        "-", F.substring(text, 1, 4), F.substring(text, 5, 2), F.substring(text, 7, 2)
    )
    return F.when(F.length(text) == 8, dashed).otherwise(text)


def npi_is_valid(npi: Column) -> Column:
    """Ten digits whose Luhn sum, with the card-issuer prefix, is a multiple of ten."""
    # Fifteen digits in all, so the doubled ones are those at odd places from the left.  One term per
    # digit is compiled; functions over an array of digits are interpreted for every claim.
    total = F.lit(0)
    for place in range(len(fv.NPI_PREFIX) + 10):
        own = place - len(fv.NPI_PREFIX)
        digit = F.lit(int(fv.NPI_PREFIX[place])) if own < 0 else F.ascii(F.substring(npi, own + 1, 1)) - 48
        doubled = digit * 2 - F.when(digit > 4, 9).otherwise(0)
        total = total + (digit if place % 2 == 0 else doubled)
    ten_digits = F.coalesce(npi, F.lit("")).rlike(r"^[0-9]{10}\z")
    return F.when(ten_digits, total % 10 == 0).otherwise(False)
