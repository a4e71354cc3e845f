"""Member eligibility: an equi-join on the member with a coverage-interval test."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimworks.functions.scalars import as_column


def member_of_reference(reference: Column) -> Column:
    """Last path part of a patient reference."""
    return F.element_at(F.split(F.coalesce(reference, F.lit("")), "/"), -1)


def service_date(text: Column, as_of: Column) -> Column:
    """ISO date of the first line; blank or unreadable text becomes ``as_of``."""
    return F.coalesce(F.try_to_date(text, "yyyy-MM-dd"), as_of)


def check_eligibility(
    claims: DataFrame,
    enrollment: DataFrame,
    member: str = "member_id",
    dos: str | Column = "dos",
) -> DataFrame:
    """Claims plus ``eligible, eligibility_reason, plan_type, payer_id, group_number``.

    ``enrollment`` has one row per member, so the join keeps the claim count.  No
    broadcast is forced: Spark broadcasts the members when their measured size allows,
    and otherwise sort-merges, where AQE splits the partition of a member that holds
    a large share of the claims (the other side has a single row for it).
    """
    dos = F.col(dos) if isinstance(dos, str) else dos
    members = enrollment.select(
        F.col("member_id").alias("_member"),
        F.col("coverage_start").alias("_start"),
        F.col("coverage_end").alias("_end"),
        F.coalesce("plan_type", F.lit("")).alias("_plan"),
        F.coalesce("payer_id", F.lit("")).alias("_payer"),
        F.coalesce("group_number", F.lit("")).alias("_group"),
    )
    found = F.col("_member").isNotNull()
    active = dos.between(F.col("_start"), F.col("_end"))
    reason = (
        F.when(~found, "member_not_found")
        .when(active, "active_coverage")
        .otherwise("coverage_not_active_on_dos")
    )
    return (
        claims.join(members, F.col(member) == F.col("_member"), "left")
        .withColumn("eligibility_reason", reason)
        .withColumn("eligible", F.col("eligibility_reason") == "active_coverage")
        .withColumn("plan_type", F.coalesce("_plan", F.lit("")))
        .withColumn("payer_id", F.coalesce("_payer", F.lit("")))
        .withColumn("group_number", F.coalesce("_group", F.lit("")))
        .drop("_member", "_start", "_end", "_plan", "_payer", "_group")
    )


def _segments(spans: DataFrame) -> DataFrame:
    """Disjoint segments of a member's time line, each decided by one span.

    A span decides from its start until the next one of the member starts. Of spans that start on one day the
    one that ends last counts, then the greater texts. The first segment also stands for the days before.
    """
    merged = (
        spans.where(F.col("member_id").isNotNull() & F.col("coverage_start").isNotNull())
        .groupBy(F.col("member_id").alias("_member"), F.col("coverage_start").alias("_start"))
        .agg(
            F.max(
                F.struct(
                    F.coalesce("coverage_end", F.lit("9999-12-31").cast("date")).alias("_end"),
                    *[
                        F.coalesce(c, F.lit("")).alias(f"_{c}")
                        for c in ("plan_type", "payer_id", "group_number")
                    ],
                )
            ).alias("_last")
        )
    )
    line = Window.partitionBy("_member").orderBy("_start")
    return merged.select(
        "_member", "_start", "_last.*",
        F.lead("_start").over(line).alias("_next"),
        F.lag("_start").over(line).isNull().alias("_first"),
    )


def check_spans(
    claims: DataFrame, spans: DataFrame, member: str = "member_id", dos: str = "dos"
) -> DataFrame:
    """``check_eligibility`` for members with any number of coverage spans: one row per claim stays.

    The span with the latest start not after the day decides, so of overlapping spans the later enrolment
    counts, also where it ends first. A day before the first span, in a gap, or unknown is not covered. Plan,
    payer and group are the deciding span's, blank where there is none; a span without an end is open.

    Segments are disjoint, so the join on the member with the day's range gives at most one match and its
    output never grows beyond the claims; AQE splits the partition of a member that many claims name.
    """
    segments = _segments(spans)
    day = F.coalesce(F.col(dos), F.lit("9999-12-31").cast("date"))
    matches = (
        (F.col(member) == F.col("_member"))
        & (F.col("_first") | (day >= F.col("_start")))
        & (F.col("_next").isNull() | (day < F.col("_next")))
    )
    decided = F.col(dos) >= F.col("_start")
    active = F.col(dos).between(F.col("_start"), F.col("_end"))
    reason = (
        F.when(F.col("_member").isNull(), "member_not_found")
        .when(active, "active_coverage")
        .otherwise("coverage_not_active_on_dos")
    )
    return (
        claims.join(segments, matches, "left")
        .withColumn("eligibility_reason", reason)
        .withColumn("eligible", F.col("eligibility_reason") == "active_coverage")
        .withColumns(
            {
                c: F.when(decided, F.col(f"_{c}")).otherwise("")
                for c in ("plan_type", "payer_id", "group_number")
            }
        )
        .drop(*segments.columns)
    )


def today(as_of) -> Column:
    return F.current_date() if as_of is None else as_column(as_of)
