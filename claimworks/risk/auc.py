"""Exact area under the ROC curve as a rank sum, without ranking rows in one place."""

from __future__ import annotations

from math import inf

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimworks.session import scratch_dir

PARTS = 256
WIDE = "decimal(38,0)"


def rank_sum_auc(
    scored: DataFrame, score: str = "probability", label: str = "label", parts: int = PARTS
) -> DataFrame:
    """One row ``positives, negatives, auc``.

    Rows are first counted per score, so equal scores, however many, are one row. Scores are then cut
    into at most ``parts`` ranges by their quantiles: a window adds up the negatives below each score
    inside a range, and a window over the ranges' totals (``parts`` rows) gives what lies below the range.
    Where the quantiles fall does not change the result. Ties count one half. Products are exact.

    Rows without a score, with a score that is no number, or with a label other than 0 and 1 take no part;
    ``auc`` is null when a class is empty.
    """
    spark = scored.sparkSession
    value = F.col(score).cast("double")
    counted = (
        scored.where(value.isNotNull() & ~F.isnan(value) & F.col(label).isin(0, 1))
        # -0.0 and 0.0 are one score
        .groupBy((value + F.lit(0.0)).alias("score"))
        .agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg"))
    )
    path = scratch_dir(spark, "scores")
    counted.write.mode("overwrite").parquet(path)
    counts = spark.read.parquet(path)

    steps = [i / parts for i in range(1, parts)]
    bounds = sorted({b for b in counts.approxQuantile("score", steps, 0.25 / parts) if abs(b) < inf})
    ranges = Bucketizer(splits=[-inf, *(bounds or [0.0]), inf], inputCol="score", outputCol="part")
    ranged = ranges.transform(counts)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy("part").agg(F.sum("neg").alias("_n")).select(
        "part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_lower")
    )
    inside = Window.partitionBy("part").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    placed = ranged.withColumn("_inside", F.coalesce(F.sum("neg").over(inside), F.lit(0))).join(
        F.broadcast(totals), "part"
    )
    below = (F.col("_lower") + F.col("_inside")) * 2 + F.col("neg")
    return placed.agg(
        F.coalesce(F.sum("pos"), F.lit(0)).alias("positives"),
        F.coalesce(F.sum("neg"), F.lit(0)).alias("negatives"),
        F.sum(_wide("pos") * below.cast("decimal(19,0)")).alias("_twice"),
    ).select(
        "positives", "negatives",
        F.when(
            (F.col("positives") > 0) & (F.col("negatives") > 0),
            F.col("_twice").cast(WIDE).cast("double")
            / (F.col("positives").cast("double") * F.col("negatives").cast("double") * 2),
        ).alias("auc"),
    )


def _wide(name: str) -> Column:
    return F.col(name).cast("decimal(19,0)")
