"""Gap-free numbers along an order, without bringing the rows to one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimworks.session import scratch_dir

_IN_PART = (1 << 33) - 1


def numbered(ordered: DataFrame, name: str = "position", start: int = 1) -> DataFrame:
    """Adds ``name``: ``start`` for the first row of a frame sorted with ``orderBy``, then one more per row.

    Rows are written once with their part and their place in it, so a task that runs again cannot deal them
    otherwise. Counts per part (one row per task) become offsets. The row order of the result is not the
    order of the numbers. An empty frame stays empty.
    """
    spark, own = ordered.sparkSession, ordered.columns
    path = scratch_dir(spark, "numbered")
    ordered.withColumn("__place", F.monotonically_increasing_id()).write.mode("overwrite").parquet(path)
    kept = spark.read.parquet(path).withColumn("__part", F.shiftright("__place", 33))
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = kept.groupBy("__part").agg(F.count("*").alias("__n")).select(
        "__part", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before")
    )
    place = F.col("__place").bitwiseAND(F.lit(_IN_PART))
    return kept.join(F.broadcast(offsets), "__part").select(
        *own, (F.col("__before") + place + start).alias(name)
    )
