"""Reading tables, scratch tables in the shared folder, and connected components."""

from __future__ import annotations

import ctypes
import gc

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimworks.session import scratch_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """The frame written to the shared folder and read again: lineage ends there."""
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.mode("overwrite").parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.scratch_path = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete stored tables that nothing will read again."""
    for frame in tables:
        spark, path = frame.sparkSession, frame.sparkSession._jvm.org.apache.hadoop.fs.Path(frame.scratch_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release() -> None:
    """Give memory that is no longer used back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library; its freed memory stays with the worker


def tidy(task):
    """The same task for mapInArrow, ending with ``release``: Python workers live on between tasks."""
    def run(batches):
        try:
            yield from task(batches)
        finally:
            release()

    return run


def bounded_batches(spark: SparkSession, size: str = "8m") -> None:
    """Arrow batches of this session end at ``size`` bytes as well as at a count of rows.

    Rows differ in length by orders of magnitude, so a count alone does not bound what the JVM and its Python
    worker hold.  A longer row is a batch of its own.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def width(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def components(edges: DataFrame, max_rounds: int = 40) -> DataFrame:
    """Connected components of an undirected edge list (``a``, ``b`` longs): ``node``, ``component``.

    ``component`` is the smallest node reachable.  Alternating large-star and small-star rounds
    (Kiryas et al.'s star contraction) until the edge list stops changing; every round is written to
    the shared folder, nothing but one count reaches the driver.  Rows with a null end are ignored and
    repeated edges count once.  An empty edge list gives an empty frame.
    """
    links = stored(
        edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"))
        .where("a is not null and b is not null and a <> b")
        .distinct(),
        "edges",
    )
    if links.isEmpty():
        return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    last = None
    for _ in range(max_rounds):
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        # large star: every larger neighbour points to the smallest neighbour
        large = (
            both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .where("a <> b").distinct()
        )
        # small star: every smaller neighbour, and the node itself, point to the smallest one
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        small_least = down.groupBy("a").agg(F.min("b").alias("m"))
        links = stored(
            down.join(small_least, "a").select(F.col("b").alias("x"), "m")
            .where("x <> m")
            .union(small_least.select(F.col("a").alias("x"), "m"))
            .distinct()
            .select(F.col("x").alias("a"), F.col("m").alias("b")),
            "components",
        )
        state = links.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.countDistinct("a")
        ).first()
        if last is not None and state[:2] == last and state[0] == state[2]:
            break
        last = state[:2]
    else:
        raise RuntimeError("component search did not settle")
    roots = links.select(F.col("b").alias("node")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        roots.select("node", F.col("node").alias("component"))
    )
