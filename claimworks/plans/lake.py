"""Bronze rows to Silver rows, with quarantine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from claimworks import fixed_values as fv
from claimworks import schemas
from claimworks.operators import fhir, validate
from claimworks.operators.dedup import latest_per_key
from claimworks.plans import gold
from claimworks.risk import explain, features
from claimworks.risk.score import AdditiveScorer
from claimworks.session import remove_dir, scratch_dir
from claimworks.sources.tables import KeyedTable

CLUSTER_BY = ["claim_id", "service_date"]


def parse_bronze(bronze: DataFrame) -> DataFrame:
    return fhir.with_variant(bronze).withColumn("drop_reason", fhir.drop_reason())


def quarantine(bronze: DataFrame) -> DataFrame:
    """Bronze rows Silver drops, and why."""
    return parse_bronze(bronze).where(F.col("drop_reason").isNotNull()).select(
        *bronze.columns, "drop_reason"
    )


def _read_columns() -> list[Column]:
    """What Silver reads of a claim, with ``can_validate`` beside it."""
    typed = fhir.extract_columns()
    inputs = {f"_{n}": c for n, c in features.batch_features().items()}
    return [
        *[c.alias(n) for n, c in typed.items()],
        *[c.alias(n) for n, c in inputs.items()],
        F.col("can_validate"),
        F.when(F.col("can_validate"), validate.first_error()).alias("_error"),
        F.col("ingest_ts"),
        F.col("received_ts"),
        F.xxhash64("fhir_json").alias("_text_hash"),
    ]


def _with_errors(rows: DataFrame) -> DataFrame:
    found = F.when(F.col("_error").isNotNull(), F.array("_error"))
    return rows.withColumn("errors", found.otherwise(F.array().cast("array<string>"))).drop("_error")


def silver_candidates(bronze: DataFrame) -> DataFrame:
    """Typed columns, model inputs and validation errors of the readable rows.

    Everything later steps need is read from the JSON here, so the exchange below moves
    short typed rows and not claim documents.
    """
    rows = parse_bronze(bronze).where(F.col("drop_reason").isNull())
    return _with_errors(rows.withColumn("can_validate", validate.can_validate()).select(*_read_columns()))


def sorted_out(bronze: DataFrame) -> DataFrame:
    """``silver_candidates`` and ``quarantine`` from one parse: per row either ``kept`` or ``dropped`` is NULL."""
    reason = F.col("drop_reason")
    rows = parse_bronze(bronze).withColumn("can_validate", validate.can_validate())
    return rows.select(
        F.when(reason.isNull(), F.struct(*_read_columns())).alias("kept"),
        F.when(reason.isNotNull(), F.struct(*bronze.columns, "drop_reason")).alias("dropped"),
    )


def kept_and_dropped(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The two sides of ``sorted_out``."""
    kept = rows.where("kept IS NOT NULL").select("kept.*")
    return _with_errors(kept), rows.where("dropped IS NOT NULL").select("dropped.*")


def to_silver(bronze: DataFrame, scorer=None, processed_ts=None) -> DataFrame:
    """Latest readable row per claim, scored and explained, in the Silver schema."""
    return silver_of(silver_candidates(bronze), scorer, processed_ts)


def silver_of(candidates: DataFrame, scorer=None, processed_ts=None) -> DataFrame:
    """``to_silver`` of rows that are read already."""
    scorer = scorer or AdditiveScorer()
    latest = latest_per_key(
        candidates,
        "claim_id",
        [F.col("received_ts"), F.col("ingest_ts"), F.col("_text_hash")],
        drop=["received_ts", "_text_hash"],
    )
    inputs = latest.withColumnsRenamed({"billed_amount": "_silver_billed"}).withColumnsRenamed(
        {f"_{f}": f for f in fv.FEATURES}
    )
    scored = explain.explain(scorer.attribute(inputs), scorer.version)
    stamp = F.current_timestamp() if processed_ts is None else processed_ts
    return (
        scored.withColumn("billed_amount", F.col("_silver_billed"))
        .withColumn("processed_ts", stamp)
        .select(*schemas.columns(schemas.SILVER))
    )


def silver_table(spark: SparkSession, root: str) -> KeyedTable:
    return KeyedTable(spark, root, "claim_id", schemas.SILVER, CLUSTER_BY)


def bronze_to_silver(spark: SparkSession, bronze: DataFrame, root: str, scorer=None) -> int:
    """Upsert the Silver table; returns its row count.  Files are sorted by claim and
    service date, so row-group statistics prune on both."""
    table = silver_table(spark, root)
    table.upsert(to_silver(bronze, scorer))
    return table.read().count()


def silver_to_gold(spark: SparkSession, silver: DataFrame, root: str) -> dict[str, int]:
    """Rebuild the Gold tables; returns their row counts, observed while writing.

    What they read of Silver is stored once: each of them would look for the latest rows anew.
    """
    seen, stage = {name: Observation(name) for name in gold.BUILDERS}, scratch_dir(spark, "gold-input")
    rows = silver.select(*gold.READ)
    rows.write.mode("overwrite").parquet(stage)
    stored = spark.read.schema(rows.schema).parquet(stage)
    for name, build in gold.BUILDERS.items():
        counted = build(stored).observe(seen[name], F.count(F.lit(1)).alias("rows"))
        counted.write.mode("overwrite").parquet(f"{root}/{name}")
    remove_dir(spark, stage)
    return {name: observation.get["rows"] for name, observation in seen.items()}
