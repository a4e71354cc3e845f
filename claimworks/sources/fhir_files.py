"""FHIR claim files: a Bundle or a bare Claim per file, or one resource per line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Nested resources stay JSON text, in their own key order.
_SHELL = "resourceType string, entry array<struct<resource:string>>"


def resource_type(text: Column) -> Column:
    return F.get_json_object(text, "$.resourceType")


def unwrap(df: DataFrame, json: str = "value", require_claims: bool = False) -> DataFrame:
    """One row per Claim resource: the other columns plus ``claim_id, fhir_json``.

    A Bundle gives its Claim entries, a bare Claim itself, anything else nothing.
    With ``require_claims`` a document without any claim raises when it is read.
    """
    keep = [c for c in df.columns if c != json]
    shell = F.from_json(F.col(json), _SHELL)
    entries = F.filter(
        F.transform(F.coalesce(F.col("_shell.entry"), F.array()), lambda e: e["resource"]),
        lambda r: F.coalesce(resource_type(r) == "Claim", F.lit(False)),
    )
    claims = (
        F.when(F.col("_shell.resourceType") == "Bundle", entries)
        .when(F.col("_shell.resourceType") == "Claim", F.array(F.col(json)))
        .otherwise(F.array().cast("array<string>"))
    )
    if require_claims:
        claims = F.when(F.size(claims) > 0, claims).otherwise(
            F.raise_error(F.lit("no Claim resources found"))
        )
    return (
        df.withColumn("_shell", shell)
        .select(*keep, F.explode(claims).alias("fhir_json"))
        .select(*keep, F.get_json_object("fhir_json", "$.id").alias("claim_id"), "fhir_json")
    )


def read_fhir(
    spark: SparkSession, path: str | list[str], per_line: bool = False, require_claims: bool = True
) -> DataFrame:
    """Claims of FHIR files.  JSON documents do not split, so each file is one row and
    must fit a task; large exports should hold one resource per line (``per_line``)."""
    paths = [path] if isinstance(path, str) else path
    documents = spark.read.text(paths, wholetext=not per_line)
    if per_line:
        documents = documents.where(F.trim("value") != "")
    return unwrap(documents, require_claims=require_claims)
