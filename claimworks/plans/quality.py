"""Data-quality suites, model tests and the two singular tests."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimworks import fixed_values as fv

MART_TESTS = [
    # --- fixed values: tests per model: (model, column, kind, accepted values) ---
    ("silver_claims", "claim_id", "not_null", None),
    ("silver_claims", "claim_id", "unique", None),
    ("silver_claims", "denial_risk_score", "not_null", None),
    ("gold_remittance", "claim_id", "not_null", None),
    ("gold_remittance", "status", "accepted_values", ["paid", "denied"]),
    ("stg_claims", "claim_id", "not_null", None),
    ("stg_claims", "claim_id", "unique", None),
    ("stg_claims", "risk_tier", "accepted_values", ["HIGH", "MEDIUM", "LOW"]),
    ("stg_remittance", "claim_id", "not_null", None),
    ("stg_remittance", "claim_id", "unique", None),
    ("stg_providers", "provider_npi", "not_null", None),
    ("stg_providers", "provider_npi", "unique", None),
    ("int_claim_adjudication", "claim_id", "not_null", None),
    ("int_claim_adjudication", "claim_id", "unique", None),
    (
        "int_claim_adjudication", "adjudication_status", "accepted_values",
        ["paid", "denied", "pending"],
    ),
    ("claims_by_provider", "billing_npi", "not_null", None),
    ("claims_by_provider", "billing_npi", "unique", None),
    ("denial_rates", "claim_month", "not_null", None),
    ("revenue_summary", "claim_month", "not_null", None),
    ("revenue_summary", "claim_month", "unique", None),
    ("denial_explanations", "claim_id", "not_null", None),
    ("denial_explanations", "claim_id", "unique", None),
]


# --- expectations ------------------------------------------------------------------


SUITE_RESULT = (
    "suite string, position int, expectation string, column_name string, observed long, success boolean"
)


# Flags, quotes and back references give the ends of a pattern another meaning; these are left as they are.
_PLAIN_ENDS = re.compile(r"(?!.*(\\[QEk1-9]|\(\?[^:]))", re.DOTALL)


def searched(regex: str) -> str:
    """The regex without ``.*`` at its ends, which a search for it finds in the same texts.

    A search that fails tries every start; with ``.*`` in front each start reads the rest of the line
    again, so one text that does not match takes the square of its length.
    """
    if not _PLAIN_ENDS.match(regex):
        return regex
    found = re.sub(r"^(\.\*(?![?+*{]))+", "", regex)
    while found.endswith(".*"):
        before = found[:-2]
        if (len(before) - len(before.rstrip("\\"))) % 2 or before.count("[") > before.count("]"):
            break
        found = before
    return found


def _failing(spec: dict) -> Column:
    """Rows that break a row-level expectation; NULLs break only ``not_null``."""
    column = F.col(spec["column"])
    kind = spec["type"]
    if kind == "not_null":
        return column.isNull()
    if kind == "matches_regex":
        return ~column.rlike(searched(spec["regex"]))
    if kind == "between":
        return ~column.between(spec["min"], spec["max"])
    if kind == "in_set":
        return ~column.isin(spec["values"])
    if kind == "length_between":
        low = F.length(column) < spec["min"]
        return low | (F.length(column) > spec["max"]) if "max" in spec else low
    raise ValueError(f"unknown expectation: {kind}")


def run_suite(
    df: DataFrame, suite: list[dict], name: str, kinds: list[str] | None = None
) -> DataFrame:
    """One row per expectation: ``suite, position, expectation, column_name, observed,
    success``.

    Every data expectation is one column of a single aggregate, so the table is scanned
    once however long the suite is, and only counts are shuffled.  Schema expectations
    are settled from the schema alone; a suite of nothing else reads no data.  ``kinds``
    selects expectations before anything is planned.
    """
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    measures, results = [], []
    for i, spec in enumerate(suite):
        if kinds is not None and spec["type"] not in kinds:
            continue
        kind, column = spec["type"], spec.get("column")
        measure = f"_m{i}"
        if kind == "column_exists":
            observed, ok = F.lit(int(column in types)).cast("long"), F.lit(column in types)
        elif kind == "column_type":
            match = types.get(column) == spec["dtype"]
            observed, ok = F.lit(int(match)).cast("long"), F.lit(match)
        elif kind == "row_count_between":
            measures.append(F.count("*").alias(measure))
            observed = F.col(measure)
            ok = observed.between(spec["min"], spec["max"])
        else:
            measures.append(F.count_if(_failing(spec)).alias(measure))
            observed = F.col(measure)
            ok = observed == 0
        results.append(
            F.struct(
                F.lit(i).alias("position"),
                F.lit(kind).alias("expectation"),
                F.lit(column).cast("string").alias("column_name"),
                observed.alias("observed"),
                ok.alias("success"),
            )
        )
    if not results:
        empty = [F.lit(None).cast(t).alias(n) for n, t in (f.split() for f in SUITE_RESULT.split(", "))]
        return df.sparkSession.range(0).select(*empty)
    totals = df.agg(*measures) if measures else df.sparkSession.range(1)
    return totals.select(F.explode(F.array(*results)).alias("r")).select(
        F.lit(name).alias("suite"), "r.*"
    )


def run_checkpoint(
    bronze: DataFrame, silver: DataFrame, kinds: list[str] | None = None
) -> DataFrame:
    """Both suites; ``store_results`` appends the result to a table, a history of runs."""
    return run_suite(bronze, fv.BRONZE_SUITE, "bronze_claims_suite", kinds).unionByName(
        run_suite(silver, fv.SILVER_SUITE, "silver_claims_suite", kinds)
    )


def store_results(results: DataFrame, path: str) -> None:
    results.withColumn("run_ts", F.current_timestamp()).write.mode("append").parquet(path)


# --- model tests -------------------------------------------------------------------


def not_null_failures(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def unique_failures(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; counted per task before the shuffle."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("n_records"))
        .where("n_records > 1")
    )


def accepted_values_failures(df: DataFrame, column: str, values: list) -> DataFrame:
    return (
        df.where(~F.col(column).isin(values))
        .groupBy(F.col(column).alias("value_field"))
        .agg(F.count("*").alias("n_records"))
    )


def _by_value(df: DataFrame, unique: list[str], bad: dict[str, Column]) -> DataFrame:
    """Per grouping set and value: ``_set`` (place in ``unique``), ``_known`` (no null), ``_n`` rows, and ``bad``."""
    counts = [F.count("*").alias("_n"), *[c.alias(name) for name, c in bad.items()]]
    if len(unique) == 1:
        grouped = df.groupBy(unique[0]).agg(*counts).withColumn("_set", F.lit(0))
        return grouped.withColumn("_known", F.col(unique[0]).isNotNull())
    grouped = df.groupingSets([[F.col(c)] for c in unique], *unique).agg(
        F.grouping_id().alias("_id"), *counts
    )
    # The bit of a grouped column is 0, the first column has the highest.
    full = 2 ** len(unique) - 1
    place, known = F.lit(None).cast("int"), F.lit(None).cast("boolean")
    for i, column in enumerate(unique):
        mine = F.col("_id") == full - 2 ** (len(unique) - 1 - i)
        place = F.when(mine, i).otherwise(place)
        known = F.when(mine, F.col(column).isNotNull()).otherwise(known)
    return grouped.withColumns({"_set": place, "_known": known})


def run_model_tests(
    models: dict[str, DataFrame], tests=None, kinds: list[str] | None = None
) -> DataFrame:
    """One row per test: ``model, column_name, test, failures, passed``; ``kinds`` selects
    tests before anything is planned.

    A model is read once and shuffled once: its unique columns are grouping sets of one aggregate, in whose groups
    the null and accepted-value tests are counted as well. Values are counted per task before they move.
    """
    by_model: dict[str, list] = {}
    for model, column, kind, values in tests or MART_TESTS:
        if model in models and (kinds is None or kind in kinds):
            by_model.setdefault(model, []).append((column, kind, values))
    parts = []
    for model, wanted in by_model.items():
        unique = list(dict.fromkeys(c for c, kind, _ in wanted if kind == "unique"))
        bad = {
            f"_t{i}": F.count_if(
                F.col(column).isNull() if kind == "not_null" else ~F.col(column).isin(values)
            )
            for i, (column, kind, values) in enumerate(wanted) if kind != "unique"
        }
        groups = _by_value(models[model], unique, bad) if unique else models[model]
        failures = []
        for i, (column, kind, _) in enumerate(wanted):
            if kind == "unique":
                test = F.count_if((F.col("_set") == unique.index(column)) & F.col("_known") & (F.col("_n") > 1))
            elif unique:  # every set holds all rows; the first one is counted
                test = F.coalesce(F.sum(F.when(F.col("_set") == 0, F.col(f"_t{i}"))), F.lit(0))
            else:
                test = bad[f"_t{i}"]
            failures.append(test.alias(f"_t{i}"))
        rows = F.array(*[
            F.struct(
                F.lit(model).alias("model"), F.lit(column).alias("column_name"),
                F.lit(kind).alias("test"), F.col(f"_t{i}").alias("failures"),
            )
            for i, (column, kind, _) in enumerate(wanted)
        ])
        parts.append(groups.agg(*failures).select(F.explode(rows).alias("r")).select("r.*"))
    out = reduce(DataFrame.unionByName, parts)
    return out.withColumn("passed", F.col("failures") == 0)


# --- singular tests ----------------------------------------------------------------


def score_out_of_range(claims: DataFrame) -> DataFrame:
    score = F.col("denial_risk_score")
    return claims.where(score.isNotNull() & ((score < 0) | (score > 100))).select(
        "claim_id", "denial_risk_score"
    )


def orphan_remittance(remittance: DataFrame, claims: DataFrame) -> DataFrame:
    """Remittance rows without a claim."""
    return remittance.join(claims.select("claim_id"), "claim_id", "left_anti").select("claim_id")
