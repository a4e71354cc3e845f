"""Headline queries on local cores: prints one JSON line with seconds per query."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from claimworks import registry, session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
HEADLINE = [
    "A1_provider_summary", "A2_denial_summary", "A3_claims_by_provider", "A4_denial_rates",
    "A5_revenue_summary", "A6_line_rollup", "J1_claim_adjudication_join", "J3_eligibility",
    "J4_fee_lookup", "B1_adjudicate", "B4_process_claims", "V2_claim_validation",
    "W1_latest_per_key", "F1_fhir_claim", "F3_bronze_to_silver", "P4_claim_loops",
    "P10_enrollment_834", "S15_remittance_835", "M12_attribution", "S8_keyed_upsert",
    "T1_score_and_route", "V14_not_null_unique",
]


def run(query, spark) -> float:
    """Seconds for the whole query, all result columns computed and none collected."""
    start = time.perf_counter()
    query(spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = session.build(
        "bench",
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry.queries()
    seconds = {}
    for name in HEADLINE:
        run(queries[name], spark)  # warm-up: class loading, code generation, model fit
        times = [run(queries[name], spark)]
        # Median of three; a query that takes long is steady enough to run once.
        while len(times) < RUNS and sum(times) < 6:
            times.append(run(queries[name], spark))
        times.sort()
        seconds[name] = round(times[len(times) // 2], 3)
    print(
        json.dumps(
            {
                "metric": "headline_total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")),
                "runs_at_most": RUNS,
                "cpus": int(CPUS),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
