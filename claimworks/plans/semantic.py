"""Metric layer: named dimensions and measures compiled to a select."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class MetricTable:
    """Public name to physical column, by role."""

    dimensions: dict[str, str] = field(default_factory=dict)
    time_dimensions: dict[str, str] = field(default_factory=dict)
    measures: dict[str, str] = field(default_factory=dict)

    def column(self, name: str) -> str:
        for group in (self.dimensions, self.time_dimensions, self.measures):
            if name in group:
                return group[name]
        raise KeyError(f"unknown dimension or measure: {name}")


# --- fixed values: the published metric tables ---
METRICS = {
    "CLAIMS_BY_PROVIDER": MetricTable(
        dimensions={"provider_npi": "billing_npi"},
        measures={
            "claim_count": "claim_count",
            "denial_rate": "denial_rate",
            "total_billed": "total_billed",
            "total_paid": "total_paid",
            "avg_denial_risk": "avg_denial_risk",
        },
    ),
    "DENIAL_RATES": MetricTable(
        dimensions={"provider_npi": "billing_npi"},
        time_dimensions={"claim_month": "claim_month"},
        measures={"high_risk_claims": "high_risk_claims", "avg_risk_score": "avg_risk_score"},
    ),
    "DENIAL_EXPLANATIONS": MetricTable(
        dimensions={
            "claim_id": "claim_id",
            "cortex_explanation": "cortex_provider_explanation",
            "recommended_action": "recommended_action",
        },
        measures={"denial_risk_score": "denial_risk_score"},
    ),
    "REVENUE_SUMMARY": MetricTable(
        time_dimensions={"claim_month": "claim_month"},
        measures={
            "total_billed": "total_billed",
            "total_paid": "total_paid",
            "collection_rate_pct": "collection_rate_pct",
            "claim_count": "claim_count",
        },
    ),
}


def _order(spec: str) -> Column:
    name, _, direction = spec.partition(" ")
    return F.col(name).desc() if direction.strip().lower() == "desc" else F.col(name).asc()


def metric_select(
    tables: dict[str, DataFrame],
    table: str,
    dimensions: list[str] | None = None,
    measures: list[str] | None = None,
    where: str | None = None,
    order: list[str] | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Select by public names.  ``where`` and ``order`` may use any name of the table,
    selected or not; unknown names raise before anything runs."""
    spec = METRICS[table]
    names = [*(dimensions or []), *(measures or [])]
    if not names:
        raise ValueError("select at least one dimension or measure")
    for name in names:
        spec.column(name)
    public = {**spec.dimensions, **spec.time_dimensions, **spec.measures}
    out = tables[table].select(*[F.col(c).alias(n) for n, c in public.items()])
    if where:
        out = out.where(where)
    if order:
        out = out.orderBy(*[_order(o) for o in order])
    if limit is not None:
        out = out.limit(limit)
    return out.select(*names)


# --- re-aggregation -----------------------------------------------------------------

# What is kept per group: sums and counts, which add up to the same of any coarser group.
STATES = {
    "n": "count(*)",
    "claims": "count(claim_id)",
    "denied": "sum(is_denied)",
    "billed": "sum(billed_amount)",
    "paid": "sum(paid_amount)",
    "scored": "count(denial_risk_score)",
    "risk": "sum(denial_risk_score)",
}
# A measure is an expression over states, taken after they are added up.
MEASURES = {
    "claim_count": "claims",
    "denied_claims": "denied",
    "total_billed": "billed",
    "total_paid": "paid",
    "denial_rate": "round(cast(denied as double) * 100 / nullif(cast(n as double), 0), 2)",
    "collection_rate_pct": "round(cast(paid as double) * 100 / nullif(cast(billed as double), 0), 2)",
    "avg_denial_risk": "round(cast(risk as double) / nullif(scored, 0), 2)",
}
GRAINS = ("month", "quarter", "year")


def measure_states(claims: DataFrame, by: list[str]) -> DataFrame:
    """``by`` and the states of its groups, from one row per adjudicated claim."""
    return claims.groupBy(*by).agg(*[F.expr(e).alias(name) for name, e in STATES.items()])


def regroup(
    states: DataFrame, measures: list[str], by: list[str] | None = None, grain: str | None = None,
    month: str = "claim_month",
) -> DataFrame:
    """Measures at any grain coarser than the states'; claims are not read again.

    ``grain`` adds ``period``, the first day of the month, quarter or year of ``month``. A ratio is that of the sums, not
    a mean of ratios; it is null over nothing. Counts of distinct values do not add up and are no measures here.
    """
    unknown = [m for m in measures if m not in MEASURES]
    if unknown or grain not in (None, *GRAINS):
        raise KeyError(f"unknown measure or grain: {unknown or grain}")
    keys = [F.col(c) for c in by or []]
    if grain:
        keys.append(F.trunc(month, grain).alias("period"))
    added = states.groupBy(*keys).agg(*[F.sum(name).alias(name) for name in STATES])
    names = [*(by or []), *(["period"] if grain else [])]
    return added.select(*names, *[F.expr(MEASURES[m]).alias(m) for m in measures])
