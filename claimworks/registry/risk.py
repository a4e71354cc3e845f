"""Features, training, scoring, attribution, explanation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimworks import fixed_values as fv
from claimworks.fixtures import star
from claimworks.operators import fhir
from claimworks.plans import lake
from claimworks.registry.lake import _SILVER_SQL
from claimworks.registry import records  # noqa: F401  (registers the fhir expression)
from claimworks.registry import streams
from claimworks.registry.sql_base import cte, with_ctes
from claimworks.risk import explain, features, score, train, versions
from claimworks.risk.auc import rank_sum_auc
from claimworks.functions.scalars import route_topic
from claimworks.session import scratch_dir
from claimworks.sources import topics
from claimworks.streaming import jobs

AS_OF = "2000-06-30"
AUC_BAND = 0.78  # what both models must exceed on held-out claims


def training(spark, sf):
    """Every claim's features with the outcome of its adjudication."""
    claims = star.fhir_claims(star.claims(spark, sf)).withColumnRenamed("order_key", "id")
    return train.claims_table(claims, star.enrollment(spark, sf), F.col("filed_date"), "id")


def _stored_claims(spark, sf):
    """Every claim's batch inputs and training row, made once: models learn from them and score them."""
    claims = star.fhir_claims(star.claims(spark, sf)).withColumnRenamed("order_key", "id")
    rows = train.claims_and_inputs(claims, star.enrollment(spark, sf), F.col("filed_date"), "id")
    path = scratch_dir(spark, "claims")
    rows.write.mode("overwrite").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def _weighted(spark, sf, rows=None):
    """The training rows with their folds, made once: fit, class counts and evaluation read the same table."""
    path = scratch_dir(spark, "training")
    train.with_fold(training(spark, sf) if rows is None else rows).write.mode("overwrite").parquet(path)
    return train.with_class_weight(spark.read.parquet(path))


def _split(spark, sf, rows=None):
    """(train, test) of the stored rows, by their folds."""
    dealt = _weighted(spark, sf, rows)
    return dealt.where("fold <> 0").drop("fold"), dealt.where("fold = 0").drop("fold")


def _fit(fit_on, name: str):
    """The forest (v1) or the boosted trees (v2)."""
    return train.fit_boosted(fit_on) if name == "v2" else train.fit_forest(fit_on)


def _fitted(spark, sf, name: str):
    return _fit(_split(spark, sf)[0], name)


def claim_inputs(spark, sf):
    """Batch features of every claim, as plain columns."""
    parsed = fhir.with_variant(star.fhir_claims(star.claims(spark, sf)))
    return parsed.select("claim_id", *[c.alias(n) for n, c in features.batch_features().items()])


def m1(spark, sf):
    return claim_inputs(spark, sf)


def m2(spark, sf):
    damaged = star.spoiled(star.claims(spark, sf))
    return features.stream_features(
        damaged, star.enrollment(spark, sf), F.lit(AS_OF).cast("date"), json="fhir_json"
    ).select("order_key", *fv.FEATURES)


def m3(spark, sf):
    return training(spark, sf)


def _held_out_scores(spark, sf, name: str):
    fit_on, held_out = _split(spark, sf)
    return score.probability_of(_fit(fit_on, name), held_out).select("id", "label", "probability")


def m4(spark, sf):
    return _held_out_scores(spark, sf, "v1")


def m5(spark, sf):
    return _held_out_scores(spark, sf, "v2")


def m6(spark, sf):
    """Rows and positives per fold."""
    dealt = train.with_fold(training(spark, sf))
    return dealt.groupBy("fold").agg(
        F.count("*").alias("claims"), F.sum("label").cast("long").alias("positives")
    )


def m6_cv(spark, sf):
    """Mean AUC of the forest over the folds, each model trained on the other four."""
    fitted = train.cross_validate(_weighted(spark, sf), train.AddedUp())
    return spark.createDataFrame([(float(fitted.avgMetrics[0]),)], "mean_auc double")


def m7(spark, sf):
    fit_on, held_out = train.stratified_split(training(spark, sf))
    return (
        fit_on.withColumn("part", F.lit("train"))
        .unionByName(held_out.withColumn("part", F.lit("test")))
        .groupBy("part", "label")
        .agg(F.count("*").alias("claims"))
    )


def m8(spark, sf):
    fit_on, held_out = _split(spark, sf)
    first, second = (train.auc(_fit(fit_on, name), held_out) for name in versions.KNOWN)
    return train.compare_models(spark, first, second)


def m8_check(spark, sf):
    """Both versions on the held-out claims: rows and positives, whether the stored model behind the pointer
    answers as the fitted one, whether the rank sum is the evaluator's area, and whether it reaches the band."""
    fit_on, held_out = _split(spark, sf)
    store = versions.ModelStore(spark, scratch_dir(spark, "models"))
    parts = []
    for version in versions.KNOWN:
        model = _fit(fit_on, version)
        store.save(version, model)
        store.activate(version)
        direct = score.probability_of(model, held_out).withColumnRenamed("probability", "direct")
        both = store.scorer().score(direct).select("label", "direct", "probability")
        exact = train.evaluator().setRawPredictionCol("direct").setNumBins(0).evaluate(both)
        same = both.where(~F.col("direct").eqNullSafe(F.col("probability"))).isEmpty()
        parts.append(
            rank_sum_auc(both).select(
                F.lit(version).alias("model_version"),
                (F.col("positives") + F.col("negatives")).alias("held_out"), "positives",
                F.lit(same).alias("same_scores"),
                (F.abs(F.col("auc") - exact) < 1e-9).alias("rank_sum_is_area"),
                (F.col("auc") > AUC_BAND).alias("in_band"),
            )
        )
    return parts[0].unionByName(parts[1])


def m9(spark, sf):
    return _weighted(spark, sf).groupBy("label").agg(
        F.count("*").alias("claims"), F.round(F.max("weight"), 9).alias("weight"),
    )


def m10(spark, sf):
    """Truncated scores of all claims under the additive formula."""
    scored = score.AdditiveScorer().score(claim_inputs(spark, sf))
    return scored.select(
        "claim_id", explain.truncated_score(F.col("probability")).alias("denial_risk_score")
    )


def m10_forest(spark, sf):
    scored = score.probability_of(_fitted(spark, sf, "v1"), claim_inputs(spark, sf))
    return scored.select(
        "claim_id", explain.truncated_score(F.col("probability")).alias("denial_risk_score")
    )


def m11(spark, sf):
    """The same claims under both versions, switched by the pointer."""
    store = versions.ModelStore(spark, scratch_dir(spark, "models"))
    claims = _stored_claims(spark, sf)
    fit_on = _split(spark, sf, train.learnable(claims, "id"))[0]
    inputs = claims.select("claim_id", "batch.*")
    parts = []
    for version in versions.KNOWN:
        store.save(version, _fit(fit_on, version))
        store.activate(version)
        scored = store.scorer().score(inputs)
        parts.append(
            scored.select(
                "claim_id", F.lit(version).alias("model_version"),
                explain.truncated_score(F.col("probability")).alias("denial_risk_score"),
            )
        )
    return parts[0].unionByName(parts[1])


def m12(spark, sf):
    """Path-dependent values of the forest for every claim."""
    scorer = score.ModelScorer(_fitted(spark, sf, "v1"))
    out = scorer.attribute(claim_inputs(spark, sf))
    total = F.aggregate("contributions", F.lit(0.0), lambda a, x: a + x)
    return out.select(
        "claim_id", "probability", total.alias("explained"),
        *[F.get("contributions", F.lit(i)).alias(f) for i, f in enumerate(fv.FEATURES)],
    )


def m12_additivity(spark, sf):
    """Per claim whether its six contributions and the forest's mean add up to its probability."""
    scorer = score.ModelScorer(_fitted(spark, sf, "v1"))
    out = scorer.attribute(claim_inputs(spark, sf))
    total = F.aggregate("contributions", F.lit(0.0), lambda a, x: a + x) + F.lit(scorer.explainer(spark).mean)
    return out.select(
        "claim_id", F.size("contributions").alias("features"),
        (F.abs(total - F.col("probability")) < 1e-9).alias("adds_up"),
        F.col("probability").between(0, 1).alias("is_probability"),
    )


def _explained(spark, sf):
    inputs = (
        claim_inputs(spark, sf)
        .withColumn("can_validate", F.lit(True))
        .withColumn("errors", F.array().cast("array<string>"))
    )
    scorer = score.AdditiveScorer()
    return scorer.attribute(inputs)


def m13(spark, sf):
    out = explain.percentages(_explained(spark, sf))
    return out.select(
        "claim_id", *[F.get("percent", F.lit(i)).alias(f) for i, f in enumerate(fv.FEATURES)]
    )


def a9(spark, sf):
    """Array totals of the rounded shares: 100 for every claim."""
    out = explain.percentages(_explained(spark, sf))
    total = F.aggregate("percent", F.lit(0.0), lambda a, x: a + x)
    return out.groupBy(F.round(total, 6).alias("total")).agg(F.count("*").alias("claims"))


def m14(spark, sf):
    out = explain.percentages(_explained(spark, sf))
    label, weight = explain.driver(F.col("percent"))
    return out.select("claim_id", label.alias("primary_driver"), weight.alias("weight"))


def _silver(spark, sf):
    return lake.to_silver(star.bronze(spark, sf))


def m15(spark, sf):
    return _silver(spark, sf).select("claim_id", "provider_explanation")


def m16(spark, sf):
    return _silver(spark, sf).select(
        "claim_id", "human_review_required", "ai_decision_only", "reconsideration_right"
    )


def m17(spark, sf):
    """What a Silver run gives when no model can be loaded."""
    store = versions.ModelStore(spark, scratch_dir(spark, "no-models"))
    out = lake.to_silver(star.bronze(spark, sf), store.scorer_or_fallback())
    return out.select(
        "claim_id", "denial_risk_score", "human_review_required", "provider_explanation",
        "primary_driver", "decision_basis",
    )


def _stored_forest(spark, sf):
    """A model store whose active version is the forest trained on the claims."""
    store = versions.ModelStore(spark, scratch_dir(spark, "models"))
    store.save("v1", _fitted(spark, sf, "v1"))
    store.activate("v1")
    return store


def f3_trained(spark, sf):
    """Silver rows under the stored forest: what each score, review flag and basis has to satisfy."""
    out = lake.to_silver(star.bronze(spark, sf), _stored_forest(spark, sf).scorer_or_fallback())
    shares = F.map_values(F.from_json("decision_basis", "map<string,double>"))
    total = F.aggregate(shares, F.lit(0.0), lambda a, x: a + x)
    return out.select(
        "claim_id",
        (F.col("primary_driver") == "failed FHIR validation").alias("failed"),
        (F.col("primary_driver") != "model scoring error").alias("model_answered"),
        F.col("denial_risk_score").between(0, 100).alias("in_range"),
        (F.col("human_review_required") == (F.col("denial_risk_score") >= fv.REVIEW_SCORE)).alias("review_follows"),
        (F.round(total, 6) == 100).alias("basis_adds_up"),
    )


def t1_trained(spark, sf):
    """Every raw message routed once by the stream, to the topic of the stored forest's batch score."""
    store, root = _stored_forest(spark, sf), streams.claim_topic(spark, sf)
    members, day = star.enrollment(spark, sf), F.lit(AS_OF).cast("date")
    jobs.score_and_route(spark, root, members, store, scratch_dir(spark, "checkpoint"), as_of=day)
    raw = topics.read_topic(spark, root, fv.TOPIC_RAW)
    scored = store.scorer().score(features.stream_features(raw, members, day))
    expected = scored.select("key", route_topic(F.col("probability")).alias("expected"))
    routed = reduce(DataFrame.unionByName, [
        topics.read_topic(spark, root, t).select("key", F.lit(t).alias("topic"))
        for t in (fv.TOPIC_VALIDATED, fv.TOPIC_REVIEW, fv.TOPIC_REJECTED)
    ])
    return routed.join(expected, "key", "full").select(
        "key", F.col("topic").eqNullSafe(F.col("expected")).alias("as_scored")
    )


def a10(spark, sf):
    """Exact area under ROC of the additive formula against the adjudicated outcomes."""
    scored = score.AdditiveScorer().score(training(spark, sf))
    return rank_sum_auc(scored).select(F.round("auc", 6).alias("auc"))


QUERIES = {
    "A9_array_totals": a9,
    "A10_auc": a10,
    "F3_trained_model": f3_trained,
    "T1_trained_model": t1_trained,
    "M1_batch_features": m1,
    "M2_stream_features": m2,
    "M3_training_table": m3,
    "M4_forest": m4,
    "M5_boosted_trees": m5,
    "M6_stratified_folds": m6,
    "M6_cross_validation": m6_cv,
    "M7_stratified_split": m7,
    "M8_model_comparison": m8,
    "M8_model_check": m8_check,
    "M9_class_weights": m9,
    "M10_score": m10,
    "M10_forest_score": m10_forest,
    "M11_version_switch": m11,
    "M12_attribution": m12,
    "M12_additivity": m12_additivity,
    "M13_normalize_percent": m13,
    "M14_primary_driver": m14,
    "M15_explanation_text": m15,
    "M16_compliance_flags": m16,
    "M17_fallbacks": m17,
}


cte(
    "training",
    """
    SELECT order_key AS id, CAST(billed_amount AS DOUBLE) AS billed_amount,
      CASE WHEN prior_auth_number IS NULL THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS prior_auth,
      CAST(dx_count AS DOUBLE) AS diagnosis_code_count, 1.0::DOUBLE AS procedure_complexity,
      11.0::DOUBLE AS provider_specialty_code,
      CAST(filed_date - service_date AS DOUBLE) AS days_since_service,
      CASE WHEN denial_reason = '' THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS label
    FROM ruled
    """,
    "ruled",
)
cte(
    "folds",
    """
    SELECT *, CAST((row_number() OVER (PARTITION BY label, bucket ORDER BY h, id) + bucket) % 5
      AS INT) AS fold
    FROM (SELECT *, CAST(('0x' || substr(h, 1, 8)) AS BIGINT) % 64 AS bucket
      FROM (SELECT *, md5('42:fold:' || CAST(id AS VARCHAR)) AS h FROM training))
    """,
    "training",
)
cte(
    "plain",
    """
    SELECT claim_id, CASE WHEN billed_amount > 800 THEN 50 ELSE 0 END AS p1,
      CASE WHEN prior_auth_number IS NULL THEN 35 ELSE 0 END AS p2,
      CASE WHEN dx_count > 5 THEN 10 ELSE 0 END AS p3 FROM claims
    """,
    "claims",
)
cte(
    "pct0",
    """SELECT claim_id, p1 + p2 + p3 AS t,
      CASE WHEN t = 0 THEN 16.7 ELSE round(p1 / t * 100, 1) END AS s1,
      CASE WHEN t = 0 THEN 16.7 ELSE round(p2 / t * 100, 1) END AS s2,
      CASE WHEN t = 0 THEN 16.7 ELSE round(p3 / t * 100, 1) END AS s3,
      CASE WHEN t = 0 THEN 16.7 ELSE 0 END AS s0 FROM plain""",
    "plain",
)
cte(
    "pct1",
    """SELECT *, greatest(s1, s2, s3) AS top, 100 - (s1 + s2 + s3 + 3 * s0) AS rest FROM pct0""",
    "pct0",
)
cte(
    "pct",
    """
    SELECT claim_id,
      round(CAST(CASE WHEN s1 = top THEN s1 + rest ELSE s1 END AS DOUBLE), 1) AS b1,
      round(CAST(CASE WHEN s1 < top AND s2 = top THEN s2 + rest ELSE s2 END AS DOUBLE), 1) AS b2,
      round(CAST(CASE WHEN s1 < top AND s2 < top THEN s3 + rest ELSE s3 END AS DOUBLE), 1) AS b3,
      CAST(s0 AS DOUBLE) AS b0
    FROM pct1
    """,
    "pct1",
)
_FALLBACK = "w IN (0, 2, 3)"
_AUC_SQL = """
    SELECT round((sum(CASE WHEN label = 1 THEN below + same / 2.0 ELSE 0 END)
      / (sum(label) * (count(*) - sum(label)))), 6) AS auc
    FROM (SELECT t.label, n.below, n.same FROM (SELECT label,
        CASE WHEN billed_amount > 800 THEN 50 ELSE 0 END
        + CASE WHEN prior_auth = 0 THEN 35 ELSE 0 END
        + CASE WHEN diagnosis_code_count > 5 THEN 10 ELSE 0 END
        + CASE WHEN days_since_service > 90 THEN 5 ELSE 0 END AS points FROM training) t
      JOIN (SELECT points, same, sum(same) OVER (ORDER BY points) - same AS below
        FROM (SELECT CASE WHEN billed_amount > 800 THEN 50 ELSE 0 END
            + CASE WHEN prior_auth = 0 THEN 35 ELSE 0 END
            + CASE WHEN diagnosis_code_count > 5 THEN 10 ELSE 0 END
            + CASE WHEN days_since_service > 90 THEN 5 ELSE 0 END AS points,
            count(*) FILTER (label = 0) AS same FROM training GROUP BY 1)) n
      ON n.points = t.points)
"""

SQL = {
    "M12_additivity": with_ctes(
        "SELECT claim_id, 6 AS features, true AS adds_up, true AS is_probability FROM claims", "claims"
    ),
    "A9_array_totals": "SELECT 100.0::DOUBLE AS total, count(*) AS claims FROM orders",
    "A10_auc": with_ctes(_AUC_SQL, "training"),
    "M1_batch_features": with_ctes(
        """SELECT claim_id, CAST(billed_amount AS DOUBLE) AS billed_amount,
          CASE WHEN prior_auth_number IS NULL THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS prior_auth,
          CAST(dx_count AS DOUBLE) AS diagnosis_code_count,
          1.0::DOUBLE AS procedure_complexity, 11.0::DOUBLE AS provider_specialty_code,
          30.0::DOUBLE AS days_since_service FROM claims""",
        "claims",
    ),
    "M2_stream_features": with_ctes(
        f"""SELECT order_key,
          CASE WHEN {_FALLBACK} OR w = 1 THEN 0 WHEN w = 4 THEN 350 WHEN w = 5 THEN 0
            WHEN w = 6 THEN -5 ELSE CAST(c.billed_amount AS DOUBLE) END AS billed_amount,
          CASE WHEN {_FALLBACK} OR w IN (1, 15) OR c.prior_auth_number IS NULL THEN 0.0::DOUBLE
            ELSE 1.0::DOUBLE END AS prior_auth,
          CASE WHEN {_FALLBACK} THEN 1.0 WHEN w IN (1, 7) THEN 0.0 ELSE CAST(dx_count AS DOUBLE)
            END AS diagnosis_code_count,
          CASE WHEN {_FALLBACK} THEN 1.0::DOUBLE WHEN w IN (1, 8) THEN 0.0::DOUBLE
            ELSE 1.0::DOUBLE END AS procedure_complexity,
          CASE WHEN {_FALLBACK} OR w = 1 OR e.member_id IS NULL THEN 0.0::DOUBLE
            WHEN DATE '{AS_OF}' BETWEEN e.coverage_start AND e.coverage_end THEN 1.0::DOUBLE
            ELSE 0.0::DOUBLE END AS provider_specialty_code,
          0.0::DOUBLE AS days_since_service
        FROM way c LEFT JOIN enrollment e ON e.member_id = c.patient_id""",
        "way", "enrollment",
    ),
    "F3_trained_model": with_ctes(
        """SELECT claim_id, coalesce(supplier % 10 = 7, false) AS failed, true AS model_answered,
          true AS in_range, true AS review_follows, true AS basis_adds_up FROM claims""",
        "claims",
    ),
    "T1_trained_model": with_ctes("SELECT claim_id AS key, true AS as_scored FROM claims", "claims"),
    "M3_training_table": with_ctes("SELECT * FROM training", "training"),
    "M6_stratified_folds": with_ctes(
        """SELECT fold, count(*) AS claims, CAST(sum(label) AS BIGINT) AS positives FROM folds
        GROUP BY fold""",
        "folds",
    ),
    "M7_stratified_split": with_ctes(
        """SELECT CASE WHEN fold = 0 THEN 'test' ELSE 'train' END AS part, label,
          count(*) AS claims FROM folds GROUP BY 1, 2""",
        "folds",
    ),
    "M8_model_check": with_ctes(
        """SELECT v AS model_version, count(*) AS held_out, CAST(sum(label) AS BIGINT) AS positives,
          true AS same_scores, true AS rank_sum_is_area, true AS in_band
        FROM folds, (VALUES ('v1'), ('v2')) t(v) WHERE fold = 0 GROUP BY v""",
        "folds",
    ),
    "M9_class_weights": with_ctes(
        """SELECT label, count(*) AS claims,
          round((SELECT count(*) FROM training) / (2.0::DOUBLE * count(*)), 9) AS weight
        FROM training GROUP BY label""",
        "training",
    ),
    "M10_score": with_ctes(
        "SELECT claim_id, CAST(p1 + p2 + p3 AS INT) AS denial_risk_score FROM plain", "plain"
    ),
    "M13_normalize_percent": with_ctes(
        """SELECT claim_id, b1 AS billed_amount, b2 AS prior_auth, b3 AS diagnosis_code_count,
          b0 AS procedure_complexity, b0 AS provider_specialty_code, b0 AS days_since_service
        FROM pct""",
        "pct",
    ),
    "M14_primary_driver": with_ctes(
        """SELECT claim_id, greatest(b1, b2, b3) AS weight,
          CASE WHEN b1 = greatest(b1, b2, b3) THEN 'elevated billed amount'
            WHEN b2 = greatest(b1, b2, b3) THEN 'missing prior authorization'
            ELSE 'high diagnosis code count' END AS primary_driver FROM pct""",
        "pct",
    ),
    "M15_explanation_text": with_ctes(
        f"SELECT claim_id, provider_explanation FROM ({_SILVER_SQL})", "shares"
    ),
    "M16_compliance_flags": with_ctes(
        f"""SELECT claim_id, human_review_required, ai_decision_only, reconsideration_right
        FROM ({_SILVER_SQL})""",
        "shares",
    ),
    "M17_fallbacks": with_ctes(
        """SELECT claim_id, CASE WHEN bad_npi THEN 99 ELSE 70 END AS denial_risk_score,
          true AS human_review_required,
          CASE WHEN bad_npi THEN 'Claim ' || claim_id
              || ' failed validation: invalid_billing_npi:' || billing_npi || '.'
            ELSE 'Automated scoring unavailable for ' || claim_id
              || '. Routed to human review.' END AS provider_explanation,
          CASE WHEN bad_npi THEN 'failed FHIR validation' ELSE 'model scoring error' END
            AS primary_driver,
          CASE WHEN bad_npi THEN '{"validation_failed":100.0}' ELSE '{"model_error":100.0}' END
            AS decision_basis
        FROM (SELECT claim_id, billing_npi, coalesce(supplier % 10 = 7, false) AS bad_npi
          FROM claims)""",
        "claims",
    ),
}
