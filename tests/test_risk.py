import json
import math
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from claimworks import fixed_values as fv
from claimworks.risk import explain, score, train, trees, versions
from claimworks.risk.auc import rank_sum_auc


@pytest.fixture(scope="module")
def model(spark):
    data = train.with_class_weight(train.synthetic(spark, 600))
    return train.forest(trees=10, depth=4).fit(data)


def inputs(spark, *rows):
    ddl = "claim_id string, " + ", ".join(f"{f} double" for f in fv.FEATURES)
    return spark.createDataFrame([(f"C{i}", *map(float, r)) for i, r in enumerate(rows)], ddl)


def test_attribution_matches_all_orderings(spark, model):
    """Brute force: average marginal contribution over every order of the players."""
    x, base = [1500.0, 0.0, 7.0, 2.0, 11.0, 120.0], [300.0, 1.0, 2.0, 2.0, 5.0, 10.0]
    n = len(x)
    vectors = [[x[i] if m >> i & 1 else base[i] for i in range(n)] for m in range(1 << n)]
    scored = score.probability_of(model, inputs(spark, *vectors))
    f = {int(r.claim_id[1:]): r.probability for r in scored.collect()}
    orders = list(permutations(range(n)))
    want = [0.0] * n
    for order in orders:
        mask = 0
        for player in order:
            want[player] += f[mask | 1 << player] - f[mask]
            mask |= 1 << player
    row = score.ModelScorer(model, baseline=base).attribute(inputs(spark, x)).first()
    for got, total in zip(row.contributions, want):
        assert got == pytest.approx(total / len(orders), abs=1e-9)
    assert sum(row.contributions) == pytest.approx(f[(1 << n) - 1] - f[0], abs=1e-9)
    assert row.contributions[3] == 0.0  # same as the baseline
    assert row.probability == pytest.approx(f[(1 << n) - 1])


def brute_paths(spark, model, x):
    """Shapley values over all subsets; an absent feature takes both ways of a split by the training rows' weight."""
    scaler = model.stages[1]
    scaled = [(v - m) * (1 / s if s else 0) for v, m, s in zip(x, scaler.mean, scaler.std)]
    forest = {}
    for row in trees.node_table(spark, model).collect():
        forest.setdefault(row.tree, {})[row.id] = row

    def value(tree, node, known):
        if node.left < 0:
            return node.value
        left, right = tree[node.left], tree[node.right]
        if node.feature in known:
            return value(tree, left if scaled[node.feature] <= node.threshold else right, known)
        return (left.cover * value(tree, left, known) + right.cover * value(tree, right, known)) / node.cover

    n = len(x)
    subsets = [{i for i in range(n) if m >> i & 1} for m in range(1 << n)]
    f = [sum(value(t, t[0], s) for t in forest.values()) / len(forest) for s in subsets]
    want = []
    for i in range(n):
        total = 0.0
        for m, s in enumerate(subsets):
            if i not in s:
                total += math.factorial(len(s)) * math.factorial(n - len(s) - 1) / math.factorial(n) * (f[m | 1 << i] - f[m])
        want.append(total)
    return want, f[0], f[-1]


def test_tree_attribution_equals_all_subsets(spark, model):
    rows = [[1500.0, 0.0, 7.0, 2.0, 11.0, 120.0], [300.0, 1.0, 2.0, 2.0, 5.0, 10.0], [799.9, 0.0, 6.0, 4.9, 20.0, 91.0]]
    scorer = score.ModelScorer(model)
    extra = inputs(spark, *rows).withColumn("c0", F.lit("clash")).withColumn("x0", F.lit(1))
    got = {r.claim_id: r for r in scorer.attribute(extra).collect()}
    for i, x in enumerate(rows):
        want, mean, full = brute_paths(spark, model, x)
        row = got[f"C{i}"]
        assert row.contributions == pytest.approx(want, abs=1e-9) and row.c0 == "clash" and row.x0 == 1
        assert row.probability == pytest.approx(full, abs=1e-9)
        assert scorer.explainer(spark).mean == pytest.approx(mean, abs=1e-9)


def test_tree_attribution_of_nulls_and_empty_frames(spark, model):
    scorer = score.ModelScorer(model)
    ddl = "claim_id string, " + ", ".join(f"{f} double" for f in fv.FEATURES)
    frame = spark.createDataFrame([("a", None, 1.0, 1.0, 1.0, 1.0, 1.0)], ddl)
    assert scorer.explainer(spark).contributions(frame).first().contributions is None
    assert scorer.attribute(inputs(spark, [1, 1, 1, 1, 1, 1]).limit(0)).count() == 0


@pytest.mark.parametrize(
    "values,expected",
    [
        ([0, 0, 0, 0, 0, 0], [16.5, 16.7, 16.7, 16.7, 16.7, 16.7]),
        ([1, -1, 1, 0, 0, 0], [33.4, 33.3, 33.3, 0, 0, 0]),
        ([-3, 1, 0, 0, 0, 0], [75.0, 25.0, 0, 0, 0, 0]),
        ([50, 35, 10, 0, 0, 0], [52.7, 36.8, 10.5, 0, 0, 0]),
    ],
)
def test_percentages_add_up(spark, values, expected):
    df = spark.createDataFrame([([float(v) for v in values],)], "contributions array<double>")
    assert explain.percentages(df).first().percent == expected


def explained(spark, scorer, row, errors=(), can_validate=True):
    df = inputs(spark, row).withColumn("can_validate", F.lit(can_validate)).withColumn(
        "errors", F.array(*[F.lit(e) for e in errors]).cast("array<string>"))
    return explain.explain(scorer.attribute(df), scorer.version).first()


def test_explanation_texts(spark):
    high = explained(spark, score.AdditiveScorer(), [900, 0, 1, 1, 11, 30])
    assert high.denial_risk_score == 85 and high.human_review_required
    assert high.provider_explanation == (
        "This claim was flagged for human review (risk score 85/100). The primary contributing "
        "factor was elevated billed amount (59% of risk attribution). A qualified reviewer will "
        "evaluate before any adverse determination."
    )
    assert high.primary_driver_weight == "59%" and high.model_version == "additive"
    assert high.feature_vector == [900.0, 0.0, 1.0, 1.0, 11.0, 30.0]
    low = explained(spark, score.AdditiveScorer(), [100, 0, 9, 1, 11, 30])
    assert low.provider_explanation == (
        "Claim scored 45/100 — below human review threshold. Primary risk factor: missing prior "
        "authorization (78% attribution)."
    )
    assert sum(json.loads(low.decision_basis).values()) == pytest.approx(100.0)


def test_fallbacks(spark):
    row = [900, 0, 1, 1, 11, 30]
    invalid = explained(spark, score.AdditiveScorer(), row, ["wrong_resource_type", "x"])
    assert (invalid.denial_risk_score, invalid.human_review_required) == (99, True)
    assert invalid.provider_explanation == "Claim C0 failed validation: wrong_resource_type."
    broken = explained(spark, score.FailedScorer(), row)
    assert (broken.denial_risk_score, broken.human_review_required) == (70, True)
    assert broken.model_version == "error"
    unavailable = explained(spark, score.AdditiveScorer(), row, can_validate=False)
    assert (unavailable.denial_risk_score, unavailable.human_review_required) == (0, False)
    assert unavailable.provider_explanation == "scoring_unavailable"
    for r in (invalid, broken, unavailable):
        assert r.ai_decision_only is False and r.reconsideration_right is True


def test_training_table_is_reproducible_and_shaped(spark):
    a = train.synthetic(spark, 4000)
    b = train.training_table(spark.range(4000).repartition(7), "id")
    assert a.exceptAll(b).count() == 0
    r = a.agg(
        F.min("billed_amount"), F.max("billed_amount"), F.avg("prior_auth"),
        F.min("diagnosis_code_count"), F.max("diagnosis_code_count"),
        F.max("provider_specialty_code"), F.max("days_since_service"), F.avg("label"),
    ).first()
    assert 50 <= r[0] < 60 and 1990 < r[1] < 2000 and abs(r[2] - 0.7) < 0.03
    assert (r[3], r[4], r[5], r[6]) == (1.0, 10.0, 20.0, 180.0)
    # 0.50 * P(billed > 800) + 0.35 * 0.3 + 0.10 * 0.5 + 0.05 * 90/181
    assert abs(r[7] - 0.487) < 0.03


def test_class_weights_balance(spark):
    data = train.with_class_weight(train.synthetic(spark, 1000))
    sums = [r[1] for r in data.groupBy("label").agg(F.round(F.sum("weight"), 6)).collect()]
    assert sums == [500.0, 500.0]


def test_folds_are_stratified(spark):
    rows = train.with_fold(train.synthetic(spark, 5000)).groupBy("fold").agg(
        F.count("*").alias("n"), F.avg("label").alias("p")).collect()
    assert len(rows) == 5
    assert max(abs(r.n - 1000) for r in rows) <= 64
    assert max(r.p for r in rows) - min(r.p for r in rows) < 0.03
    fit_on, held_out = train.stratified_split(train.synthetic(spark, 5000))
    assert abs(held_out.count() - 1000) <= 64 and fit_on.join(held_out, "id").count() == 0


def test_forest_reaches_the_published_auc(spark):
    data = train.with_class_weight(train.synthetic(spark, 3000))
    fit_on, held_out = train.stratified_split(data)
    value = train.auc(train.forest().fit(fit_on), held_out)
    assert value > 0.78


def test_train_or_load(spark, tmp_path, model):
    calls = []

    def fit():
        calls.append(1)
        return model

    path = str(tmp_path / "m")
    train.train_or_load(path, fit)
    train.train_or_load(path, fit)
    assert len(calls) == 1
    train.train_or_load(path, fit, force=True)
    assert len(calls) == 2


def test_version_switch(spark, tmp_path, model):
    store = versions.ModelStore(spark, str(tmp_path))
    assert isinstance(store.scorer_or_fallback(), score.FailedScorer)
    with pytest.raises(ValueError, match="unknown version"):
        store.activate("v3")
    store.save("v1", model)
    store.save("v2", model)
    store.activate("v1")
    first = store.scorer()
    assert store.scorer() is first and first.version == "v1"
    store.activate("v2")
    assert store.scorer().version == "v2"


def test_model_comparison(spark):
    row = train.compare_models(spark, 0.81494, 0.80911).first()
    assert (row.v1_auc, row.v2_auc, row.delta) == (0.8149, 0.8091, -0.0058)
    assert train.compare_models(spark, None, 0.8).first().delta is None


def pairs_auc(rows):
    """Share of (positive, negative) pairs in the right order, ties one half."""
    pos, neg = [s for s, y in rows if y == 1], [s for s, y in rows if y == 0]
    return sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize("distinct", [2, 7, 1000])
@pytest.mark.parametrize("parts", [2, 16])
def test_rank_sum_auc_is_the_share_of_ordered_pairs(spark, distinct, parts):
    rows = [(float(i * 7919 % distinct) / distinct - 0.5, float(i * 31 % 101 < 40 + i * 7919 % distinct * 30 / distinct))
            for i in range(600)]
    df = spark.createDataFrame(rows, "probability double, label double").repartition(5)
    row = rank_sum_auc(df, parts=parts).first()
    assert row.auc == pytest.approx(pairs_auc(rows), abs=1e-12)
    exact = train.evaluator().setRawPredictionCol("probability").setNumBins(0).evaluate(df)
    assert row.auc == pytest.approx(exact, abs=1e-9)
    assert (row.positives, row.negatives) == (sum(y == 1 for _, y in rows), sum(y == 0 for _, y in rows))


def test_rank_sum_auc_of_odd_rows(spark):
    rows = [(0.1, 0.0), (0.9, 1.0), (None, 1.0), (float("nan"), 0.0), (0.2, None), (0.3, 2.0),
            (0.0, 0.0), (-0.0, 1.0), (math.inf, 1.0), (-math.inf, 0.0)]
    df = spark.createDataFrame(rows, "probability double, label double")
    kept = [(s, y) for s, y in rows if s is not None and s == s and y in (0, 1)]
    assert rank_sum_auc(df).first().auc == pytest.approx(pairs_auc(kept), abs=1e-12)
    assert rank_sum_auc(df.where("label = 1")).first().auc is None
    empty = rank_sum_auc(df.limit(0)).first()
    assert (empty.positives, empty.negatives, empty.auc) == (0, 0, None)


def test_training_rows_carry_the_adjudicated_outcome(spark):
    from claimworks.operators import fhir

    claims = [  # id, member, date, cpt, billed, authorization, label
        ("paid", "M1", "20240101", "99213", 100.0, None, 0.0),
        ("auth", "M1", "20240101", "99213", 1500.0, None, 1.0),
        ("with", "M1", "20240101", "99213", 1500.0, "A1", 0.0),
        ("late", "M1", "20230101", "99213", 100.0, None, 1.0),
        ("none", "M2", "20240101", "99213", 100.0, None, 1.0),
    ]
    rows = spark.createDataFrame(
        [(i, "1234567893", "", m, d, ["J06.9"] * 2, [c], b, a) for i, m, d, c, b, a, _ in claims],
        "transaction_id string, billing_npi string, rendering_npi string, patient_member_id string, "
        "date_of_service string, diagnosis_codes array<string>, procedure_codes array<string>, "
        "billed_amount double, prior_auth_number string")
    members = spark.createDataFrame([("M1", "2020-01-01", "2030-01-01", "PPO", "P", "G")],
        "member_id string, s string, e string, plan_type string, payer_id string, group_number string").selectExpr(
        "*", "date(s) AS coverage_start", "date(e) AS coverage_end")
    json = fhir.map_to_fhir(rows, "P").select("claim_id", "fhir_json")
    broken = spark.createDataFrame([("bad", "no json")], "claim_id string, fhir_json string")
    got = {r.claim_id: r for r in train.claims_table(
        json.unionByName(broken), members, F.lit("2024-02-01").cast("date")).collect()}
    assert {k: r.label for k, r in got.items()} == {c[0]: c[-1] for c in claims}
    assert got["with"].prior_auth == 1.0 and got["auth"].prior_auth == 0.0
    assert got["late"].days_since_service == 396.0 and got["paid"].days_since_service == 31.0
    assert got["paid"].diagnosis_code_count == 2.0 and got["auth"].billed_amount == 1500.0


def test_boosting_on_added_up_rows_is_boosting_on_all_rows(spark, monkeypatch):
    """Few rows reach the trees, and the model answers as one fitted on every row."""
    once = train.synthetic(spark, 300).drop("id")
    data = train.with_class_weight(once.crossJoin(spark.range(20).select("id"))).repartition(3)
    pipeline = train.boosted(rounds=4, depth=3)
    kept = []
    spread = train.spread
    monkeypatch.setattr(train, "spread", lambda df: kept.append(df.count()) or spread(df))
    fewer = train.fit_boosted(data, pipeline)
    assert kept and kept[0] <= 300
    want, got = (score.probability_of(m, once).collect() for m in (pipeline.fit(data), fewer))
    key = lambda r: r[:-1]
    for a, b in zip(sorted(want, key=key), sorted(got, key=key)):
        assert a.probability == pytest.approx(b.probability, abs=1e-9)


def test_attribution_of_boosted_trees_adds_up(spark):
    data = train.with_class_weight(train.synthetic(spark, 300))
    fitted = train.fit_boosted(data, train.boosted(rounds=4, depth=3))
    base = [300.0, 1.0, 2.0, 2.0, 5.0, 10.0]
    rows = inputs(spark, [1500.0, 0.0, 7.0, 2.0, 11.0, 120.0], [900.0, 1.0, 2.0, 4.0, 5.0, 10.0], base)
    out = {r.claim_id: r for r in score.ModelScorer(fitted, baseline=base).attribute(rows).collect()}
    start = out["C2"].probability
    for r in out.values():
        assert sum(r.contributions) == pytest.approx(r.probability - start, abs=1e-9)
    direct = {r.claim_id: r.probability for r in score.probability_of(fitted, rows).collect()}
    assert direct == pytest.approx({k: r.probability for k, r in out.items()})


def test_narrow_training_rows_are_spread(spark):
    rows = train.synthetic(spark, 100).coalesce(1)
    with train.spread(rows, rows_per_task=4) as many:
        assert many.rdd.getNumPartitions() == 25 and many.count() == 100
    with train.spread(rows) as few:
        assert few.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_forest_draws_from_a_bounded_number_of_rows(spark, monkeypatch):
    """Few rows reach the trees, all weight does, and the model is as good as one fitted on every row."""
    data = train.with_class_weight(train.synthetic(spark, 6000)).persist()
    fit_on, held_out = train.stratified_split(data)
    once = fit_on.drop("id").withColumn("billed_amount", F.ceil(F.col("billed_amount") / 400) * 400.0)
    few_cells = once.withColumns({f: F.lit(1.0) for f in ("procedure_complexity", "provider_specialty_code")})
    kept, spread = [], train.spread
    monkeypatch.setattr(
        train, "spread", lambda df: kept.append(df.agg(F.count("*"), F.sum("weight")).first()) or spread(df)
    )
    train.fit_forest(few_cells.drop("days_since_service").withColumn("days_since_service", F.lit(1.0)),
                     train.binned_forest(trees=2), rows=300)
    total = few_cells.agg(F.sum("weight")).first()[0]
    assert kept[0][0] <= 300 and kept[0][1] == pytest.approx(total)
    assert train.auc(train.fit_forest(fit_on, train.binned_forest(trees=20)), held_out) > 0.78
    data.unpersist()


def test_attribution_of_a_binned_forest_adds_up(spark):
    fitted = train.fit_forest(train.with_class_weight(train.synthetic(spark, 600)), train.binned_forest(10, 4))
    scorer = score.ModelScorer(fitted)
    out = scorer.attribute(inputs(spark, [1500, 0, 7, 2, 11, 120], [300, 1, 2, 2, 5, 10])).collect()
    for r in out:
        assert sum(r.contributions) + scorer.explainer(spark).mean == pytest.approx(r.probability, abs=1e-9)
    assert out[0].contributions != out[1].contributions


def test_versions_learn_and_score_from_one_parse_of_the_claims(spark, monkeypatch):
    """The stored claims hold the training rows and the batch inputs; no second parse makes either."""
    from claimworks.operators import fhir
    from claimworks.registry import risk

    sf = "/root/testdata/sf0.001"
    claims = risk._stored_claims(spark, sf)
    for got, want in (
        (train.learnable(claims, "id"), risk.training(spark, sf)),
        (claims.select("claim_id", "batch.*"), risk.claim_inputs(spark, sf)),
    ):
        assert got.columns == want.columns
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    parses, read = [], fhir.with_variant
    monkeypatch.setattr(fhir, "with_variant", lambda *a, **k: parses.append(1) or read(*a, **k))
    monkeypatch.setattr(train, "boosted", lambda: boosted_of_few(2))
    out = risk.m11(spark, sf)
    assert len(parses) == 1 and out.count() == 2 * claims.count()


def boosted_of_few(rounds, real=train.boosted):
    return real(rounds=rounds)


def test_claims_that_are_no_objects_are_scored_but_not_learned_from(spark):
    from claimworks.fixtures import star

    damaged = star.spoiled(star.claims(spark, "/root/testdata/sf0.001")).withColumnRenamed("order_key", "id")
    members, filed = star.enrollment(spark, "/root/testdata/sf0.001"), F.col("filed_date")
    rows = train.claims_and_inputs(damaged, members, filed, "id")
    assert rows.count() == damaged.count() > rows.where("is_object").count()
    got, want = train.learnable(rows, "id"), train.claims_table(damaged, members, filed, "id")
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
