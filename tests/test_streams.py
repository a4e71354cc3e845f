import json

from pyspark.sql import functions as F
from test_claims import ENROLLMENT, ENROLLMENT_DDL, claim

from claimworks import fixed_values as fv
from claimworks import schemas
from claimworks.risk.score import AdditiveScorer
from claimworks.risk.versions import FixedModel
from claimworks.sources import topics
from claimworks.streaming import jobs

DAY = "2026-02-01"


def put(spark, root, topic, batch, *pairs, producer="test"):
    rows = [(topic, k, v if isinstance(v, str) else json.dumps(v)) for k, v in pairs]
    df = spark.createDataFrame(rows, "topic string, key string, value string")
    topics.write_messages(df, root, producer, batch)


def keys(spark, root, topic):
    return sorted(r.key for r in topics.read_topic(spark, root, topic).collect())


def enrolled(spark):
    return spark.createDataFrame(ENROLLMENT, ENROLLMENT_DDL)


def test_a_repeated_batch_adds_nothing(spark, tmp_path):
    root = str(tmp_path)
    put(spark, root, "t", 0, ("a", "1"), ("b", "2"))
    put(spark, root, "t", 0, ("a", "1"), ("b", "2"))
    put(spark, root, "t", 1, ("c", "3"))
    assert keys(spark, root, "t") == ["a", "b", "c"]
    assert topics.topic_counts(spark, root).first().messages == 3


def test_topic_files_are_compressed_and_end_after_a_number_of_messages(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(topics, "MESSAGES_PER_FILE", 100)
    rows = spark.range(0, 1000, 1, 1).selectExpr("'t' topic", "cast(id as string) key", "repeat('claim ', 500) value")
    topics.write_messages(rows, str(tmp_path), "test", 0)
    files = list(tmp_path.rglob("part-*"))
    assert len(files) == 10 and sum(f.stat().st_size for f in files) < 1000 * 3000 / 20
    assert keys(spark, str(tmp_path), "t") == sorted(str(i) for i in range(1000))


class Switch:
    """Answers with another scorer from the second micro-batch on."""

    def __init__(self):
        self.asked = 0

    def scorer(self):
        self.asked += 1
        return AdditiveScorer() if self.asked == 1 else self

    def score(self, df):
        return df.withColumn("probability", F.lit(None).cast("double"))


def test_route_once_per_message_and_new_model_per_batch(spark, tmp_path):
    root, checkpoint, models = str(tmp_path / "t"), str(tmp_path / "c"), Switch()
    put(spark, root, fv.TOPIC_RAW, 0,
        ("low", claim(total={"value": 10.0})),
        ("mid", claim(total={"value": 900.0})),
        ("high", claim(total={"value": 900.0}, _prior_auth=None)),
        ("junk", "not json"))
    day = F.lit(DAY).cast("date")
    jobs.score_and_route(spark, root, enrolled(spark), models, checkpoint, as_of=day)
    # The fallback vector has no authorization: 35 points.
    assert keys(spark, root, fv.TOPIC_VALIDATED) == ["junk", "low"]
    assert keys(spark, root, fv.TOPIC_REVIEW) == ["mid"]
    assert keys(spark, root, fv.TOPIC_REJECTED) == ["high"]
    put(spark, root, fv.TOPIC_RAW, 1, ("later", claim(total={"value": 10.0})))
    jobs.score_and_route(spark, root, enrolled(spark), models, checkpoint, as_of=day)
    assert models.asked == 2
    assert "later" in keys(spark, root, fv.TOPIC_REVIEW)  # unscored: undecided
    total = sum(len(keys(spark, root, t)) for t in
                (fv.TOPIC_VALIDATED, fv.TOPIC_REVIEW, fv.TOPIC_REJECTED))
    assert total == 5


def test_processing_keeps_failed_messages(spark, tmp_path):
    root = str(tmp_path / "t")
    put(spark, root, fv.TOPIC_RAW, 0, ("C1", claim()), ("x", "junk"),
        ("C2", claim(id="C2", item=[])))
    jobs.process_claims(spark, root, enrolled(spark), str(tmp_path / "c"),
                        F.lit(DAY).cast("date"), failed=str(tmp_path / "failed"))
    assert keys(spark, root, fv.TOPIC_REMITTANCE) == ["C1"]
    assert keys(spark, root, fv.TOPIC_REJECTED) == ["C2"]
    failed = spark.read.parquet(str(tmp_path / "failed"))
    assert [r.value for r in failed.collect()] == ["junk"]


def record(claim_id, paid, **extra):
    return {"claim_id": claim_id, "status": "paid", "paid_amount": paid, **extra}


def test_remittance_upsert_is_idempotent(spark, tmp_path):
    root, table = str(tmp_path / "t"), str(tmp_path / "gold")
    put(spark, root, fv.TOPIC_REMITTANCE, 0, ("a", record("a", 1)), ("b", record("b", 2)),
        ("bad", '{"claim_id": "z", "status": "paid", "paid_amount": "x"}'), ("junk", "{"))
    jobs.remittance_to_table(spark, root, table, str(tmp_path / "c1"))
    put(spark, root, fv.TOPIC_REMITTANCE, 1, ("b", record("b", 5)))
    jobs.remittance_to_table(spark, root, table, str(tmp_path / "c1"))

    def state():
        rows = jobs.remittance_table(spark, table).read().collect()
        return sorted((r.claim_id, r.paid_amount, r.billed_amount) for r in rows)

    assert state() == [("a", 1.0, 0.0), ("b", 5.0, 0.0)]
    jobs.remittance_to_table(spark, root, table, str(tmp_path / "c2"))  # replay
    assert state() == [("a", 1.0, 0.0), ("b", 5.0, 0.0)]


def test_archive_rerun_adds_only_new_messages(spark, tmp_path):
    root, out, checkpoint = str(tmp_path / "t"), str(tmp_path / "a"), str(tmp_path / "c")
    put(spark, root, fv.TOPIC_RAW, 0, ("k1", '{"x": 1}'), ("k2", "plain"))
    for _ in range(2):
        jobs.archive(spark, root, out, checkpoint)
    put(spark, root, fv.TOPIC_REJECTED, 1, ("k3", '[1, "a"]'))
    jobs.archive(spark, root, out, checkpoint)
    got = {}
    for row in spark.read.text(out).collect():
        line = json.loads(row.value)
        assert set(line) == {"key", "value", "ts"}
        got[row.topic, line["key"]] = line["value"]
    assert got == {
        (fv.TOPIC_RAW, "k1"): {"x": 1}, (fv.TOPIC_RAW, "k2"): "plain",
        (fv.TOPIC_REJECTED, "k3"): [1, "a"],
    }


def test_stream_result_is_batch_result(spark, tmp_path):
    root = str(tmp_path / "t")
    put(spark, root, fv.TOPIC_RAW, 0, *[
        (f"C{i}", claim(id=f"C{i}", total={"value": 100.0 * i})) for i in range(1, 20)])
    day = F.lit(DAY).cast("date")
    messages = topics.read_topic(spark, root, fv.TOPIC_RAW)
    batch = jobs.route(messages.select("key", "value"), enrolled(spark), AdditiveScorer(), day)
    want = sorted((r.topic, r.key) for r in batch.collect())
    jobs.score_and_route(spark, root, enrolled(spark), FixedModel(), str(tmp_path / "c"), day)
    got = [(t, k) for t in {t for t, _ in want} for k in keys(spark, root, t)]
    assert sorted(got) == want


def test_silver_follows_bronze_by_new_rows_only(spark, tmp_path):
    from claimworks.fixtures import star
    from claimworks.plans import lake

    bronze, silver, checkpoint = (str(tmp_path / n) for n in ("bronze", "silver", "checkpoint"))
    rows = star.bronze(spark, "/root/testdata/sf0.001").select(*schemas.columns(schemas.BRONZE)).orderBy("claim_id").limit(60)
    ids = [r[0] for r in rows.select("claim_id").collect()]
    read = []
    for part in (F.col("claim_id") <= ids[40], F.col("claim_id") > ids[40], F.lit(False)):
        rows.where(part).write.mode("append").parquet(bronze)
        query = jobs.bronze_to_silver(spark, bronze, silver, checkpoint)
        read.append(sum(p["numInputRows"] for p in query.recentProgress))
    assert read[0] + read[1] == 60 and 0 < read[1] < 30 and read[2] == 0
    drop = ["ingest_ts", "processed_ts"]
    got, want = lake.silver_table(spark, silver).read().drop(*drop), lake.to_silver(rows).drop(*drop)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_only_failed_messages_keep_their_text_beyond_the_parse(spark):
    """Messages that can be read are joined and stored without their text."""
    from claimworks.operators import validate

    rows = spark.createDataFrame([("C1", json.dumps(claim())), ("x", "junk")], "_key string, value string")
    out = validate.process_messages(
        rows.withColumn("_raw", F.col("value")), enrolled(spark), F.lit(DAY).cast("date"), keep_failed=["_key", "_raw"]
    )
    assert {(r.outcome, r._key, r._raw) for r in out.collect()} == {("paid", None, None), ("failed", "x", "junk")}


def test_processing_stores_no_message_in_memory_or_cache(spark, tmp_path, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    kept = []
    monkeypatch.setattr(DataFrame, "persist", lambda df, *a: kept.append(df) or df)
    test_processing_keeps_failed_messages(spark, tmp_path)
    assert not kept


def test_silver_and_quarantine_come_from_one_parse(spark, tmp_path):
    from claimworks.fixtures import star
    from claimworks.plans import lake

    damaged = star.spoiled(star.claims(spark, "/root/testdata/sf0.001")).select("claim_id", "fhir_json")
    bronze, silver, dropped = (str(tmp_path / n) for n in ("bronze", "silver", "quarantine"))
    stamp = F.lit("2026-01-01").cast("timestamp")
    damaged.select("*", stamp.alias("ingest_ts"), stamp.alias("received_ts")).write.parquet(bronze)
    rows = spark.read.schema(schemas.BRONZE).parquet(bronze)
    jobs.bronze_to_silver(spark, bronze, silver, str(tmp_path / "c"), quarantine=dropped)
    got, want = spark.read.parquet(dropped).drop("batch"), lake.quarantine(rows)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect())) and got.count() > 0
    got, want = (t.drop("processed_ts") for t in (lake.silver_table(spark, silver).read(), lake.to_silver(rows)))
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    plan = lake.sorted_out(rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("try_parse_json") <= lake.parse_bronze(rows)._jdf.queryExecution().executedPlan().toString().count("try_parse_json")


def test_gold_looks_for_the_latest_silver_rows_once(spark, tmp_path):
    from claimworks.fixtures import star
    from claimworks.plans import lake

    bronze = star.bronze(spark, "/root/testdata/sf0.001")
    table = lake.silver_table(spark, str(tmp_path / "silver"))
    table.upsert(lake.to_silver(bronze))
    short = table.read(columns=lake.gold.READ)
    whole = table.read().select(*lake.gold.READ)
    assert sorted(map(repr, short.collect())) == sorted(map(repr, whole.collect()))
    assert "provider_explanation" not in short._jdf.queryExecution().optimizedPlan().toString().split("Project")[0]
    seen = lake.silver_to_gold(spark, short, str(tmp_path / "gold"))
    assert seen["claims_summary"] == whole.count()
    assert seen["provider_summary"] == spark.read.parquet(str(tmp_path / "gold/provider_summary")).count()
