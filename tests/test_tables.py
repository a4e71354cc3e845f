import pytest
from pyspark.sql import functions as F

from claimworks.operators.dedup import latest_per_key
from claimworks.plans import quality, semantic
from claimworks.sources.tables import KeyedTable, cluster, typed_table

DDL = "k string, v int"


def table(spark, path, **options):
    return KeyedTable(spark, str(path), "k", DDL, **options)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def frame(spark, *pairs):
    return spark.createDataFrame(list(pairs), DDL)


def test_upsert_updates_inserts_and_keeps(spark, tmp_path):
    t = table(spark, tmp_path / "t")
    assert rows(t.read()) == []
    first = t.upsert(frame(spark, ("a", 1), ("b", 2)))
    t.upsert(frame(spark, ("b", 20), ("c", 3)))
    assert rows(t.read()) == [("a", 1), ("b", 20), ("c", 3)]
    assert rows(t.read(until=first)) == [("a", 1), ("b", 2)]


def test_upsert_twice_is_upsert_once(spark, tmp_path):
    t = table(spark, tmp_path / "t")
    t.upsert(frame(spark, *[(f"k{i}", i) for i in range(50)]))
    change = frame(spark, *[(f"k{i}", -i) for i in range(40, 60)])
    t.upsert(change)
    once = rows(t.read())
    t.upsert(change)
    assert rows(t.read()) == once and len(once) == 60


def test_upsert_writes_only_its_rows(spark, tmp_path):
    t = table(spark, tmp_path / "t")

    def size():
        return sum(p.stat().st_size for p in (tmp_path / "t").rglob("*.parquet"))

    t.upsert(spark.range(100_000).selectExpr("concat('k', id) k", "cast(hash(id) as int) v"))
    whole = size()
    t.upsert(spark.range(2_000).selectExpr("concat('k', id * 50) k", "1 v"))
    assert size() - whole < 0.05 * whole
    assert t.read().where("v = 1").count() >= 2_000 and t.read().count() == 100_000


def test_compaction_keeps_what_a_read_shows(spark, tmp_path):
    t = table(spark, tmp_path / "t")
    for i in range(4):
        t.upsert(frame(spark, ("a", i), (f"b{i}", i)))
    before = rows(t.read())
    assert t.compact() == 1
    assert rows(t.read()) == before and t._rows(1).count() == len(before)
    t.upsert(frame(spark, ("a", 9)))
    assert ("a", 9) in rows(t.read()) and len(rows(t.read())) == len(before)
    assert t.compact() == 2 and not (tmp_path / "t" / "gen=1").exists()


def test_an_unfinished_compaction_is_not_read(spark, tmp_path):
    t = table(spark, tmp_path / "t")
    t.upsert(frame(spark, ("a", 1)))
    (tmp_path / "t" / "gen=1").mkdir()
    assert rows(t.read()) == [("a", 1)]


def test_empty_upsert_changes_nothing(spark, tmp_path):
    t = table(spark, tmp_path / "t")
    t.upsert(frame(spark, ("a", 1)))
    t.upsert(spark.createDataFrame([], DDL))
    assert rows(t.read()) == [("a", 1)]


def test_latest_per_key(spark):
    df = spark.createDataFrame(
        [("a", 1, None), ("a", 2, 5), ("a", 3, 4), ("b", 9, None), (None, 7, 1)],
        "k string, v int, t int",
    )
    out = latest_per_key(df, "k", [F.col("t"), F.xxhash64("v")], drop=["t"])
    assert sorted(map(tuple, out.collect()), key=repr) == [("a", 2), ("b", 9), (None, 7)]


def test_latest_per_key_adds_no_exchange_for_a_join_on_the_key(spark):
    df = spark.range(100).selectExpr("cast(id % 7 as string) k", "id v", "id t")
    latest = latest_per_key(df, "k", [F.col("t")])
    again = latest.groupBy("k").agg(F.sum("v").alias("s"))
    plan = again._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_cluster_gives_disjoint_sorted_ranges(spark, tmp_path):
    df = spark.range(1000).selectExpr("lpad(cast(id * 7 % 1000 as string), 4, '0') k", "id")
    cluster(df, "k", partitions=4).write.parquet(str(tmp_path / "c"))
    back = spark.read.parquet(str(tmp_path / "c")).withColumn(
        "f", F.col("_metadata.file_path"))
    spans = sorted(tuple(r)[1:] for r in back.groupBy("f").agg(F.min("k"), F.max("k")).collect())
    assert len(spans) == 4
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def test_clustering_on_two_columns_prunes_on_both(spark, tmp_path):
    df = spark.range(4000).selectExpr("lpad(cast(id * 7 % 4000 as string), 4, '0') k", "cast(id * 13 % 4000 as int) d", "id")
    spans = {}
    for name, frame_ in (("z", cluster(df, "k", "d", partitions=16)), ("flat", df.repartitionByRange(16, "k", "d"))):
        frame_.write.parquet(str(tmp_path / name))
        back = spark.read.parquet(str(tmp_path / name)).withColumn("f", F.col("_metadata.file_path"))
        spans[name] = back.groupBy("f").agg(F.min("k"), F.max("k"), F.min("d"), F.max("d")).collect()
        assert back.count() == 4000

    def skipped(files, low, high, text):
        probes = [f"{p:04d}" if text else p for p in range(100, 4000, 100)]
        return sum(not r[low] <= p <= r[high] for r in files for p in probes) / len(files) / len(probes)

    assert skipped(spans["z"], 1, 2, True) > 0.6 and skipped(spans["z"], 3, 4, False) > 0.6
    assert skipped(spans["flat"], 3, 4, False) < 0.2


def test_clustering_takes_nulls_and_empty_frames(spark):
    df = spark.createDataFrame([(None, 1), ("a", None), (None, None), ("b", 2)], "k string, d int")
    assert sorted(cluster(df, "k", "d").collect(), key=repr) == sorted(df.collect(), key=repr)
    assert cluster(df.limit(0), "k", "d").count() == 0


def test_order_of_upserts_needs_no_clock_and_origins_are_applied_once(spark, tmp_path):
    t = table(spark, tmp_path / "t")
    assert t.upsert(frame(spark, ("a", 1)), "stream-0") == 1
    assert t.upsert(frame(spark, ("a", 2), ("b", 2)), "stream-1") == 2
    assert t.upsert(frame(spark, ("a", 9)), "stream-0") == 1  # tried again: its place stays before the second
    assert rows(t.read()) == [("a", 2), ("b", 2)]
    assert rows(t.read(until=1)) == [("a", 9)]
    t.compact()
    assert t.upsert(frame(spark, ("a", 3))) == 3
    assert rows(t.read()) == [("a", 3), ("b", 2)]


def test_typed_table(spark, tmp_path):
    spark.createDataFrame(
        [("a", "12.345", "2026-01-01"), ("b", "x", "bad")], "k string, m string, d string"
    ).write.parquet(str(tmp_path / "p"))
    out = typed_table(spark, str(tmp_path / "p"), "k string, m decimal(12,2), d date, z int")
    got = {r.k: (str(r.m), str(r.d), r.z) for r in out.collect()}
    assert got == {"a": ("12.35", "2026-01-01", None), "b": ("None", "None", None)}


def test_suite_runs_in_one_aggregate(spark):
    df = spark.createDataFrame([(1, "a"), (None, "bb")], "n int, s string")
    suite = [
        {"type": "not_null", "column": "n"},
        {"type": "between", "column": "n", "min": 0, "max": 1},
        {"type": "length_between", "column": "s", "min": 1, "max": 1},
        {"type": "in_set", "column": "s", "values": ["a", "bb"]},
        {"type": "column_exists", "column": "zz"},
        {"type": "column_type", "column": "n", "dtype": "int"},
        {"type": "matches_regex", "column": "s", "regex": "^a"},
        {"type": "row_count_between", "min": 3, "max": 9},
    ]
    out = quality.run_suite(df, suite, "s")
    assert [r.success for r in out.orderBy("position").collect()] == [
        False, True, False, True, False, True, False, False,
    ]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    with pytest.raises(ValueError, match="unknown expectation"):
        quality.run_suite(df, [{"type": "nope", "column": "n"}], "s")


def test_model_tests_find_failures(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "c string")
    tests = [("m", "c", "not_null", None), ("m", "c", "unique", None),
             ("m", "c", "accepted_values", ["b"])]
    got = {r.test: r.failures for r in quality.run_model_tests({"m": df}, tests).collect()}
    assert got == {"not_null": 1, "unique": 1, "accepted_values": 2}


def test_metric_select(spark):
    base = spark.createDataFrame(
        [("n1", 5, 0.5, 10.0, 1.0, 3.0), ("n2", 7, 0.1, 20.0, 2.0, 4.0)],
        "billing_npi string, claim_count int, denial_rate double, total_billed double, "
        "total_paid double, avg_denial_risk double",
    )
    out = semantic.metric_select(
        {"CLAIMS_BY_PROVIDER": base}, "CLAIMS_BY_PROVIDER", ["provider_npi"], ["claim_count"],
        where="denial_rate < 1", order=["total_billed desc"], limit=1,
    )
    assert [tuple(r) for r in out.collect()] == [("n2", 7)]
    with pytest.raises(KeyError, match="unknown dimension"):
        semantic.metric_select({"CLAIMS_BY_PROVIDER": base}, "CLAIMS_BY_PROVIDER", ["zz"])
    with pytest.raises(ValueError):
        semantic.metric_select({"CLAIMS_BY_PROVIDER": base}, "CLAIMS_BY_PROVIDER")


def test_uniqueness_of_several_columns_takes_one_scan_and_one_shuffle_of_rows(spark, tmp_path):
    rows = [("a", 1, "x"), ("a", 2, None), (None, 2, "x"), (None, None, "y"), ("b", 3, "z")]
    spark.createDataFrame(rows, "c string, n int, s string").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    tests = [("m", "c", "unique", None), ("m", "n", "unique", None), ("m", "s", "unique", None),
             ("m", "c", "not_null", None), ("m", "n", "not_null", None), ("m", "s", "accepted_values", ["x", "y"])]
    out = quality.run_model_tests({"m": df}, tests)
    got = {(r.column_name, r.test): r.failures for r in out.collect()}
    assert got == {("c", "unique"): 1, ("n", "unique"): 1, ("s", "unique"): 1, ("c", "not_null"): 2,
                   ("n", "not_null"): 1, ("s", "accepted_values"): 1}
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Expand") == 1
    executed = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert executed.count("Exchange hashpartitioning") == 1 and executed.count("Exchange SinglePartition") == 1
    empty = quality.run_model_tests({"m": df.limit(0)}, tests)
    assert {r.failures for r in empty.collect()} == {0}


def test_numbers_have_no_gaps(spark):
    from claimworks.operators.numbering import numbered

    keys = [i * 7919 % 1000 for i in range(1000)]
    df = spark.createDataFrame([(k, "p") for k in keys], "k int, position_of string").repartition(7)
    got = {r.k: r.place for r in numbered(df.orderBy(F.col("k").desc()), "place", 5).collect()}
    assert got == {k: 1004 - k for k in range(1000)}
    assert numbered(df.limit(0).orderBy("k")).count() == 0


def test_states_regroup_to_what_claims_give(spark):
    import datetime

    day = datetime.date
    rows = [("c1", "p", day(2024, 1, 1), 1, 10, 0, 80), ("c2", "p", day(2024, 2, 1), 0, 30, 15, 20),
            ("c3", "q", day(2024, 2, 1), 0, 0, 0, None), (None, "q", day(2024, 5, 1), 1, 5, 0, 60)]
    claims = spark.createDataFrame(
        rows, "claim_id string, billing_npi string, claim_month date, is_denied int, "
        "billed_amount int, paid_amount int, denial_risk_score int").withColumns(
        {c: F.col(c).cast("decimal(12,2)") for c in ("billed_amount", "paid_amount")})
    states = semantic.measure_states(claims, ["billing_npi", "claim_month"])
    names = ["claim_count", "denial_rate", "collection_rate_pct", "avg_denial_risk"]
    whole = semantic.regroup(states, names).first()
    assert tuple(whole) == (3, 50.0, 33.33, 53.33)  # ratios of sums, not means of ratios
    quarters = {tuple(r)[:2]: tuple(r)[2:] for r in
                semantic.regroup(states, names, ["billing_npi"], "quarter").collect()}
    assert quarters[("p", day(2024, 1, 1))] == (2, 50.0, 37.5, 50.0)
    assert quarters[("q", day(2024, 1, 1))] == (1, 0.0, None, None)
    assert quarters[("q", day(2024, 4, 1))] == (0, 100.0, 0.0, 60.0)
    with pytest.raises(KeyError):
        semantic.regroup(states, ["unique_patients"])
    with pytest.raises(KeyError):
        semantic.regroup(states, names, grain="week")


def test_external_tables_show_new_files_after_a_refresh(spark, tmp_path):
    from claimworks.sources import catalog

    path = str(tmp_path / "it's")
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, p string")
    rows.where("p = 'a'").write.partitionBy("p").parquet(path)
    name = catalog.external_table(spark, "order", "t", path, "k INT, p STRING", ("p",))
    assert spark.table(name).count() == 0
    catalog.refresh_table(spark, name)
    assert [tuple(r) for r in spark.table(name).collect()] == [(1, "a")]
    rows.where("p <> 'a'").write.mode("append").partitionBy("p").parquet(path)
    assert spark.table(name).count() == 1
    catalog.refresh_table(spark, name)
    assert spark.table(name).count() == 3
    assert catalog.listed(spark, "order") == [("t", "EXTERNAL")]
    spark.sql(f"DROP TABLE {name}")
    assert spark.read.parquet(path).count() == 3  # the files stay


def test_a_custom_schema_replaces_the_default():
    from claimworks.plans import marts

    assert marts.schema_name("dev") == "dev" and marts.schema_name("dev", " gold ") == "gold"
