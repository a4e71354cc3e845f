"""Claim JSON, validation, eligibility, adjudication, remittance text."""

import copy
import datetime
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from claimworks.fixtures import star
from claimworks.functions import variants as vj
from claimworks.operators import adjudicate as adj
from claimworks.operators import fhir, remit, validate
from claimworks.operators.eligibility import check_eligibility
from claimworks.plans import lake
from claimworks.sources import fhir_files

CLAIM = {
    "resourceType": "Claim", "id": "C1", "status": "active",
    "type": {"coding": [{"code": "professional"}]}, "use": "claim",
    "patient": {"reference": "Patient/M1"}, "created": "2026-01-01",
    "insurer": {"identifier": {"value": "PYR1"}},
    "provider": {"identifier": {"system": "npi", "value": "9000000007"}},
    "priority": {"coding": [{"code": "normal"}]},
    "diagnosis": [
        {"sequence": 1, "diagnosisCodeableConcept": {"coding": [{"code": "Z00.00"}]}},
        {"sequence": 2, "diagnosisCodeableConcept": {"coding": [{"code": "E11.9"}]}},
    ],
    "item": [{"sequence": 1, "servicedDate": "2026-01-02",
              "productOrService": {"coding": [{"code": "99213"}]}}],
    "total": {"value": 350.0, "currency": "USD"},
    "_prior_auth": "AUTH1", "_rendering_npi": "",
}


def claim(**changes):
    out = copy.deepcopy(CLAIM)
    for name, value in changes.items():
        if value is ...:
            del out[name]
        else:
            out[name] = value
    return out


def text_df(spark, *documents):
    rows = [(i, d if isinstance(d, str) else json.dumps(d)) for i, d in enumerate(documents)]
    return spark.createDataFrame(rows, "n int, fhir_json string")


def errors(spark, document):
    row = validate.validated(text_df(spark, document)).first()
    return row.errors if row.can_validate else None


@pytest.mark.parametrize(
    "document,expected",
    [
        (claim(), []),
        (claim(id=""), ["missing_required_field:id"]),
        (claim(id=...), ["missing_required_field:id"]),
        (claim(resourceType="Coverage"), ["wrong_resource_type"]),
        (claim(diagnosis=[]), ["missing_required_field:diagnosis", "empty_diagnosis_array"]),
        (claim(item=None), ["missing_required_field:item", "empty_item_array"]),
        (claim(total={"value": 0}), ["invalid_total_value"]),
        (claim(total={"value": -5}), ["invalid_total_value"]),
        (claim(total={"value": "350"}), ["invalid_total_value"]),
        (claim(total={"value": None}), ["invalid_total_value"]),
        (claim(total={}), ["missing_required_field:total", "invalid_total_value"]),
        (claim(patient=None), ["missing_required_field:patient"]),
        (claim(status=0), ["missing_required_field:status"]),
        (claim(status="0"), []),
        (claim(status=False), ["missing_required_field:status"]),
        (claim(status="false"), []),
        (claim(provider={"identifier": {"value": "9990000001"}}),
         ["invalid_billing_npi:9990000001"]),
        (claim(provider={"identifier": {"value": ""}}), []),
        (claim(total=None), None),
        (claim(provider={"identifier": None}), None),
        (claim(provider={"identifier": {"value": 9000000007}}), None),
        ("not json", None),
        ("[1]", None),
    ],
)
def test_validation(spark, document, expected):
    assert errors(spark, document) == expected


def test_missing_fields(spark):
    df = fhir.with_variant(text_df(spark, claim(), claim(use="", insurer={}, created=...)))
    got = [r[0] for r in df.orderBy("n").select(validate.missing_fields()).collect()]
    assert got == [[], ["use", "created", "insurer"]]


@pytest.mark.parametrize(
    "document,reason",
    [
        (claim(), None), ("{", "unparseable"), ("[]", "not_an_object"),
        ("{}", "blank_claim_id"), (claim(id=None), "blank_claim_id"),
        (claim(patient=None), "bad_patient"), (claim(patient="x"), "bad_patient"),
        (claim(patient={"reference": 5}), "bad_patient"),
        (claim(insurer=None), "bad_insurer"), (claim(insurer={"identifier": None}), "bad_insurer"),
        (claim(provider=None), "bad_provider"), (claim(total=None), "bad_total"),
        (claim(total={"value": None}), "bad_total"), (claim(total={"value": "abc"}), "bad_total"),
        (claim(total={"value": "350"}), None), (claim(total=...), None),
        (claim(diagnosis="Z00"), "bad_diagnosis"), (claim(diagnosis=[None]), "bad_diagnosis"),
        (claim(diagnosis=[{}]), None), (claim(item=[{"productOrService": None}]), "bad_item"),
        (claim(created=""), None), (claim(created="2026-13-01"), None),
    ],
)
def test_quarantine_reason(spark, document, reason):
    row = lake.parse_bronze(text_df(spark, document)).first()
    assert row.drop_reason == reason


def test_extraction(spark):
    fields = fhir.extract_columns()
    documents = [
        claim(), claim(total={"value": "350"}, created="2026-13-01", _prior_auth=""),
        claim(patient=..., diagnosis=[], item=[{}], insurer={"reference": "Org/1"}, total=...),
    ]
    df = fhir.with_variant(text_df(spark, *documents)).orderBy("n")
    a, b, c = df.select(*[x.alias(n) for n, x in fields.items()]).collect()
    assert (a.patient_id, a.primary_diagnosis_code, a.procedure_code) == ("M1", "Z00.00", "99213")
    assert a.service_date == datetime.date(2026, 1, 1) and a.payer_id == "PYR1"
    assert (b.billed_amount, b.service_date, b.prior_auth_number) == (350.0, None, "")
    assert (c.patient_id, c.primary_diagnosis_code, c.procedure_code) == (None, None, None)
    assert (c.payer_id, c.billed_amount) == ("Org/1", 0.0)


def test_silver_keeps_the_latest_readable_row(spark):
    rows = [
        ("C1", json.dumps(claim(total={"value": 100.0})), "2026-01-01", "2026-01-01"),
        ("C1", json.dumps(claim(total={"value": 900.0})), "2026-01-01", "2026-01-03"),
        ("C1", json.dumps(claim(patient=None)), "2026-01-01", "2026-01-09"),
        ("C2", json.dumps(claim(id="C2", item=[])), "2026-01-01", "2026-01-01"),
    ]
    bronze = spark.createDataFrame(
        rows, "claim_id string, fhir_json string, i string, r string"
    ).selectExpr("claim_id", "fhir_json", "timestamp(i) ingest_ts", "timestamp(r) received_ts")
    silver = {r.claim_id: r for r in lake.to_silver(bronze).collect()}
    assert silver["C1"].billed_amount == 900.0 and silver["C1"].denial_risk_score == 50
    assert not silver["C1"].human_review_required
    assert json.loads(silver["C1"].decision_basis)["billed_amount"] == 100.0
    assert silver["C2"].denial_risk_score == 99 and silver["C2"].human_review_required
    assert silver["C2"].provider_explanation == (
        "Claim C2 failed validation: missing_required_field:item."
    )
    assert lake.quarantine(bronze).count() == 1


def test_fhir_round_trip(spark):
    parsed = spark.createDataFrame(
        [("C9", "9000000007", "R", "M1", "20260412", ["A", "B"], ["99213", "93000"], 350.0, None)],
        "transaction_id string, billing_npi string, rendering_npi string, "
        "patient_member_id string, date_of_service string, diagnosis_codes array<string>, "
        "procedure_codes array<string>, billed_amount double, prior_auth_number string",
    )
    got = json.loads(fhir.map_to_fhir(parsed, "PYR").first().fhir_json)
    assert got["created"] == "2026-04-12" and got["_prior_auth"] is None
    assert [d["sequence"] for d in got["diagnosis"]] == [1, 2]
    assert got["item"][1]["productOrService"]["coding"][0]["code"] == "93000"
    assert got["item"][1]["net"] == {"value": 350.0, "currency": "USD"}
    assert got["_denial_risk_score"] is None and got["_rendering_npi"] == "R"


def test_bundles(spark, tmp_path):
    bundle = {"resourceType": "Bundle", "entry": [
        {"resource": claim()}, {"resource": {"resourceType": "Patient", "id": "P"}}, {},
        {"resource": claim(id="C2")},
    ]}
    for name, doc in {"a": bundle, "b": claim(id="C3")}.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(doc, indent=1))
    ids = {r.claim_id for r in fhir_files.read_fhir(spark, str(tmp_path)).collect()}
    assert ids == {"C1", "C2", "C3"}
    (tmp_path / "c.json").write_text('{"resourceType": "Patient"}')
    with pytest.raises(Exception, match="no Claim resources"):
        fhir_files.read_fhir(spark, str(tmp_path)).collect()


ENROLLMENT = [
    ("M1", datetime.date(2026, 1, 1), datetime.date(2026, 6, 30), "PPO", "PYR", "G1"),
]
ENROLLMENT_DDL = (
    "member_id string, coverage_start date, coverage_end date, plan_type string, "
    "payer_id string, group_number string"
)


@pytest.mark.parametrize(
    "member,day,reason",
    [
        ("M1", "2026-01-01", "active_coverage"), ("M1", "2026-06-30", "active_coverage"),
        ("M1", "2026-07-01", "coverage_not_active_on_dos"), ("M9", "2026-02-01", "member_not_found"),
    ],
)
def test_eligibility(spark, member, day, reason):
    claims = spark.createDataFrame([(member, day)], "member_id string, d string").selectExpr(
        "member_id", "date(d) dos"
    )
    row = check_eligibility(claims, spark.createDataFrame(ENROLLMENT, ENROLLMENT_DDL)).first()
    assert row.eligibility_reason == reason and row.eligible == (reason == "active_coverage")
    assert row.plan_type == ("" if member == "M9" else "PPO")


@pytest.mark.parametrize(
    "codes,billed,auth,as_of,reason,paid,cas",
    [
        (["99213"], 350, None, "2026-02-01", "", 280, "CO-45"),
        (["99213"], 100, None, "2026-02-01", "", 100, "CO-45"),
        (["99213"], 1000, None, "2026-02-01", "", 280, "CO-45"),
        (["99213"], 1500, None, "2026-02-01", "prior_auth_required", 0, "CO-197"),
        (["99213"], 1500, "A", "2026-02-01", "", 280, "CO-45"),
        (["93458"], 500, "", "2026-02-01", "prior_auth_required", 0, "CO-197"),
        (["15820", "99213"], 350, "A", "2026-02-01", "service_not_covered", 0, "CO-49"),
        (["0191T", "15820"], 350, "A", "2026-02-01", "service_not_covered", 0, "CO-49"),
        (["0191T"], 350, "A", "2026-02-01", "experimental_procedure", 0, "CO-50"),
        (["99213"], 350, None, "2026-08-01", "timely_filing_exceeded", 0, "CO-29"),
        (["XXXXX", "99211"], 350, None, "2026-02-01", "", 190, "CO-45"),
        ([], 350, None, "2026-02-01", "", 0, "CO-45"),
    ],
)
def test_adjudication(spark, codes, billed, auth, as_of, reason, paid, cas):
    claims = spark.createDataFrame(
        [("C1", "M1", float(billed), auth, codes)],
        "claim_id string, member_id string, billed_amount double, prior_auth string, "
        "cpts array<string>",
    ).withColumn("dos", F.lit("2026-01-02").cast("date"))
    enrolled = spark.createDataFrame(ENROLLMENT, ENROLLMENT_DDL)
    row = adj.adjudicate(claims, enrolled, as_of=F.lit(as_of).cast("date")).first()
    assert (row.denial_reason, float(row.paid_amount), row.cas_code) == (reason, paid, cas)
    assert row.status == ("paid" if reason == "" else "denied")
    assert float(row.cas_amount) == billed - paid


def test_835_counts_its_segments(spark):
    rows = spark.createDataFrame(
        [("C1", "M1", "paid", "CO-45", "350.00", "280.00", "70.00"),
         ("C2", "M1", "paid", "CO-45", "100.00", "100.00", "0.00")],
        "claim_id string, member_id string, status string, cas_code string, b string, p string, "
        "c string",
    ).selectExpr(
        "*", "cast(b as decimal(12,2)) billed_amount", "cast(p as decimal(12,2)) paid_amount",
        "cast(c as decimal(12,2)) cas_amount",
        "array(named_struct('cpt', '99213', 'allowed', cast(280 as decimal(12,2)))) procedures",
    )
    stamp = F.to_timestamp(F.lit("2026-04-12 09:00:00"))
    texts = {r.claim_id: r.edi for r in rows.select(
        "claim_id", remit.text_835(stamp, remit.Parties("PYR", "SUB")).alias("edi")).collect()}
    for text in texts.values():
        segments = text.replace("~", "").split("\n")
        tags = [s.split("*")[0] for s in segments]
        assert len(segments[0].split("*")) == 17
        counted = tags.index("SE") - tags.index("ST") + 1
        assert segments[tags.index("SE")].split("*")[1] == str(counted)
    assert "CAS*CO*45*70.00~" in texts["C1"] and "CAS" not in texts["C2"]


def test_processing_outcomes(spark):
    documents = [
        claim(), claim(id="C2", item=[]), claim(id="C3", patient={"reference": "Patient/M9"}),
        claim(id="C4", total=None), "junk", claim(id="C5", total={"value": 5000}, _prior_auth=""),
    ]
    enrolled = spark.createDataFrame(ENROLLMENT, ENROLLMENT_DDL)
    out = validate.process_messages(
        text_df(spark, *documents), enrolled, F.lit("2026-02-01").cast("date"), json="fhir_json",
        keep=["n"],
    )
    rows = out.orderBy("n").collect()
    assert [r.outcome for r in rows] == [
        "paid", "rejected_validation", "rejected_eligibility", "failed", "failed", "denied",
    ]
    assert json.loads(rows[1].value)["errors"] == [
        "missing_required_field:item", "empty_item_array",
    ]
    assert json.loads(rows[2].value) == {
        "claim_id": "C3", "reason": "eligibility_failed",
        "eligibility_reason": "member_not_found", "member_id": "M9",
    }
    assert json.loads(rows[5].value)["cas_code"] == "CO-197"
    assert tuple(validate.run_statistics(out).first()) == (2, 1, 1, 2, 2)


def test_large_keys_stay_whole_and_identifiers_valid(spark):
    """Order keys above 10^9 and supplier numbers above 10^6: ids stay unique, check digits right."""
    from claimworks.fixtures import star
    from claimworks.functions.scalars import npi_is_valid

    keys = spark.createDataFrame(
        [(100_000_001, 4), (1_000_000_010, 10_001), (1_000_000_019, 1_234_568), (10_000_000_019, 99_999_999),
         (5, 123_456_789), (6, 1_000_007)],
        "k long, s long",
    ).select(star._padded("CLM-", F.col("k")).alias("id"), "s", star.npi_of_supplier(F.col("s")).alias("npi"))
    rows = keys.withColumn("ok", npi_is_valid(F.col("npi"))).collect()
    assert len({r.id for r in rows}) == 6 and "CLM-10000000019" in {r.id for r in rows}
    assert all(len(r.npi) == 10 and r.ok == (r.s % 10 != 7) for r in rows)


def test_a_schedule_that_is_a_table_prices_like_a_constant_one(spark, tmp_path):
    import json

    from claimworks.operators import adjudicate as adj

    fees = {"99213": 280.0, "27447": 8000.0, "x": 1.5}
    file = tmp_path / "fees.json"
    file.write_text(json.dumps({"_comment": "no code", "DEFAULT": 150, **fees}))
    claims = spark.createDataFrame(
        [("a", ["99213", "", "27447"]), ("a", ["zzz"]), (None, ["x", None, "x"]), ("b", []), ("c", None), ("a", ["zzz"])],
        "claim_id string, cpts array<string>",
    )

    def shown(schedule):
        return sorted(
            (r.claim_id or "", r.cpts or [], [(p.cpt, float(p.allowed)) for p in r.procedures or []])
            for r in adj.priced(claims, schedule).select("claim_id", F.expr("filter(cpts, c -> c is not null)").alias("cpts"), "procedures").collect()
        )

    assert shown(adj.read_fee_schedule(spark, str(file))) == shown(fees)


SPANS = [  # member, start, end, plan
    ("M1", "2024-01-01", "2024-03-31", "A"), ("M1", "2024-06-01", "2024-12-31", "B"),
    ("M1", "2024-10-01", "2024-10-31", "C"), ("M1", "2024-06-01", "2024-07-31", "Z"),
    ("M2", "2024-01-01", None, "D"), ("M2", "2024-01-01", None, "D"), (None, "2024-01-01", "2024-12-31", "N"),
    ("M3", None, "2024-12-31", "E"),
]


@pytest.mark.parametrize(
    "member,day,reason,plan",
    [
        ("M1", "2023-12-31", "coverage_not_active_on_dos", ""),
        ("M1", "2024-01-01", "active_coverage", "A"),
        ("M1", "2024-04-15", "coverage_not_active_on_dos", "A"),  # gap
        ("M1", "2024-08-15", "active_coverage", "B"),  # of two starts on one day the longer counts
        ("M1", "2024-10-31", "active_coverage", "C"),
        ("M1", "2024-11-15", "coverage_not_active_on_dos", "C"),  # the later enrolment ended first
        ("M1", None, "coverage_not_active_on_dos", ""),
        ("M2", "2099-01-01", "active_coverage", "D"),  # open end, given twice
        ("M3", "2024-05-01", "member_not_found", ""),
        (None, "2024-05-01", "member_not_found", ""),
    ],
)
def test_coverage_spans(spark, member, day, reason, plan):
    from claimworks.operators.eligibility import check_spans

    spans = spark.createDataFrame(
        [(*s, "P", "G") for s in SPANS],
        "member_id string, s string, e string, plan_type string, payer_id string, group_number string",
    ).selectExpr("member_id", "date(s) coverage_start", "date(e) coverage_end", "plan_type", "payer_id", "group_number")
    claims = spark.createDataFrame([("c", member, day)] * 3, "claim_id string, member_id string, d string").selectExpr(
        "claim_id", "member_id", "date(d) dos")
    rows = check_spans(claims, spans).collect()
    assert len(rows) == 3 and {(r.eligibility_reason, r.plan_type) for r in rows} == {(reason, plan)}
    assert check_spans(claims, spans.limit(0)).where("eligibility_reason = 'member_not_found'").count() == 3


def test_interchanges_number_claims_without_gaps(spark, tmp_path):
    ddl = ("claim_id string, member_id string, status string, billed_amount decimal(12,2), paid_amount decimal(12,2), "
           "cas_amount decimal(12,2), cas_code string, procedures array<struct<cpt:string,allowed:decimal(12,2)>>")
    rows = [(f"C{i:03d}", "M", "paid", 10, 10, 0, "CO-45", [("99213", 10)]) for i in range(25)]
    claims = spark.createDataFrame([(a, b, c, *map(Decimal, (d, e, f)), g, [(h[0][0], Decimal(h[0][1]))])
                                    for a, b, c, d, e, f, g, h in rows], ddl).repartition(6)
    got = remit.interchanges(claims, per_file=10, first=999_999_999).collect()
    assert {(r.control, r.transactions) for r in got} == {("999999999", 10), ("000000000", 10), ("000000001", 5)}
    for r in got:
        segments = [s.rstrip("~").split("*") for s in r.edi.split("\n")]
        assert segments[0][13] == r.control and segments[-2][1] == str(r.transactions)
        numbers = [s[2] for s in segments if s[0] == "ST"]
        assert numbers == [f"{i + 1:04d}" for i in range(r.transactions)] == [s[2] for s in segments if s[0] == "SE"]
        starts = [i for i, s in enumerate(segments) if s[0] == "ST"]
        ends = [i for i, s in enumerate(segments) if s[0] == "SE"]
        assert all(int(segments[e][1]) == e - s + 1 for s, e in zip(starts, ends))
        traces = [s[2] for s in segments if s[0] == "TRN"]
        assert traces == [r.control + n for n in numbers]
    order = sorted(got, key=lambda r: (r.control != "999999999", r.control))
    claimed = [s.split("*")[1] for r in order for s in r.edi.split("\n") if s.startswith("CLP")]
    assert claimed == [f"C{i:03d}" for i in range(25)]
    assert remit.interchanges(claims.limit(0)).count() == 0


def test_a_search_does_not_read_the_rest_of_the_line_from_every_start():
    from claimworks.plans import quality

    assert quality.searched(".*resourceType.*Claim.*") == "resourceType.*Claim"
    for kept in (r"a\.*", ".*?a", "[.*", "(?s)a.*", r"\Qa.*", "^a$"):
        assert quality.searched(kept) == kept


def test_validation_and_shares_are_compiled(spark):
    """No rule stands inside a function over an array, which Spark interprets row by row."""
    from claimworks.operators import validate
    from claimworks.risk import explain

    def shape(*columns):
        return "\n".join(str(c) for c in columns)

    assert "filter" not in shape(validate.error_list(), validate.first_error())
    rows = spark.createDataFrame([([1.0, -1.0, 1.0, 0.0, 0.0, 0.0],), (None,)], "contributions array<double>")
    plan = explain.percentages(rows)._jdf.queryExecution().optimizedPlan().toString()
    assert "lambdafunction" not in plan
    assert [r.percent for r in explain.percentages(rows).collect()] == [[33.4, 33.3, 33.3, 0.0, 0.0, 0.0], None]


def test_damage_does_not_compile_a_pattern_per_row(spark):
    from claimworks.fixtures import star

    plan = star.spoiled(star.claims(spark, "/root/testdata/sf0.001"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace") == len(star.DAMAGE)


def test_checked_claims_are_both_sides_of_the_split(spark):
    from claimworks.fixtures import star
    from claimworks.operators import validate

    rows = star.spoiled(star.claims(spark, "/root/testdata/sf0.001")).select("claim_id", "fhir_json").persist()
    valid, rejected = validate.split_valid(rows)
    want = valid.selectExpr("claim_id", "'valid' AS reason", "CAST(array() AS array<string>) AS errors").unionByName(rejected)
    got = validate.checked_claims(rows)
    assert want.count() > 0 and rejected.count() > 0 and valid.count() > 0
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan
    rows.unpersist()


ODD_CLAIMS = [
    claim(), claim(_prior_auth=""), claim(_prior_auth="0"), claim(_prior_auth=0), claim(_prior_auth=[1]),
    claim(_prior_auth={}), claim(_prior_auth="false"), claim(patient={"reference": 5}), claim(patient={"reference": ""}),
    claim(patient={"reference": None}), claim(patient=[{"reference": "x"}]), claim(provider={"identifier": {"value": None}}),
    claim(provider={"identifier": {"value": 1234567893}}), claim(provider={"identifier": {"value": [1]}}),
    claim(insurer={"identifier": {"value": ""}, "reference": "Org/1"}), claim(insurer={"identifier": "x"}),
    claim(total={"value": True}), claim(total={"value": "350"}), claim(total={"value": {}}), claim(total=[]),
    claim(diagnosis={}), claim(diagnosis={"a": 1}), claim(diagnosis="x"), claim(diagnosis=[None, 1]), claim(item=None),
    claim(item=[{"productOrService": {"coding": {}}}]), claim(id=7), claim(id=None), claim(id=...), claim(status="-0.0"),
    claim(resourceType=["Claim"]), claim(created=20260101), "[]", "5", "null", "not json", '{"id":1,"id":2}',
]


def test_parts_of_a_claim_settle_what_look_ups_do(spark):
    """Every test gives the same from the parts read at once as from the variant by path."""
    v, paths = fhir.CLAIM, [p for p in fhir.CLAIM.known if not p.endswith("]")]
    df = fhir.with_variant(text_df(spark, *ODD_CLAIMS))
    tests = {}
    for path in paths:
        for how, name in (("parts", v), ("path", "v")):
            tests[f"{path}|{how}"] = F.struct(
                vj.text(name, path), vj.text(name, path, "?"), vj.truthy(name, path), vj.kind(name, path),
                vj.present(name, path), vj.length(name, path), vj.get(name, path, "double"),
                vj.is_object_or_absent(name, path, "reference"), vj.kind_not_in(name, path, ["STRING", "ARRAY"]),
            )
    for row in df.select("n", *[c.alias(f"c{i}") for i, c in enumerate(tests.values())]).collect():
        for i, name in enumerate(tests):
            if i % 2 == 0:
                assert row[f"c{i}"] == row[f"c{i + 1}"], (name, ODD_CLAIMS[row.n])


def test_leaves_of_a_claim_are_found_without_a_look_up(spark):
    for path in ("status", "patient.reference", "total.value", "provider.identifier.value"):
        assert "'$." not in str(vj.get(fhir.CLAIM, path, "string"))


def test_bronze_reads_its_tables_once(spark):
    plan = star.bronze(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 2  # orders and lineitem


def test_a_claim_is_cast_without_its_list_of_codes(spark):
    assert "diagnosisCodeableConcept" not in fhir.CLAIM.type
    code = "diagnosis[0].diagnosisCodeableConcept.coding[0].code"
    row = fhir.with_variant(text_df(spark, claim())).select(vj.text(fhir.CLAIM, code).alias("c")).first()
    assert row.c == "Z00.00" and "'$." not in str(vj.text(fhir.CLAIM, code))
