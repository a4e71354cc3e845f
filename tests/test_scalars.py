import datetime

import pytest
from pyspark.sql import functions as F

from claimworks.functions import scalars


def values(spark, rows, ddl, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, ddl).select(*columns).collect()]


def test_npi_check_digit(spark):
    cases = {
        "1234567893": True, "9000000007": True, "9990000001": False, "0000000000": False,
        "123456789": False, "12345678ab": False, "": False, None: False, "1234567893\n": False,
    }
    out = values(spark, [(k,) for k in cases], "n string", "n", scalars.npi_is_valid(F.col("n")))
    assert dict(out) == cases


@pytest.mark.parametrize(
    "p,topic",
    [
        (0.399, "claims.validated"), (0.40, "claims.review_queue"),
        (0.699, "claims.review_queue"), (0.70, "claims.rejected"), (0.0, "claims.validated"),
        (1.0, "claims.rejected"),
    ],
)
def test_routing_edges(spark, p, topic):
    assert values(spark, [(p,)], "p double", scalars.route_topic(F.col("p"))) == [(topic,)]


def test_tiers(spark):
    out = values(
        spark, [(5000.0,), (4999.99,), (1000.0,), (999.0,), (None,)], "x double",
        scalars.billed_tier(F.col("x")),
    )
    assert [r[0] for r in out] == ["HIGH", "MEDIUM", "MEDIUM", "LOW", "LOW"]
    out = values(spark, [(70,), (69,), (40,), (39,)], "x int", scalars.score_tier(F.col("x")))
    assert [r[0] for r in out] == ["HIGH", "MEDIUM", "MEDIUM", "LOW"]


def test_safe_divide(spark):
    out = values(
        spark, [(1.0, 2.0), (1.0, 0.0), (1.0, None)], "a double, b double",
        scalars.safe_divide(F.col("a"), F.col("b")),
    )
    assert out == [(0.5,), (None,), (None,)]


def test_dates(spark):
    day = datetime.date(2020, 5, 5)
    out = values(
        spark, [("20260412",), ("",), ("20261340",), ("20260412xyz",)], "t string",
        scalars.edi_date(F.col("t"), F.lit(day)),
    )
    good = datetime.date(2026, 4, 12)
    assert [r[0] for r in out] == [good, day, day, good]
    out = values(
        spark, [("20260412",), ("2026-04-12",), ("",)], "t string", scalars.iso_date_text(F.col("t"))
    )
    assert [r[0] for r in out] == ["2026-04-12", "2026-04-12", ""]


def test_plan_type(spark):
    out = values(
        spark, [("abc-ppo-1",), ("HMOPPO",), ("GOLD",), ("",), (None,)], "c string",
        scalars.plan_type(F.col("c")),
    )
    assert [r[0] for r in out] == ["PPO", "PPO", "GOLD", "UNKNOWN", "UNKNOWN"]
