import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from ledgerline.functions import exact_sum, hundredths, money
from ledgerline.plans import price_summary


def test_hundredths_restores_every_cent(spark):
    cents = list(range(-20_000, 20_000)) + [10**12 - k for k in range(1, 2_000)]
    frame = spark.createDataFrame([(c, c / 100) for c in cents], "cents bigint, amount double")
    assert frame.filter(hundredths("amount") != F.col("cents")).count() == 0


@pytest.fixture(params=["true", "false"])
def ansi(spark, request):
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield request.param
    spark.conf.set("spark.sql.ansi.enabled", "true")


def test_hundredths_is_exact_up_to_its_bound_and_keeps_null(spark, ansi):
    rng = random.Random(51)
    cents = [rng.randrange(2**k, 2 ** (k + 1)) for k in range(30, 51) for _ in range(2_000)] + [2**51 - 1, 0]
    rows = [(s * c, s * c / 100) for c in cents for s in (1, -1)] + [(None, None), (0, -0.0)]
    frame = spark.createDataFrame(rows, "cents bigint, amount double")
    assert frame.filter(~hundredths("amount").eqNullSafe(F.col("cents"))).count() == 0


@pytest.mark.parametrize("bad", [float("nan"), float("inf"), float("-inf"), 1e300, 35184452192298.38, 2**51 / 100, 0.125, -0.004, 12345678.901])
def test_hundredths_raises_on_what_is_no_amount(spark, ansi, bad):
    frame = spark.createDataFrame([(bad,)], "amount double")
    with pytest.raises(Exception, match="not an amount of whole hundredths"):
        frame.select(hundredths("amount")).collect()


@pytest.mark.parametrize("scale", [0, 10, -1])
def test_exact_sum_refuses_other_scales(spark, scale):
    with pytest.raises(ValueError, match="scale"):
        exact_sum(F.col("units"), scale)


@pytest.mark.parametrize("scale", [1, 9])
def test_exact_sum_at_the_ends_of_its_scale(spark, scale):
    units = [123456789012345678, -1, 5]
    frame = spark.createDataFrame([(u,) for u in units], "units bigint")
    assert frame.agg(exact_sum(F.col("units"), scale)).collect()[0][0] == float(Fraction(sum(units), 10**scale))


def test_ansi_mode_is_not_taken_for_granted_without_a_session(monkeypatch):
    monkeypatch.setattr(money.SparkSession, "getActiveSession", lambda: None)
    with pytest.raises(ValueError, match="session"):
        money.require_ansi()


def test_exact_sum_needs_ansi_mode(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(ValueError, match="ansi"):
            exact_sum(F.col("units"), 2)
        with pytest.raises(ValueError, match="ansi"):
            price_summary(spark, "/root/testdata/sf0.001")
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_exact_sum_against_brute_force(spark):
    rng = random.Random(7)
    rows = []
    for group in range(60):
        top = 10 ** rng.randint(1, 18)
        rows += [(group, rng.randint(-top, top)) for _ in range(rng.randint(1, 40))]
        rows += [(group, None)]
    rows += [(60, None), (61, 2**63 - 1), (62, -(2**63)), (63, -1), (64, 0)]
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, "g int, units bigint").repartition(7)

    want = {}
    for group, units in rows:
        total = want.setdefault(group, None)
        if units is not None:
            want[group] = (total or 0) + units
    for scale in (2, 4):
        got = dict(frame.groupBy("g").agg(exact_sum(F.col("units"), scale)).collect())
        exact = {
            g: None if t is None else float(Fraction(t, 10**scale)) for g, t in want.items()
        }
        assert got == exact


def test_exact_sum_passes_the_range_of_a_bigint(spark):
    rows = spark.range(0, 1000, 1, 10).select(F.lit(2**62).alias("units"))
    assert rows.agg(exact_sum(F.col("units"), 4)).collect()[0][0] == float(
        Fraction(1000 * 2**62, 10**4)
    )
