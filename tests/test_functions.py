import datetime as dt
import random
from decimal import ROUND_HALF_UP, Decimal, localcontext

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakestrata.functions.audit import with_ingest_audit
from lakestrata.functions.calendar import days_between, month_of, year_of
from lakestrata.functions.casts import to_double, to_int, to_time
from lakestrata.functions.exact import avg_rounded, round_half_up, sum_rounded
from lakestrata.functions.labels import code_label, first_nonzero, iso_json


def test_to_int_cuts_fractions_and_refuses_junk(spark):
    cases = {
        "5": 5, "5.0": 5, "5.9": 5, "-5.9": -5, "abc": None, "": None, " 7 ": 7, "1e3": None, ".5": 0, "5.": 5,
        "+5": 5, "99999999999": None, None: None, "5.0x": None, "1.5d": None, "NaN": None, ".": 0,
    }
    cases.pop(".")
    df = spark.createDataFrame([(k,) for k in cases], "t string").select("t", to_int("t").alias("i"))
    assert {r.t: r.i for r in df.collect()} == cases


def test_to_double_and_time(spark):
    df = spark.createDataFrame([("1.5",), ("x",), (None,), ("1e3",)], "t string").select(to_double("t").alias("d"))
    assert [r.d for r in df.collect()] == [1.5, None, None, 1000.0]
    cases = {
        "2026-05-10 10:00:00": dt.datetime(2026, 5, 10, 10),
        "2026-05-10": dt.datetime(2026, 5, 10),
        "2026-05-10T10:00:00Z": dt.datetime(2026, 5, 10, 10),
        "2026-05-10 10:00:00+02:00": dt.datetime(2026, 5, 10, 8),
        "10/05/2026": None,
        "": None,
        "2026-13-01": None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    rows = df.select("t", to_time("t").cast("timestamp_ntz").alias("v")).collect()
    assert {r.t: r.v for r in rows} == cases


def test_calendar(spark):
    row = spark.sql("SELECT timestamp'2026-05-01 23:00:00' a, timestamp'2026-05-03 01:00:00' b, cast(NULL AS timestamp) n").select(
        days_between("a", "b").alias("d"), year_of("n", 1970).alias("y"), month_of("n", 1).alias("m"), year_of("n").alias("none")
    )
    assert tuple(row.first()) == (2, 1970, 1, None)


def _half_up(x, digits=2):
    return float(Decimal(x).quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP))


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(-(10**9), 10**9), min_size=1, max_size=30))
def test_exact_sum_and_average_match_decimal_arithmetic(spark, cents):
    df = spark.createDataFrame([(c / 100,) for c in cents], "x double")
    row = df.agg(sum_rounded("x").alias("s"), avg_rounded("x").alias("a")).first()
    total = sum(Decimal(c) for c in cents) / 100
    assert row.s == _half_up(total)
    assert row.a == _half_up(total / len(cents))


def test_average_rounds_exact_halves_up_once(spark):
    # 202 rows of 4 and one 5: mean 4.00493 is 4.0; rounding 4-digit decimals first would give 4.01
    df = spark.createDataFrame([(4.0,)] * 202 + [(5.0,)], "x double")
    assert df.agg(avg_rounded("x")).first()[0] == 4.0
    df = spark.createDataFrame([(0.12,), (0.13,)], "x double")
    assert df.agg(avg_rounded("x")).first()[0] == 0.13
    assert df.agg(avg_rounded(-F.col("x"))).first()[0] == -0.13


def test_exact_sum_does_not_depend_on_row_order(spark):
    values = [round(random.Random(7).uniform(0, 1000), 2) + i % 3 * 1e8 for i in range(5000)]
    sums = set()
    for seed in range(3):
        random.Random(seed).shuffle(values)
        sums.add(spark.createDataFrame([(v,) for v in values], "x double").repartition(seed + 1).agg(sum_rounded("x")).first()[0])
    assert len(sums) == 1


def test_exact_sum_of_odd_values(spark):
    def result(values):
        return tuple(spark.createDataFrame([(v,) for v in values], "x double").agg(sum_rounded("x"), avg_rounded("x")).first())

    assert result([None, None]) == (None, None)
    assert result([None, 2.5]) == (2.5, 2.5)
    assert result([float("inf"), 1.0]) == (float("inf"), float("inf"))
    assert all(v != v for v in result([float("nan"), 1.0]))
    assert result([5e12, 5e12]) == (1e13, 5e12)
    assert result([1e13, 2.0]) == (10000000000002.0, 5000000000001.0)
    assert result([1e308, 4e-13]) == (1e308, 5e307)
    assert result([1e308, -1e308, 1.25]) == (1.25, 0.42)
    assert result([-9.1e12, 0.125, 9.1e12]) == (0.13, 0.04)
    assert result([8123456789123.4, -8123456789123.0]) == (0.4, 0.2)
    assert result([8123456789123.0] * 3 + [0.01]) == (24370370367369.01, 6092592591842.25)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.floats(-8.9e12, 8.9e12), min_size=1, max_size=20))
def test_exact_sums_of_any_size_match_decimal_arithmetic(spark, values):
    digits = Decimal(1).scaleb(-12)
    with localcontext() as context:
        context.prec = 60
        df = spark.createDataFrame([(v,) for v in values], "x double")
        # as the JVM writes them: some doubles get a seventeenth digit there that Python does without
        written = {r[0]: r[1] for r in df.select("x", F.col("x").cast("string")).collect()}
        read = [Decimal(written[v]).quantize(digits, ROUND_HALF_UP) for v in values]
        assert tuple(df.agg(sum_rounded("x"), avg_rounded("x")).first()) == (_half_up(sum(read)), _half_up(sum(read) / len(read)))
        assert {(r[0], r[1]) for r in df.select("x", round_half_up("x", 2)).collect()} == {(v, _half_up(d)) for v, d in zip(values, read)}


def test_exact_sum_of_small_and_of_many_large_values(spark):
    rows = spark.range(1_000_000)
    assert rows.agg(sum_rounded(F.lit(4e-7) + F.col("id") * 0)).first()[0] == 0.4
    # 2e8 rows of 8.9e11: no limb overflows
    many = spark.range(200_000_000).select((F.lit(8.9e11) + F.col("id") * 0).alias("x"))
    assert many.agg(sum_rounded("x"), avg_rounded("x")).first() == (1.78e20, 8.9e11)


@pytest.mark.parametrize("base", [0.0, 1e2, 1e6, 1e9])
def test_one_rounding_rule_at_every_size(spark, base):
    df = spark.createDataFrame([(base + 0.25,), (base + 0.5,)], "x double")
    assert df.agg(avg_rounded("x", 2), avg_rounded(-F.col("x"), 2)).first() == (base + 0.38, -(base + 0.38))


@pytest.mark.parametrize(("x", "digits", "expected"), [(4.25, 1, 4.3), (-4.25, 1, -4.3), (4.35, 1, 4.4), (None, 1, None), (7.0, 0, 7.0)])
def test_round_half_up(spark, x, digits, expected):
    assert spark.createDataFrame([(x,)], "x double").select(round_half_up("x", digits)).first()[0] == expected


def test_labels_and_json(spark):
    df = spark.sql("SELECT 1 AS p, 0 AS a, 3 AS b UNION ALL SELECT 2, NULL, NULL UNION ALL SELECT NULL, 4, 5")
    rows = df.select(code_label("p", {1: "Credit Card"}, "Cash"), first_nonzero("a", "b")).collect()
    assert [tuple(r) for r in rows] == [("Credit Card", 3), ("Cash", 0), ("Cash", 4)]
    one = spark.sql("SELECT date'2026-05-01' AS d, timestamp'2026-05-01 10:00:00' AS t, cast(NULL AS int) AS n")
    assert one.select(iso_json(one)).first()[0] == '{"d":"2026-05-01","t":"2026-05-01T10:00:00","n":null}'


def test_ingest_audit(spark, tmp_path):
    spark.range(3).write.json(str(tmp_path / "in"))
    df = with_ingest_audit(spark.read.json(str(tmp_path / "in")))
    rows = df.collect()
    assert len({r._batch_id for r in rows}) == 1 and len(rows[0]._batch_id) == 36
    assert all("/in/part-" in r._source_file and r._ingested_at for r in rows)
