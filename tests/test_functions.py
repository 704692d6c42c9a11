"""Column helpers, one behaviour per test."""

import datetime as dt
import decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from opsward import functions as fn


def evaluate(spark, column, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


def test_pct_rounds_half_away_from_zero_and_guards_zero(spark):
    rows = [(7420, 14674), (1, 3), (1, 800), (-1, 800), (5, 0), (3, 8000)]
    got = evaluate(spark, fn.pct(F.col("n"), F.col("d")), rows, "n long, d long")
    assert got == [50.57, 33.33, 0.13, -0.13, None, 0.04]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(-10**9, 10**9), st.integers(1, 10**9)), min_size=50, max_size=200))
def test_pct_equals_decimal_arithmetic(spark, pairs):
    got = evaluate(spark, fn.pct(F.col("n"), F.col("d")), pairs, "n long, d long")
    cent = decimal.Decimal("0.01")
    with decimal.localcontext(prec=60):
        exact = [
            float((decimal.Decimal(n * 100) / d).quantize(cent, rounding=decimal.ROUND_HALF_UP)) for n, d in pairs
        ]
    assert sorted(got) == sorted(exact)


def test_average_of_decimals_is_rounded_once(spark):
    df = spark.createDataFrame([("1.01",), ("1.02",), ("1.00",), ("1.01",), (None,)], "v string")
    df = df.select(F.col("v").cast("decimal(18,2)").alias("v"))
    assert df.agg(fn.avg_2dp(F.col("v"))).first()[0] == 1.01
    halves = spark.createDataFrame([(1,), (2,)], "v int").agg(fn.avg_2dp(F.col("v"))).first()[0]
    assert halves == 1.5
    negative = spark.createDataFrame([(-1,), (0,), (0,)], "v int").agg(fn.avg_2dp(F.col("v"))).first()[0]
    assert negative == -0.33
    assert spark.createDataFrame([(None,)], "v int").agg(fn.avg_2dp(F.col("v"))).first()[0] is None


@pytest.mark.parametrize("text, expected", [
    ("follow-up gp/nurse o'neil", "Follow-Up Gp/Nurse O'Neil"),
    ("GENERAL surgery", "General Surgery"),
    ("city 1a", "City 1a"),
    ("a  b", "A  B"),
    ("é-øst", "É-Øst"),
    ("", ""),
    (None, None),
])
def test_initcap_words(spark, text, expected):
    assert evaluate(spark, fn.initcap_words(F.col("s")), [(text,)], "s string") == [expected]


def test_norm_label_keeps_exceptions(spark):
    rows = [(" ent ",), ("ENT",), (" orthopaedics ",), ("   ",)]
    got = evaluate(spark, fn.norm_label(F.col("s"), {"ent": "ENT"}), rows, "s string")
    assert got == ["ENT", "ENT", "Orthopaedics", None]


def test_matches_rejects_trailing_newline(spark):
    rows = [("F001",), ("F001\n",), ("xF001",), ("F0011",)]
    assert evaluate(spark, fn.matches(F.col("s"), "F[0-9]{3}"), rows, "s string") == [True, False, False, False]


def test_trimmed_strips_spaces_only(spark):
    rows = [("  a ",), ("\ta\t",), ("  ",), (None,)]
    assert evaluate(spark, fn.trimmed(F.col("s")), rows, "s string") == ["a", "\ta\t", None, None]


def test_parse_date_formats(spark):
    rows = [("2026-01-05",), (" 2026-1-5 ",), ("2001-13-45",), ("2026",), ("n/a",), ("5 Jan 2026",), ("20260105",), (None,)]
    day = dt.date(2026, 1, 5)
    assert evaluate(spark, fn.parse_date(F.col("s")), rows, "s string") == [day, day] + [None] * 6
    wide = evaluate(spark, fn.parse_date(F.col("s"), ("d MMM yyyy", "yyyyMMdd")), rows, "s string")
    assert wide == [day, day, None, None, None, day, day, None]


def test_parse_date_in_range(spark):
    rows = [("1899-12-31",), ("1900-01-01",), ("2026-08-01",), ("2026-08-02",)]
    column = fn.parse_date_in_range(F.col("s"), dt.date(1900, 1, 1), dt.date(2026, 8, 1))
    assert evaluate(spark, column, rows, "s string") == [None, dt.date(1900, 1, 1), dt.date(2026, 8, 1), None]


def test_numbers_from_text(spark):
    rows = [("1",), ("007",), ("12",), ("0",), ("-5",), (" 3 ",), ("x",), ("99999999999",), (None,)]
    assert evaluate(spark, fn.parse_positive_int(F.col("s")), rows, "s string") == [1, None, 12, None, None, 3, None, None, None]
    assert evaluate(spark, fn.parse_score(F.col("s")), rows, "s string") == [1, None, None, None, None, 3, None, None, None]


def test_elapsed_rounds_to_hundredths(spark):
    start = dt.datetime(2026, 1, 1)
    rows = [(start, start + dt.timedelta(seconds=s)) for s in (0, 18, 3600, 100, -100)]
    schema = "a timestamp_ntz, b timestamp_ntz"
    minutes = [float(v) for v in evaluate(spark, fn.elapsed_2dp("minute", F.col("a"), F.col("b")), rows, schema)]
    assert minutes == [0.0, 0.3, 60.0, 1.67, -1.67]
    hours = [float(v) for v in evaluate(spark, fn.elapsed_2dp("hour", F.col("a"), F.col("b")), rows, schema)]
    assert hours == [0.0, 0.01, 1.0, 0.03, -0.03]  # 18 s is exactly half a hundredth of an hour


def test_month_name_is_padded(spark):
    rows = [(dt.date(2026, 5, 3),), (dt.date(2026, 9, 3),)]
    assert evaluate(spark, fn.month_name(F.col("d")), rows, "d date") == ["May      ", "September"]
    assert evaluate(spark, fn.month_name(F.col("d"), padded=False), rows, "d date") == ["May", "September"]


def test_sentinels(spark):
    rows = [("N/A ",), (None,), ("  ",), ("na",), ("Maori",)]
    assert evaluate(spark, fn.is_sentinel(F.col("s"), {"", "n/a"}), rows, "s string") == [True, True, True, False, False]
    assert evaluate(spark, fn.null_sentinels(F.col("s"), {"", "n/a"}), rows, "s string") == [None, None, None, "na", "Maori"]


def test_null_if_before(spark):
    a, b = dt.date(2026, 1, 1), dt.date(2026, 1, 2)
    rows = [(b, a), (a, b), (a, a), (a, None), (None, a)]
    schema = "later date, base date"
    assert evaluate(spark, fn.null_if_before(F.col("later"), F.col("base")), rows, schema) == [b, None, a, None, None]
    kept = fn.null_if_before(F.col("later"), F.col("base"), keep_without_base=True)
    assert evaluate(spark, kept, rows, schema) == [b, None, a, a, None]


def test_map_values_and_flag(spark):
    rows = [(" YES ",), ("no",), ("maybe",), (None,)]
    assert evaluate(spark, fn.map_values(F.col("s"), {"yes": True, "no": False}), rows, "s string") == [True, False, None, None]
    assert evaluate(spark, fn.flag(F.col("s") == "no"), rows, "s string") == [False, True, False, False]
