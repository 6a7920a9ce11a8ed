"""Scalar functions, each with the bad input it must survive."""

from __future__ import annotations

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from railloom.functions import clock, coerce, measures, text


def apply(spark, fn, inputs, kind="string"):
    data = [(i, v) for i, v in enumerate(inputs)]
    df = spark.createDataFrame(data, f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("x"))).collect()]


CASES = [
    ("C1", coerce.to_double, [" 12.5\t", "12d", "NaN", "1e3", "-.5", "5.", "", "abc", None, "inf", " 7"],
     [12.5, None, None, 1000.0, -0.5, 5.0, None, None, None, None, 7.0]),
    ("C2", coerce.to_int, ["12.0", "12", "12.5", "99999999999", "x", None], [12, 12, None, None, None, None]),
    ("C3", coerce.first_number, ["123.4 e", ": c", "-5.2", "46.75 b", "7.", None],
     [123.4, None, 5.2, 46.75, 7.0, None]),
    ("C5", coerce.strip, ["  a b　", None], ["a b", None]),
    ("C8", coerce.is_one, ["1", "1.0", " 1 ", "1.9", "2", "0", "yes", None],
     [True, True, True, True, False, False, False, False]),
    ("C9", coerce.is_truthy, ["Oui ", "VRAI", "t", "1", "yes", "0", "non", None],
     [True, True, True, True, True, False, False, False]),
    ("C10", coerce.is_letter_t, ["t", "T", "true", None], [True, False, False, False]),
    ("C6 first", text.first_of_list, ["FR, DE ,AT", "FR", "", None], ["FR", "FR", "", None]),
    ("C6 last", text.last_of_list, ["FR, DE , AT ", "FR", None], ["AT", "FR", None]),
    ("C7", clock.date_from_text,
     ["2023-08-01", "20230801", "2023-08-01T23:30:00-05:00", "2023-08-01 23:59:59", "08:30", "2023-13-01", "soon", None],
     [dt.date(2023, 8, 1), dt.date(2023, 8, 1), dt.date(2023, 8, 2), dt.date(2023, 8, 1), None, None, None, None]),
    ("C7 stamp", clock.timestamp_from_text, ["2023-08-01 10:00:00", "20230801", "x", None],
     [dt.datetime(2023, 8, 1, 10), dt.datetime(2023, 8, 1), None, None]),
    ("C11", clock.time_of_day, ["08:30", "08:30:15", "24:00", "8:30", "08:60", "x", None],
     ["08:30:00", "08:30:15", None, None, None, None, None]),
    ("C12", clock.loose_time_of_day, ["8:30", "08:30:15", "08:30:15.5", "25:10:00", None],
     ["08:30:00", "08:30:15", "08:30:15", None, None]),
    ("C12 strict", clock.hour_minute, ["08:30", "8:05", "08:30:00", "24:00", None],
     ["08:30:00", "08:05:00", None, None, None]),
    ("C14", clock.duration_minutes, ["08:30", "08:30:30", "25:10:00", "2 days 01:00:00", "1 day, 1:00:00", "30", "abc", None],
     [510.0, 510.5, 1510.0, 2940.0, 1500.0, None, None, None]),
    ("C25", lambda c: clock.interval_text(clock.duration_interval(c)),
     ["08:30", "25:10:00", "2 days 01:00:00", "abc", None],
     ["8:30:00", "1 day, 1:10:00", "2 days, 1:00:00", None, None]),
    ("C13", clock.duration_interval, ["25:10", "abc"], [dt.timedelta(hours=25, minutes=10), None]),
    ("C26", text.id_list, ["{1,2}", "{ 3 }", "{}", "1,2", "{a,4}"], [[1, 2], [3], [], [], [4]]),
]


@pytest.mark.parametrize("name,fn,inputs,expected", CASES, ids=[c[0] for c in CASES])
def test_scalar(spark, name, fn, inputs, expected):
    assert apply(spark, fn, inputs) == expected


def test_dates_do_not_depend_on_the_session_time_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        got = apply(spark, clock.date_from_text, ["2023-08-01", "2023-08-01 01:00:00", "2023-08-01T23:30:00-05:00"])
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got == [dt.date(2023, 8, 1), dt.date(2023, 8, 1), dt.date(2023, 8, 2)]


def test_id_list_of_null_is_empty_once_guarded(spark):
    assert apply(spark, lambda c: text.never_null_ids(text.id_list(c)), [None]) == [[]]


def test_nan_becomes_null(spark):
    assert apply(spark, coerce.nan_to_null, [1.5, float("nan"), None], "double") == [1.5, None, None]


def test_stable_id(spark):
    expected = "OP_" + hashlib.md5("Société é".encode()).hexdigest()[:8]
    assert apply(spark, lambda c: text.stable_id(c, "OP_"), ["Société é", None]) == [expected, None]


def test_natural_key_id_tells_null_from_empty_and_moves_no_text_between_parts(spark):
    df = spark.createDataFrame([("a", None), ("a", ""), ("a|", "b"), ("a", "|b")], "x string, y string")
    ids = [r[0] for r in df.select(text.natural_key_id(F.col("x"), F.col("y"))).collect()]
    assert len(set(ids)) == 4 and all(len(i) == 16 for i in ids)


def test_coordinates(spark):
    got = apply(spark, measures.coordinates, ["48.10, 2.30", "bad", "1,x", "1", None, "1, 2, 3"])
    assert [g and tuple(g) for g in got] == [(48.1, 2.3), None, None, None, None, (1.0, 2.0)]


def test_haversine(spark):
    df = spark.createDataFrame(
        [(48.8566, 2.3522, 45.764, 4.8357), (0.0, 0.0, 0.0, 180.0), (None, 0.0, 0.0, 0.0)],
        "a double, b double, c double, d double",
    )
    got = [r[0] for r in df.select(measures.haversine_km(*[F.col(c) for c in "abcd"])).collect()]
    assert got == [391.5, 20015.09, None]


@pytest.mark.parametrize(
    "carrier,distance,expected",
    [
        ("TGV INOUI", 280.0, 60.0), ("International", 100.0, 30.0), ("Intercités", 70.0, 30.0),
        ("TER", 45.0, 30.0), ("other", 75.0, 30.0), (None, 75.0, 30.0), ("TER", 0.0, None), ("TER", None, None),
    ],
)
def test_estimated_minutes(spark, carrier, distance, expected):
    df = spark.createDataFrame([(carrier, distance)], "c string, d double")
    assert df.select(measures.estimated_minutes(F.col("c"), F.col("d"))).head()[0] == expected


def test_rounding(spark):
    got = apply(spark, lambda c: measures.rounded_or_zero(c, 2), [2.675, 0.125, None, 208.0449999999], "double")
    assert got == [2.68, 0.13, 0.0, 208.05]


def test_large_totals_round_without_overflow(spark):
    assert apply(spark, lambda c: measures.rounded_or_zero(c, 2), [1e15 + 0.25], "double") == [1e15 + 0.25]


def test_pattern_of_a_term():
    assert text.contains_pattern("a%b_c") == "%a%b_c%"
    assert text.contains_pattern("a\\b") == "%ab%"
    assert text.contains_pattern("50\\%") == "%50\\%%"


def test_a_backslash_in_a_term_is_no_error(spark):
    df = spark.createDataFrame([("xaBy",), ("xa%y",)], "x string")
    assert df.where(F.col("x").ilike(text.contains_pattern("A\\b"))).count() == 1
    assert df.where(F.col("x").ilike(text.contains_pattern("a\\%"))).count() == 1
