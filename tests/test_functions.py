from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from touchline import schemas
from touchline.functions import coerce, display, eventtime


def value_of(spark, expression, value, kind="string"):
    df = spark.createDataFrame([(value,)], f"v {kind}")
    return df.select(expression(F.col("v")).alias("r")).first().r


@pytest.mark.parametrize(
    "text, week",
    [("3", 3), ("3.7", 3), (" 4 ", 4), ("x", 0), ("", 0), (None, 0), ("-2.9", -2),
     ("1e10", 0), ("5d", 0), ("5f", 0), ("inf", 0)],
)
def test_game_week(spark, text, week):
    assert value_of(spark, coerce.int_or_zero, text) == week


@pytest.mark.parametrize("token", schemas.NA_TOKENS)
def test_na_tokens(spark, token):
    assert value_of(spark, coerce.null_if_missing, token) is None


@pytest.mark.parametrize(
    "text, stripped",
    [("8.0", "8"), ("8", "8"), ("16943900.0", "16943900"), ("8.00", "8.00"), (".0", ""),
     ("1.0.0", "1.0"), (None, None)],
)
def test_decimal_suffix(spark, text, stripped):
    assert value_of(spark, coerce.strip_decimal_suffix, text) == stripped


def test_ids_print_without_exponent(spark):
    text = value_of(spark, lambda c: coerce.id_text(c, "double"), 16943900.0, "double")
    assert text == "16943900"


@pytest.mark.parametrize("value, kept", [(-3.0, 0.0), (50.5, 50.5), (101.0, 100.0), (None, None)])
def test_clamp(spark, value, kept):
    assert value_of(spark, coerce.clamp, value, "double") == kept


def test_event_time_keeps_micros_and_truncates(spark):
    exact = value_of(spark, eventtime.event_time, 1700000000.987654, "double")
    assert exact == dt.datetime(2023, 11, 14, 22, 13, 20, 987654)
    cut = value_of(spark, lambda c: eventtime.event_time(c, True), 1700000000.987, "double")
    assert cut == dt.datetime(2023, 11, 14, 22, 13, 20)


@pytest.mark.parametrize("value", [None, float("nan"), float("inf"), -float("inf"), 1e300])
def test_unusable_event_time(spark, value):
    assert value_of(spark, eventtime.event_time, value, "double") is None
    assert value_of(spark, eventtime.is_event_time, value, "double") is False


@pytest.mark.parametrize(
    "text, title",
    [("pass", "Pass"), ("free-kick", "Free-Kick"), ("OWN goal", "Own Goal"), ("a1b", "A1B"),
     (None, None)],
)
def test_title_case(spark, text, title):
    assert value_of(spark, display.title_case, text) == title


@pytest.mark.parametrize(
    "name, label",
    [("L. Messi", "Messi"), ("Schweinsteiger", "Schweinste"), ("A  B ", "B"), (None, "id"),
     ("", "")],
)
def test_short_label(spark, name, label):
    assert value_of(spark, lambda c: display.short_label(c, F.lit("id")), name) == label


def test_markers(spark):
    assert value_of(spark, display.marker, "shot") == "*"
    assert value_of(spark, display.marker, "corner") == "o"
    assert value_of(spark, display.marker, None) == "o"
    assert value_of(spark, display.marker_size, "shot") == 400
    assert value_of(spark, display.marker_size, "pass") == 120


def test_number_formats(spark):
    assert value_of(spark, display.percent_text, 33.333, "double") == "33.3%"
    assert value_of(spark, display.thousands_text, 1234567, "long") == "1,234,567"


def test_durations():
    assert eventtime.seconds_of("60 seconds") == 60
    assert eventtime.seconds_of("6 hours") == 21600
    assert eventtime.seconds_of("1 minute") == 60
