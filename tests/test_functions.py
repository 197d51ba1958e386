import datetime as dt

import pytest
from pyspark.sql import functions as F

from salesloom.functions import labels, numbers, periods, text
from salesloom.functions.ids import row_id
from salesloom.functions.rules import alert_rows, first_match, joined_reasons


@pytest.mark.parametrize(
    "raw, clean",
    [
        ("8 (999) 123-45-67", "+79991234567"),
        ("+7 999 123 45 67", "+79991234567"),
        ("9991234567", "+79991234567"),
        ("89991234567", "+79991234567"),
        ("69991234567", ""),
        ("123", ""),
        ("799912345678", ""),
        ("", ""),
        (None, ""),
    ],
)
def test_phone(one, raw, clean):
    assert one(raw, text.normalize_phone("x")) == clean


@pytest.mark.parametrize(
    "raw, clean",
    [
        (" Ivan.P @Example.COM", "ivan.p@example.com"),
        ("иван@example.com", ""),
        ("a@b", ""),
        ("a@b.c", ""),
        ("a+b@c-d.io", "a+b@c-d.io"),
        (None, ""),
    ],
)
def test_email(one, raw, clean):
    assert one(raw, text.normalize_email("x")) == clean


@pytest.mark.parametrize(
    "raw, clean",
    [
        ("  пётр   ИВАНОВ-петров ", "Петр Иванов-Петров"),
        ("o'neil mc2cloud", "O'Neil Mc2Cloud"),
        (" анна\tк.", "Анна К."),
        (None, ""),
    ],
)
def test_name(one, raw, clean):
    assert one(raw, text.normalize_name("x")) == clean


def test_city_keeps_yo(one):
    assert one("санкт-петербург  орёл", text.normalize_city("x")) == "Санкт-Петербург Орёл"


def test_word_set(one):
    words = one("Как оплатить ЗАКАЗ, ещё заказ №7?", text.word_set("x"))
    assert sorted(words) == ["7", "еще", "заказ", "оплатить"]
    assert one(None, text.word_set("x")) == []


def test_filled_count(spark):
    df = spark.createDataFrame([("a", None, " "), ("", "b", None)], "x string, y string, z string")
    strict = [r[0] for r in df.select(text.filled_count(["x", "y", "z"])).collect()]
    lenient = [r[0] for r in df.select(text.filled_count(["x", "y", "z"], ("y", "z"))).collect()]
    assert strict == [1, 1]
    assert lenient == [2, 2]


def test_or_label(one):
    assert one("  ", text.or_label("x", "none")) == "none"
    assert one(None, text.or_label("x", "none")) == "none"
    assert one(" a ", text.or_label("x", "none")) == "a"


@pytest.mark.parametrize("den, on_zero, expected", [(0, None, None), (0, 0, 0.0), (4, None, 2.5), (None, 0, 0.0)])
def test_ratio(one, den, on_zero, expected):
    assert one(den, numbers.ratio(F.lit(10), "x", on_zero=on_zero), "int") == expected


@pytest.mark.parametrize(
    "value, digits, expected", [(0.125, 2, 0.12), (0.375, 2, 0.38), (2.675, 2, 2.68), (-2.5, 0, -2.0), (64840.00000000001, 2, 64840.0)]
)
def test_rounding_is_half_to_even_on_the_scaled_double(one, value, digits, expected):
    assert one(value, numbers.rounded("x", digits), "double") == expected


@pytest.mark.parametrize("cur, prev, expected", [(0, 0, 0.0), (5, 0, 100.0), (5, 4, 25.0), (0, 4, -100.0)])
def test_delta(one, cur, prev, expected):
    assert one(cur, numbers.delta_pct("x", F.lit(prev)), "int") == expected


@pytest.mark.parametrize(
    "delta, higher, good", [(0.0, True, True), (0.0, False, True), (1.0, True, True), (1.0, False, False), (-1.0, False, True)]
)
def test_is_good(one, delta, higher, good):
    assert one(delta, numbers.is_good("x", F.lit(higher)), "double") is good


def test_money_sum_is_exact(spark):
    df = spark.createDataFrame([(0.1,)] * 1000 + [(None,)], "x double")
    assert df.agg(numbers.money_sum("x").alias("s")).first()["s"] == 100.0
    assert df.filter("x > 5").agg(numbers.money_sum("x").alias("s")).first()["s"] == 0.0


def test_calendar(one):
    when = dt.datetime(2027, 1, 1, 23, 0)
    assert one(when, periods.iso_week_label("x"), "timestamp_ntz") == "2026-W53"
    assert one(when, periods.month_label("x"), "timestamp_ntz") == "2027-01"
    assert one(when, periods.weekday_name("x"), "timestamp_ntz") == "Friday"
    next_day = F.lit("2027-01-02 01:00:00").cast("timestamp_ntz")
    assert one(when, periods.midnights_between("x", next_day), "timestamp_ntz") == 1
    assert one(when, periods.day_end("2027-01-01"), "timestamp_ntz") == dt.datetime(2027, 1, 1, 23, 59, 59)


@pytest.mark.parametrize(
    "grain, first", [("year", "2026-01-01"), ("quarter", "2026-04-01"), ("month", "2026-06-01"), ("week", "2026-06-22"), ("day", "2026-06-25")]
)
def test_period_start(one, grain, first):
    assert one(dt.date(2026, 6, 25), periods.period_start("x", grain), "date") == dt.date.fromisoformat(first)


def test_unknown_grain_raises():
    with pytest.raises(ValueError):
        periods.period_start("x", "hour")


def test_labels(one):
    assert one(1234567.5, labels.money_label("x"), "double") == "1 234 568 ₽"
    assert one(4.333, labels.times_label("x"), "double") == "4.33x"
    assert one(None, labels.timestamp_label("x"), "timestamp_ntz") == "—"
    assert one(dt.datetime(2026, 6, 25, 9, 5), labels.timestamp_label("x"), "timestamp_ntz") == "25.06.2026 09:05"


@pytest.mark.parametrize("cur, prev, label", [(0.0, 0.0, "0%"), (3.0, 0.0, "+100%"), (3.0, 2.0, "+50.0%"), (1.0, 2.0, "-50.0%"), (2500.0, 1.0, "+249900.0%")])
def test_delta_label(one, cur, prev, label):
    assert one(cur, labels.delta_label("x", F.lit(prev), numbers.delta_pct("x", F.lit(prev))), "double") == label


def test_row_id_is_stable(one):
    expression = row_id("L", F.lit("2024-01-31").cast("date"), "x")
    assert one(7, expression, "int") == one(7, expression, "int") == "L-20240131-902BA3CDA1883801"


def test_rules(spark):
    df = spark.createDataFrame([(1, True, False), (7, True, True)], "n int, a boolean, b boolean")
    label = first_match([(F.col("n") < 5, "low"), (F.col("n") < 9, "mid")], otherwise="high")
    assert [r[0] for r in df.select(label).collect()] == ["low", "mid"]
    assert [r[0] for r in df.select(joined_reasons({"a": "A", "b": "B"})).collect()] == ["A", "A; B"]


def test_alert_rows_have_a_default(spark):
    row = spark.createDataFrame([(1,)], "n int")
    rules = [("big", F.col("n") > 5, F.lit("too big")), ("odd", F.col("n") % 2 == 1, F.lit("odd"))]
    assert [r["code"] for r in alert_rows(row, rules, "fine").collect()] == ["odd"]
    assert [(r["code"], r["message"]) for r in alert_rows(row, rules[:1], "fine").collect()] == [("none", "fine")]
