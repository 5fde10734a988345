"""Column helpers on the edge cases the marts single out."""

from decimal import Decimal

import pytest
from pyspark.errors import ArithmeticException, PySparkException
from pyspark.sql import functions as F

from vitrina.functions.dates import iso_week, week_end, week_start
from vitrina.functions.ratios import guarded_percent, guarded_ratio
from vitrina.functions.text import (decimal_from_text, first_token, int_from_text, leading_word,
                                    second_token, strip_word)

NBSP = "\u00a0"


def test_person_tokens(spark):
    df = spark.createDataFrame([("Анна Иванова",), ("Анна",), ("  Анна Иванова",),
                                ("Анна-Мария Иванова",), (None,)], "author string")
    got = df.select("author", leading_word("author").alias("f"),
                    second_token("author").alias("l")).collect()
    assert [(r.f, r.l) for r in got] == [
        ("Анна", "Иванова"),       # Cyrillic word characters
        ("Анна", None),            # no second token -> NULL, not ''
        (None, None),              # leading blank: neither pattern matches
        ("Анна", "Иванова"),       # '-' ends the word but not the token
        (None, None),
    ]


def test_roster_tokens(spark):
    r = spark.createDataFrame([("Иванова Анна Петровна",)], "b string").select(
        first_token("b").alias("last"), second_token("b").alias("first")).first()
    assert (r.last, r.first) == ("Иванова", "Анна")   # patronymic ignored


def test_int_text(spark):
    df = spark.createDataFrame([("",), (None,), ("12",), (" 12 ",)], "v string")
    assert [r[0] for r in df.select(int_from_text("v")).collect()] == [0, 0, 12, 12]


def test_int_text_garbage_fails(spark):
    df = spark.createDataFrame([("12.5",)], "v string")
    with pytest.raises(PySparkException):
        df.select(int_from_text("v")).collect()


def test_decimal_text(spark):
    df = spark.createDataFrame([("1" + NBSP + "234,5",), ("",), (None,), (" 1 000 ",)], "v string")
    got = [r[0] for r in df.select(decimal_from_text("v")).collect()]
    assert got == [Decimal("1234.5"), Decimal(0), Decimal(0), Decimal(1000)]


def test_decimal_text_garbage_fails(spark):
    df = spark.createDataFrame([("abc",)], "v string")
    with pytest.raises(PySparkException):
        df.select(decimal_from_text("v")).collect()


def test_decimal_text_keeps_digits_or_fails(spark):
    df = spark.createDataFrame([("0,12345678",), ("1000000000000",), ("1,5000000000000000",)], "v string")
    assert [r[0] for r in df.select(decimal_from_text("v")).collect()] == [
        Decimal("0.12345678"), Decimal(10 ** 12), Decimal("1.5")]
    for bad in ("0,1234567890123", "1" * 25):
        with pytest.raises(PySparkException):
            spark.createDataFrame([(bad,)], "v string").select(decimal_from_text("v")).collect()


def test_bad_text_fails_without_ansi(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        df = spark.createDataFrame([("zz",)], "v string")
        for f in (int_from_text, decimal_from_text):
            with pytest.raises(PySparkException):
                df.select(f("v")).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_ratio_operand_that_loses_digits_fails(spark):
    df = spark.createDataFrame([(Decimal("0.123456789"), Decimal("1"))], "n decimal(18,9), d decimal(18,9)")
    with pytest.raises(PySparkException):
        df.select(guarded_ratio("n", "d")).collect()


def test_strip_word_keeps_blank(spark):
    df = spark.createDataFrame([("Отчет A",)], "v string")
    assert df.select(strip_word("v", "Отчет")).first()[0] == " A"


def test_guarded_ratio_zero_and_tie(spark):
    df = spark.createDataFrame([(Decimal("1.005"), Decimal("1")), (Decimal("5"), Decimal("0")),
                                (Decimal("-1.005"), Decimal("1"))],
                               "n decimal(18,3), d decimal(18,3)")
    got = [r[0] for r in df.select(guarded_ratio("n", "d")).collect()]
    assert got == [Decimal("1.01"), Decimal(0), Decimal("-1.01")]   # half away from zero


def test_guarded_percent_no_double_rounding(spark):
    # 6205.488 / 4530.38 * 100 = 136.97499988...: exact rounding gives 136.97
    df = spark.createDataFrame([(Decimal("6205.488"), Decimal("4530.380"))],
                               "n decimal(28,3), d decimal(29,3)")
    assert df.select(guarded_percent("n", "d")).first()[0] == Decimal("136.97")


def test_division_error_is_guarded(spark):
    df = spark.createDataFrame([(Decimal("1"), Decimal("0"))], "n decimal(18,3), d decimal(18,3)")
    with pytest.raises(ArithmeticException):
        df.select(F.col("n") / F.col("d")).collect()       # ANSI: unguarded fails
    assert df.select(guarded_ratio("n", "d")).first()[0] == 0


def test_week_bounds(spark):
    df = spark.createDataFrame([("2025-01-01 13:00:00",), ("2024-12-29 00:00:00",)], "s string")
    df = df.select(F.to_timestamp_ntz("s").alias("t"))
    got = df.select(week_start("t").cast("string"), week_end("t").cast("string"), iso_week("t")).collect()
    assert [tuple(r) for r in got] == [("2024-12-30 00:00:00", "2025-01-05 00:00:00", 1),
                                       ("2024-12-23 00:00:00", "2024-12-29 00:00:00", 52)]
