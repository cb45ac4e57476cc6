"""Golden rows of the field formats."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from feedweave.functions import dates, fixed_values, numbers, text


def one(spark, value, build):
    df = spark.createDataFrame([(value,)], "c string")
    return df.select(build(F.col("c")).alias("r")).first().r


@pytest.mark.parametrize(
    "value, expected",
    [
        ("12.345", "    1235"), ("12.999", "    1300"), ("0.55", "      55"), ("-0.55", "     -55"),
        ("-3.25", "    -325"), ("0", "     000"), ("0.00", "     000"), ("0.995", "     100"),
        ("0.001", "      00"), ("10.35", "    1035"), ("100", "   10000"), (None, " " * 8),
        ("1234567.10", "123456710"), ("no number", None),
    ],
)
def test_money(spark, value, expected):
    assert one(spark, value, numbers.money_or_spaces) == expected


@pytest.mark.parametrize(
    "value, expected",
    [
        ("12.5", "0000012500"), ("1250", "0001250000"), ("0.0019", "0000000001"), ("-12.5", "-000012500"),
        ("12345678", "12345678000"), (None, " " * 10), ("x", None),
    ],
)
def test_quantity(spark, value, expected):
    assert one(spark, value, lambda c: numbers.quantity_or(c, " ")) == expected


@pytest.mark.parametrize(
    "value, first, second",
    [
        ("0", "00", "00"), ("1", "00", "00"), ("100", "99", "99"), ("101", "99", "99"), (None, "00", "00"),
        ("-1", None, "00"), ("0.5", "00", "00"), ("50", "49", "49"), ("x", None, None),
    ],
)
def test_clamp_ordinal(spark, value, first, second):
    assert one(spark, value, numbers.clamp_ordinal) == first
    assert one(spark, value, lambda c: numbers.clamp_ordinal(c, "00")) == second


@pytest.mark.parametrize(
    "value, expected", [("-5", "05"), ("99.5", "99"), ("98.7", "98"), ("-300", "99"), (None, "00"), ("x", None)]
)
def test_clamp_abs(spark, value, expected):
    assert one(spark, value, numbers.clamp_abs) == expected


@pytest.mark.parametrize(
    "value, expected",
    [
        ("123", "000000000000275"), (None, "0" * 15), ("12.9", "000000000000164"), ("#12", "000000000000164"),
        ("123456789012345678", "123456789012345830"), ("9" * 60, None), ("none", "0" * 15),
    ],
)
def test_offset_key(spark, value, expected):
    got = one(spark, value, lambda c: numbers.offset_key_or_zeros(c, 152, 15))
    assert len(got) > 15 if expected is None else got == expected


@pytest.mark.parametrize(
    "value, expected",
    [("123456789", "75BCD15    "), (None, " " * 11), ("000", "0          "), ("0" * 30 + "16", "10         "), ("9" * 40, None)],
)
def test_hex_id(spark, value, expected):
    got = one(spark, value, lambda c: numbers.hex_id(c, 11))
    assert len(got) > 11 if expected is None else got == expected


def test_clean_pad_truncates_and_defaults(spark):
    assert one(spark, " a#b/c ", lambda c: text.clean_pad(c, 3)) == "ab/"
    assert one(spark, None, lambda c: text.clean_pad(c, 7, null_text="PATIENT_ZIP")) == "PATIENT"
    assert one(spark, "7", lambda c: text.clean_pad(c, 3, "left", "0")) == "007"


@pytest.mark.parametrize(
    "born, expected", [("1935-01-01", "1935"), ("1930-01-01", "0000"), (None, "    "), ("x", None)]
)
def test_birth_year(spark, born, expected):
    assert one(spark, born, lambda c: dates.birth_year_topcode(c, dt.date(2024, 1, 1), 89)) == expected


def test_second_variant_topcodes_one_year_earlier(spark):
    as_of = dt.date(2024, 6, 1)
    assert one(spark, "1935-01-01", lambda c: dates.birth_year_topcode(c, as_of, 89)) == "1935"
    assert one(spark, "1935-01-01", lambda c: dates.birth_year_topcode(c, as_of, 88)) == "0000"


def test_times(spark):
    assert one(spark, "10:11:12", lambda c: dates.format_time(c, "HH:mm:ss", 8)) == "10:11:12"
    assert one(spark, "2024-01-05", lambda c: dates.format_time(c, "yyyyMMdd", 8)) == "20240105"
    assert one(spark, "soon", lambda c: dates.format_time(c, "yyyyMMdd", 8)) == " " * 8


def test_texts_cleaned_together_equal_texts_cleaned_one_by_one(spark):
    rows = [(" a#b", None, "x/y"), ("", "é", "-"), ("p\u0001q#", "\u0001", ""), (None, None, None), ("\u0001", "", "\u0001\u0001"), ("A..z", "0 9", "日本")]
    df = spark.createDataFrame(rows, "a string, b string, c string")
    columns = [F.col(c) for c in df.columns]
    single = F.array(*[F.coalesce(text.clean(c), F.lit("")) for c in columns])
    for row in df.select(text.cleaned_together(columns).alias("both"), single.alias("single")).collect():
        assert row.both == row.single


def test_listed_class_means_the_same(spark):
    every = "".join(map(chr, range(1, 300)))
    for drop in (fixed_values.PLAIN_TEXT, fixed_values.ALNUM_ONLY):
        assert one(spark, every, lambda c: text.clean(c, drop)) == one(spark, every, lambda c: F.regexp_replace(c, drop, ""))
