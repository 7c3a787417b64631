"""Scalar functions against hand-written expectations."""

from urllib.parse import quote

import pytest
from pyspark.sql import functions as F

from placeflow.functions import text


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


@pytest.mark.parametrize("value,longest,want", [(None, None, "N/A"), ("", None, "N/A"), ("N/A", None, "N/A"), ("abcdef", 3, "abc..."), ("abc", 3, "abc")])
def test_safe_str(spark, value, longest, want):
    assert one(spark, text.safe_str(F.lit(value).cast("string"), longest=longest)) == want


@pytest.mark.parametrize("value,want", [("123.0", "123"), ("123", "123"), ("1.00", "1.00"), ("10.05", "10.05"), (None, None)])
def test_clean_id(spark, value, want):
    assert one(spark, text.clean_id(F.lit(value).cast("string"))) == want


def test_clean_id_of_numbers(spark):
    assert one(spark, text.clean_id(F.lit(123.0))) == "123"


def test_place_id_and_url(spark):
    assert one(spark, text.place_id(F.lit("https://x/place/38?x"))) == "38"
    assert one(spark, text.place_id(F.lit("https://x/place/"))) is None
    assert one(spark, text.place_url(F.lit("https://x/place/38?a=b"))) == "https://x/place/38"


@pytest.mark.parametrize("value", ["길동 의원/a+b~c*(1)", "", "a&b=c?", "%+-_.~"])
def test_quote(spark, value):
    assert one(spark, text.quote(F.lit(value))) == quote(value)


def test_strip_beyond_ascii(spark):
    assert one(spark, text.strip(F.lit(" 　 a b\x1c\t"))) == "a b"


def test_json_array(spark):
    items = F.array(F.lit("예약"), F.lit('대기 "10"분'), F.lit("a\\b\n"))
    assert one(spark, text.json_array(items)) == '["예약", "대기 \\"10\\"분", "a\\\\b\\n"]'
    assert one(spark, text.json_array(F.lit(None).cast("array<string>"))) == "[]"


def test_words_in_names(spark):
    assert one(spark, text.has_any(F.lit("가온의원"), ["병원", "의원"])) is True
    assert one(spark, text.has_any(F.lit(None).cast("string"), ["병원"])) is False
    assert one(spark, text.has_pattern(F.lit(None).cast("string"), "병원|의원")) is False


def test_numbers_and_dates_in_text(spark):
    assert one(spark, text.number(F.lit("1,870"))) == 1870
    assert one(spark, text.number(F.lit("없음"))) is None
    assert one(spark, text.visit_date(F.lit("12.11.목"))).asDict() == {"month": 12, "day": 11, "weekday": "목"}
    assert one(spark, text.visit_date(F.lit("x"))) is None
    assert one(spark, text.grouped(F.lit(1234567))) == "1,234,567"
    assert one(spark, text.join_or_na(F.array().cast("array<string>"))) == "N/A"
    assert one(spark, text.parsed_time(F.lit("nope"))) is None
