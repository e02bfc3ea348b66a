import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starloom.functions.html import with_html_text
from starloom.functions import (
    GENDER_CODES,
    bool_label,
    day_name,
    fill_defaults,
    html_text,
    money_sum,
    recode,
    season,
    time_of_day,
    weekday_flag,
)
from starloom.functions.money import hundredths_to_money
from starloom.functions.timeparts import time_of_day_code, time_of_day_label


def test_time_of_day_first_match_wins(spark):
    hours = [5, 6, 10, 11, 13, 14, 16, 17, 23]
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, h),) for h in hours], "ts timestamp_ntz")
    got = [r[0] for r in df.select(time_of_day("ts")).collect()]
    assert got == ["Night", "Morning", "Morning", "Noon", "Noon", "Afternoon", "Afternoon", "Night", "Night"]


def test_time_of_day_code_round_trips(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, h),) for h in range(24)], "ts timestamp_ntz")
    rows = df.select(time_of_day("ts").alias("a"), time_of_day_label(time_of_day_code("ts")).alias("b")).collect()
    assert all(r.a == r.b for r in rows)


def test_season_edges(spark):
    months = [2, 3, 5, 6, 8, 9, 11, 12]
    df = spark.createDataFrame([(dt.datetime(2024, m, 1),) for m in months], "ts timestamp_ntz")
    got = [r[0] for r in df.select(season("ts")).collect()]
    assert got == ["Winter", "Spring", "Spring", "Summer", "Summer", "Fall", "Fall", "Winter"]


def test_weekday_names_and_flag(spark):
    days = [dt.datetime(2024, 1, d) for d in range(1, 8)]  # Monday .. Sunday
    df = spark.createDataFrame([(d,) for d in days], "ts timestamp_ntz").select(day_name("ts").alias("d"))
    rows = df.select("d", weekday_flag("d").alias("w")).collect()
    assert [r.d for r in rows] == ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
    assert [r.w for r in rows] == ["Yes"] * 5 + ["No"] * 2


def test_padded_day_name_reproduces_fixed_width(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1),)], "ts timestamp_ntz")
    padded = df.select(day_name("ts", pad=True).alias("d")).first().d
    assert padded == "Monday   "
    assert df.select(weekday_flag(day_name("ts", pad=True))).first()[0] == "No"


def test_recode_policies(spark):
    df = spark.createDataFrame([("M",), ("F",), ("U",), ("X",), (None,)], "g string")
    got = [r[0] for r in df.select(recode("g", GENDER_CODES, "default", "?")).collect()]
    assert got == ["Male", "Female", "Undefined", "?", "?"]
    got = [r[0] for r in df.select(recode("g", GENDER_CODES, "null")).collect()]
    assert got == ["Male", "Female", "Undefined", None, None]
    with pytest.raises(Exception, match="unknown code: X"):
        df.filter("g = 'X'").select(recode("g", GENDER_CODES, "error")).collect()
    with pytest.raises(Exception, match="unknown code: NULL"):
        df.filter("g is null").select(recode("g", GENDER_CODES, "error")).collect()


def test_bool_label_null_is_inactive(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "a boolean")
    assert [r[0] for r in df.select(bool_label("a")).collect()] == ["active", "inactive", "inactive"]


def test_fill_defaults(spark):
    df = spark.createDataFrame([(None, "Kaffe", None)], "product_type string, category string, subcategory string")
    r = fill_defaults(df).first()
    assert (r.product_type, r.category, r.subcategory) == ("No product_type", "Kaffe", "No subcategory")


@pytest.mark.parametrize("raw,text", [
    ("<b>A</b> &amp; B", "A & B"),
    ("A & B", "A & B"),
    ("&oslash;l", "øl"),
    ("&#216;l", "Øl"),
    ("&#xD8;l", "Øl"),
    ("a<!-- hidden -->b", "ab"),
    ("<script>var t=\"</p>\";</script>x", "x"),
    ("<style>p{margin:0}</style>y", "y"),
    ("&amp;lt;", "&lt;"),
    ("x &copy; y &middot; z", "x © y · z"),
    ("keep <p class", "keep "),
    ("tail &amp", "tail &"),
    ("not &am entity", "not &am entity"),
    ("<!DOCTYPE html><title>T</title>", "T"),
    ("a < b", "a < b"),
    ("<script>if (a<!--b) x()</script>after", "after"),
    ("<p>x<!-- never closed", "x"),
    ("<SCRIPT type=t>x</SCRIPT>y", "y"),
])
def test_html_text(spark, raw, text):
    df = spark.createDataFrame([(raw,)], "s string")
    assert df.select(html_text("s")).first()[0] == text


def test_html_text_null(spark):
    df = spark.createDataFrame([(None,)], "s string")
    assert df.select(html_text("s")).first()[0] is None


def test_money_sum_is_exact_decimal(spark):
    df = spark.createDataFrame([(g, p) for g, p in [(1, 1005), (1, 1), (2, 12345678)]], "g int, price long")
    got = {r.g: r.k for r in df.groupBy("g").agg(money_sum("price").alias("k")).collect()}
    assert got == {1: Decimal("10.06"), 2: Decimal("123456.78")}


def test_money_overflow_fails(spark):
    df = spark.createDataFrame([(10_000_000_000,)], "p long")  # 100,000,000.00
    with pytest.raises(Exception):
        df.select(hundredths_to_money("p")).collect()
    ok = spark.createDataFrame([(9_999_999_999,)], "p long").select(hundredths_to_money("p")).first()[0]
    assert ok == Decimal("99999999.99")


def test_date_parts_are_ints(spark):
    from starloom.functions import date_parts

    df = spark.createDataFrame([(dt.datetime(2024, 3, 9, 13, 5),)], "ts timestamp_ntz").select(*date_parts("ts"))
    assert tuple(df.first()) == (2024, 3, 9, 13)
    assert all(f.dataType.typeName() == "integer" for f in df.schema.fields)


def test_time_zone_pinned(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 23),)], "ts timestamp_ntz")
    assert df.select(F.hour("ts")).first()[0] == 23


@pytest.mark.parametrize("markup, text", [
    ('<a title="x > y">text</a>', "text"),
    ("<a title = 'x > y' b=\"'>\">text</a>", "text"),
    ('<a title="never closed>text</a>', "text"),
    ("<p class=it's>don't</p>", "don't"),
    ('<script type="a>b">x</script>y', "y"),
    ("<scripted>x</scripted>", "x"),
    ("a<![CDATA[ 1 < 2 && <b>x</b> &amp; ]]>b &amp; c", "a 1 < 2 && <b>x</b> &amp; b & c"),
    ("a<![CDATA[never closed & cut", "a"),
    ("<!-- <![CDATA[ x & y ]]> -->z", "z"),
    ('<a title="' + "x > " * 20_000 + '">long</a>', "long"),
    ("<a " + "b=c " * 50_000 + ">many</a>", "many"),
    (None, None),
    ("", ""),
])
def test_html_quotes_and_cdata(spark, markup, text):
    df = spark.createDataFrame([(markup,)], "html string")
    assert with_html_text(df, "html", "text").first()["text"] == text
