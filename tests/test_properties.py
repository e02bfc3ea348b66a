"""Generated-input properties, each checked in one Spark job per example batch."""

import html

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starloom.functions import html_text
from starloom.functions.money import hundredths_to_money
from starloom.operators.keys import assign_keys
from starloom.sources.readers import read_query, rename_columns

TOKENS = ["&amp;", "&lt;", "&gt;", "&quot;", "&apos;", "&copy;", "&middot;", "&#65;", "&#x42;", "&amp",
          "&am", "&", ";", "#", "a", "é", " ", "\n", "amp;", "lt", "&amp;lt;", "&nbsp;", "&notin;", "&not"]
SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(st.lists(st.lists(st.sampled_from(TOKENS), max_size=12).map("".join), min_size=1, max_size=40))
def test_entity_decoding_equals_stdlib(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string")
    got = {r.i: r.t for r in df.select("i", html_text("s").alias("t")).collect()}
    assert [got[i] for i in range(len(texts))] == [html.unescape(t) for t in texts]


@SETTINGS
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(-5, 5)), st.text(max_size=3)),
                min_size=0, max_size=60, unique=True),
       st.integers(1, 9), st.integers(-3, 3))
def test_assign_keys_is_row_number(spark, rows, parts, start):
    df = spark.createDataFrame(rows, "a int, b string")
    expect = df.select(
        (F.row_number().over(W.orderBy(F.col("a").asc_nulls_first(), F.col("b").asc_nulls_first()))
         + start - 1).alias("id"), "a", "b")
    for local in (0, 1000):
        got = assign_keys(df, ["a", "b"], key="id", start=start, num_partitions=parts, local_max_rows=local)
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, expect.collect()), key=repr)


@SETTINGS
@given(st.lists(st.integers(-9_999_999_999, 9_999_999_999), min_size=1, max_size=50))
def test_money_is_exact(spark, cents):
    from decimal import Decimal

    df = spark.createDataFrame([(c,) for c in cents], "p long")
    got = [r[0] for r in df.select(hundredths_to_money("p")).collect()]
    assert got == [Decimal(c).scaleb(-2) for c in cents]


def test_reader_validation(spark):
    with pytest.raises(ValueError):
        read_query(spark, "jdbc:none", query="select 1", table="t")
    with pytest.raises(ValueError):
        read_query(spark, "jdbc:none", table="sale", partition_column="id")
    df = spark.createDataFrame([(1, "M")], "a long, b string")
    assert rename_columns(df, ["x", "y"]).columns == ["x", "y"]
    with pytest.raises(ValueError):
        rename_columns(df, ["x"])
