"""Bloom-filter reduction of semi, anti and inner joins."""

import datetime

import pytest
from pyspark.sql import functions as F

from starloom.operators import bloom
from starloom.operators.joins import anti_join, join_sides, semi_join


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture(scope="module")
def big(spark):
    """100,000 rows; one key holds a third of them, half the keys have no partner."""
    key = F.when(F.col("id") % 3 == 0, F.lit(4)).otherwise(F.col("id") % 20_000)
    return spark.range(100_000).select("id", key.cast("int").alias("k"))


@pytest.fixture(scope="module")
def side(spark):
    return spark.range(10_000).select((F.col("id") * 2).alias("k"))


def test_no_key_is_lost_and_few_others_pass(spark, big, side):
    known = bloom.build(side, ["k"])
    rows = bloom.with_match(big, known, ["k"])
    has = (F.col("k") % 2 == 0)
    assert rows.where(has & ~F.col("_may_match")).count() == 0
    without = big.where(~has).count()
    assert 0 < without and rows.where(~has & F.col("_may_match")).count() <= 0.02 * without


def test_size_is_bounded():
    assert bloom.bits_for(0) == bloom.MIN_BITS
    assert bloom.bits_for(10**12) == bloom.MAX_BITS
    assert bloom.bits_for(1_000_000) == 1 << 24


def test_semi_and_anti_equal_plain_joins(spark, big, side):
    want = sorted(r.id for r in big.where("k % 2 = 0").collect())
    other = sorted(r.id for r in big.where("k % 2 = 1").collect())
    for budget in (0, None):
        assert sorted(r.id for r in semi_join(big, side, ["k"], budget).collect()) == want
        assert sorted(r.id for r in anti_join(big, side, ["k"], budget).collect()) == other
    narrow = big.select("k")
    assert sorted(r.id for r in anti_join(big, side, ["k"], 0, narrow).collect()) == other


def test_anti_join_with_narrow_shuffles_no_wide_row(spark, big, side):
    wide = big.withColumn("payload", F.repeat(F.lit("x"), 100))
    out = anti_join(wide, side, ["k"], 0, narrow=big.select("k"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "SortMergeJoin" not in plan


def test_rows_are_dropped_before_the_exchange(spark, big, side):
    out = join_sides(big.withColumn("k", F.col("k").cast("long")), {"k": side}, max_rows=0)
    assert out.count() == big.where("k % 2 = 0").count()
    join = out._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" in join and "BroadcastHashJoin" in join  # the filter's lines
    exchanged = join_sides(big.withColumn("k", F.col("k").cast("long")), {"k": side}, max_rows=0, how="left")
    assert "_words" not in _plan(exchanged)  # an outer join keeps every row


def test_nulls_types_and_empty_sides(spark):
    d = datetime.date(2024, 1, 1)
    rows = spark.createDataFrame([(1, "a", d, 0.0), (2, None, d, -0.0), (None, "b", None, float("nan")), (1, "a", d, 0.0)], "i int, s string, d date, x double")
    side = spark.createDataFrame([(1, "a", d, -0.0), (None, "b", None, float("nan")), (1, "a", d, 0.0)], "i long, s string, d date, x double")
    for on in (["i"], ["s"], ["i", "s"], ["d", "s"], ["x"], ["x", "i"]):
        plain = rows.join(side.select(*on), on, "left_semi").count()
        assert semi_join(rows, side, on, 0).count() == plain, on
        assert anti_join(rows, side, on, 0).count() == rows.count() - plain, on
        assert anti_join(rows, side, on, 0, rows).count() == rows.count() - plain, on
    none = side.limit(0)
    assert semi_join(rows, none, ["i"], -1).count() == 0 and anti_join(rows, none, ["i"], -1).count() == 4
    assert semi_join(rows.limit(0), side, ["i"], 0).count() == 0
    with pytest.raises(ValueError, match="type"):
        bloom.with_match(rows, bloom.build(side, ["i"]), ["s"])
