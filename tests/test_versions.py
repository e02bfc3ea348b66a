"""Run-to-run difference and clustered layout."""

import datetime
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from starloom.operators import layout
from starloom.plans.difference import bucket_sums, difference, unequal_buckets


def _rows(seed, n=400):
    rng = random.Random(seed)
    return [(rng.randrange(60), rng.choice(["a", None, "b"]), rng.choice([1.5, None, -0.5])) for _ in range(n)]


@pytest.mark.parametrize("buckets", [1, 16, 65_536])
def test_difference_is_except_all_both_ways(spark, buckets):
    old = _rows(1)
    new = old[5:] + [(7, "new", 1.0)] * 3 + [old[0], old[9], old[9]]
    schema = "k int, s string, x double"
    a, b = spark.createDataFrame(old, schema), spark.createDataFrame(new, schema).select("x", "k", "s").repartition(5)
    want = Counter(new)
    want.subtract(Counter(old))
    got = {tuple(r)[:3]: r.change for r in difference(a, b, ["k"], buckets).collect()}
    assert got == {k: n for k, n in want.items() if n}
    assert difference(a, a.repartition(3), ["k"], buckets).count() == 0
    assert difference(a.limit(0), a.limit(0), ["k"], buckets).count() == 0
    with pytest.raises(ValueError, match="columns"):
        difference(a, b.drop("x"), ["k"])


def test_nulls_in_other_columns_are_told_apart(spark):
    a = spark.createDataFrame([(1, "x", None)], "k int, s string, t string")
    b = spark.createDataFrame([(1, None, "x")], "k int, s string, t string")
    assert difference(a, b, ["k"]).count() == 2
    assert bucket_sums(a, ["k"]).collect() != bucket_sums(b, ["k"]).collect()


def test_only_unequal_buckets_are_compared(spark):
    old = spark.range(20_000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"))
    new = old.withColumn("v", F.when(F.col("k") == 77, -1).otherwise(F.col("v")))
    assert unequal_buckets(old, new, ["k"], 1024).count() == 1
    plan = difference(old, new, ["k"], 1024)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftSemi") == 2
    assert sorted(map(tuple, difference(old, new, ["k"], 1024).collect())) == [(77, -1, 1), (77, 0, -1)]


@pytest.fixture(scope="module")
def clustered(spark, tmp_path_factory):
    i = F.col("id")
    day = F.when(i % 50 == 0, F.lit(None)).otherwise(F.date_add(F.lit(datetime.date(2024, 1, 1)), F.pmod(F.hash("id"), F.lit(700)).cast("int")))
    product = F.when(i % 3 == 0, F.lit(5)).otherwise(F.pmod(F.xxhash64("id"), F.lit(3000))).cast("long")
    df = spark.range(40_000).select("id", day.alias("day"), product.alias("product"))
    path = str(tmp_path_factory.mktemp("layout") / "t")
    layout.write_clustered(df, path, ["day", "product"], files=64)
    return df, path


def test_filters_on_two_columns_leave_most_files_out(spark, clustered):
    df, path = clustered
    every = spark.read.parquet(f"{path}/zones").count()
    assert spark.read.parquet(f"{path}/data").count() == 40_000 and every >= 40
    d = datetime.date
    both = {"day": (d(2024, 3, 1), d(2024, 4, 15)), "product": (1000, 1300)}
    assert len(layout.matching_files(spark, path, ["day", "product"], both)) <= every / 6
    for ranges in (both, {"day": both["day"]}, {"product": both["product"]}, {"product": (5, 5)}, {"day": (d(2030, 1, 1), d(2031, 1, 1))}):
        want = df
        for c, (low, high) in ranges.items():
            want = want.where(F.col(c).between(low, high))
        got = layout.read_clustered(spark, path, ["day", "product"], ranges)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
        assert len(layout.matching_files(spark, path, ["day", "product"], ranges)) < 0.75 * every
    with pytest.raises(ValueError):
        layout.write_clustered(df, path + "x", [], 4)


def test_layout_below_a_folder_with_odd_characters(spark, tmp_path):
    """Spark gives the path of a file URL-encoded."""
    df = spark.range(300).select("id", (F.col("id") % 7).alias("p"))
    for name in ("a b", "a%20b", "a+b"):
        path = str(tmp_path / name)
        layout.write_clustered(df, path, ["id", "p"], files=4, bits=2)
        got = layout.read_clustered(spark, path, ["id", "p"], {"id": (10, 40)})
        assert sorted(r.id for r in got.collect()) == list(range(10, 41))


def test_slice_numbers_are_computed_once_a_row(spark):
    rows = [(None, 3), (-5, None), (0, 0), (7, 9), (8, -1), (99, 4)]
    df = spark.createDataFrame(rows, "a long, b long")
    cuts = {"a": [0, 7, 8], "b": [2, 4]}
    keyed = layout.with_curve_key(df, cuts, "_z", bits=2)
    assert keyed.columns == ["a", "b", "_z"]
    want = {}
    for row in rows:
        numbers = [0 if v is None else 1 + sum(c < v for c in cuts[k]) for k, v in zip("ab", row)]
        want[row] = sum((n >> bit & 1) << (2 * bit + 1 - i) for i, n in enumerate(numbers) for bit in range(3))
    assert {(r.a, r.b): r._z for r in keyed.collect()} == want
    assert keyed._jdf.queryExecution().optimizedPlan().toString().count("aggregate(") == 2
