"""Interval and as-of joins against brute force."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from starloom.operators.asof import asof_join
from starloom.operators.intervals import interval_join

T0 = datetime.datetime(2024, 1, 1)


def _intervals(rng, n, longest, names):
    rows = []
    for i in range(n):
        a = rng.randrange(-2000, 2000)
        rows.append((i, rng.choice(["a", "b", None]), a, a + int(rng.random() ** 6 * longest)))
    rows += [(n, "a", None, 5), (n + 1, "a", 5, None), (n + 2, "b", 10, 3), (0, "a", 7, 7), (0, "a", 7, 7)]
    return [dict(zip(names, r)) for r in rows]


@pytest.mark.parametrize("half_open", [False, True])
@pytest.mark.parametrize("keyed", [False, True])
def test_interval_join_equals_brute_force(spark, half_open, keyed):
    rng = random.Random(3)
    left = _intervals(rng, 150, 1500, ("i", "k", "a", "b"))
    right = _intervals(rng, 120, 6000, ("j", "k" if keyed else "k2", "c", "d"))

    def meets(x, y):
        if None in (x["a"], x["b"], y["c"], y["d"]) or (keyed and (x["k"] is None or x["k"] != y["k"])):
            return False
        end = 1 if half_open else 0
        return max(x["a"], y["c"]) <= min(x["b"], y["d"]) - end and x["a"] <= x["b"] - end and y["c"] <= y["d"] - end

    want = sorted((x["i"], x["a"], y["j"], y["c"]) for x in left for y in right if meets(x, y))
    ls = spark.createDataFrame([tuple(x.values()) for x in left], "i int, k string, a long, b long")
    rs = spark.createDataFrame([tuple(x.values()) for x in right], f"j int, {'k' if keyed else 'k2'} string, c long, d long")
    for bin_rows, width in ((50_000, None), (7, None), (50_000, 1), (5, 100)):
        got = interval_join(ls, rs, ("a", "b"), ("c", "d"), ["k"] if keyed else [], half_open, width, bin_rows)
        assert sorted((r.i, r.a, r.j, r.c) for r in got.collect()) == want
    assert len(want) > 50


@pytest.mark.parametrize("half_open", [False, True])
@pytest.mark.parametrize("keyed", [False, True])
def test_sums_equal_those_of_the_pairs(spark, half_open, keyed):
    rng = random.Random(8)
    key = "k" if keyed else "k2"
    ls = spark.createDataFrame([tuple(x.values()) for x in _intervals(rng, 150, 1500, ("i", "k", "a", "b"))], "i int, k string, a long, b long").distinct()
    rows = [(*x.values(), rng.choice([None, -3, 2**55])) for x in _intervals(rng, 120, 6000, ("j", key, "c", "d"))]
    rs = spark.createDataFrame(rows, f"j int, {key} string, c long, d long, v long")
    on = (("a", "b"), ("c", "d"), ["k"] if keyed else [], half_open)
    want = interval_join(ls, rs, *on).groupBy("i", "k", "a", "b").agg(F.count("*"), F.sum("v"))
    got = interval_join(ls, rs, *on, rows="n", sums={"v": F.col("v")})
    assert sorted(map(tuple, got.select("i", "k", "a", "b", "n", "v").collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    assert got.count() > 50
    assert interval_join(ls, rs.limit(0), *on, sums={"v": F.col("v")}).count() == 0
    assert interval_join(ls.limit(0), rs, *on, sums={"v": F.col("v")}).count() == 0


def test_sums_list_no_pairs(spark):
    """All pairs meet: 40,000 times 40,000 of them are counted."""
    points = spark.range(40_000).select("id", (F.col("id") % 1000).alias("t"))
    spans = spark.range(40_000).select(F.col("id").alias("j"), F.lit(0).alias("c"), F.lit(1000).alias("e"))
    got = interval_join(spans, points, ("c", "e"), ("t", "t"), sums={"s": F.col("id")})
    assert got.select("rows", "s").distinct().collect() == [(40_000, 40_000 * 39_999 // 2)]


def test_only_keys_with_many_rows_on_both_sides_are_cut_into_bins(spark):
    ls = spark.range(600).select(F.col("id").alias("i"), F.when(F.col("id") < 300, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("a"), (F.col("id") + 5).alias("b"))
    rs = spark.range(900).select(F.col("id").alias("j"), F.when(F.col("id") < 400, 0).otherwise(300 + F.col("id") % 300).alias("k"), F.col("id").alias("t"))
    on = (("a", "b"), ("t", "t"), ["k"])
    want = sorted(map(tuple, ls.join(rs, "k").where("t between a and b").select("i", "j").collect()))
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    few = interval_join(ls.where("k > 0"), rs, *on)
    assert "_bin" not in plan(few) and "_bin" in plan(interval_join(ls, rs, *on))
    assert sorted(map(tuple, interval_join(ls, rs, *on).select("i", "j").collect())) == want and len(want) > 1000
    assert few.where("k = 0").count() == 0


def test_interval_join_points_dates_and_empty(spark):
    d = lambda n: datetime.date(2024, 1, 1) + datetime.timedelta(n)
    ls = spark.createDataFrame([(1, d(0)), (2, d(5)), (3, d(10)), (4, None)], "i int, day date")
    rs = spark.createDataFrame([(1, d(0), d(5)), (2, d(5), d(9)), (3, d(-400), d(400))], "j int, c date, e date")
    pairs = lambda **k: sorted((r.i, r.j) for r in interval_join(ls, rs, ("day", "day"), ("c", "e"), **k).collect())
    assert pairs() == [(1, 1), (1, 3), (2, 1), (2, 2), (2, 3), (3, 3)]
    assert pairs(half_open=True) == [(1, 1), (1, 3), (2, 2), (2, 3), (3, 3)]
    assert interval_join(ls.limit(0), rs, ("day", "day"), ("c", "e")).count() == 0
    assert interval_join(ls, rs.limit(0), ("day", "day"), ("c", "e")).count() == 0
    with pytest.raises(ValueError, match="j"):
        interval_join(rs, rs, ("c", "e"), ("c", "e"))
    with pytest.raises(ValueError, match="string"):
        interval_join(ls.withColumn("s", F.lit("x")), rs, ("s", "s"), ("c", "e"))


def test_hot_bin_is_dealt_over_cells(spark):
    """A third of the points fall on one instant: its bin is cut into cells."""
    points = spark.range(30_000).select("id", F.when(F.col("id") % 3 == 0, F.lit(50)).otherwise(F.col("id") * 10).alias("t"))
    spans = spark.range(40).select(F.col("id").alias("j"), (F.col("id") * 5).alias("c"), (F.col("id") * 5 + 20).alias("e"))
    got = interval_join(points, spans, ("t", "t"), ("c", "e"), bin_rows=500)
    counts = {r.j: r["count"] for r in got.groupBy("j").count().collect()}
    ts = [50 if i % 3 == 0 else i * 10 for i in range(30_000)]
    for j in range(40):
        assert counts.get(j, 0) == sum(j * 5 <= t <= j * 5 + 20 for t in ts[:100]) + sum(t == 50 and j * 5 <= 50 <= j * 5 + 20 for t in ts[100:])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r[0] for r in got.groupBy(F.spark_partition_id()).count().select("count").collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert max(sizes) < 0.5 * sum(sizes)


def _asof(lefts, rights, exact):
    out = []
    for i, k, t in lefts:
        best = None
        for j, rk, rt in rights:
            if None not in (k, t, rk, rt) and rk == k and (rt <= t if exact else rt < t) and (best is None or (rt, j) > best):
                best = (rt, j)
        out.append((i, best and best[1]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("exact", [True, False])
def test_asof_join_equals_brute_force(spark, exact):
    rng = random.Random(5)
    key = lambda: None if rng.random() < 0.05 else ("hot" if rng.random() < 0.4 else f"k{rng.randrange(12)}")
    time = lambda: None if rng.random() < 0.03 else T0 + datetime.timedelta(minutes=rng.randrange(300))
    lefts = [(i, key(), time()) for i in range(600)] + [(0, "hot", T0)] * 2
    rights = [(j, key(), time()) for j in range(80)] + [(3, "hot", T0 + datetime.timedelta(minutes=1))]
    ls = spark.createDataFrame(lefts, "i int, k string, t timestamp")
    rs = spark.createDataFrame(rights, "j int, k string, rt timestamp")
    want = _asof(lefts, rights, exact)
    for n in (1, 4, 37):  # keys cross partition borders, some partitions hold left rows only
        got = asof_join(ls, rs, ["k"], "t", "rt", seq=["j"], allow_exact=exact, num_partitions=n)
        assert got.columns == ["i", "k", "t", "j", "rt"]
        rows = got.collect()
        assert sorted(((r.i, r.j) for r in rows), key=repr) == want
        assert all(r.j is None or r.rt == {j: rt for j, _, rt in rights[:80]}[r.j] or r.j == 3 for r in rows)


def test_asof_join_hot_key_is_spread(spark):
    events = spark.range(40_000).select(F.col("id").alias("i"), F.lit(1).alias("k"), F.col("id").alias("t"))
    marks = spark.range(4).select(F.col("id").alias("j"), F.lit(1).alias("k"), (F.col("id") * 9_000 + 5).alias("rt"))
    got = asof_join(events, marks, ["k"], "t", "rt", num_partitions=8)
    sizes = [r[0] for r in got.groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert len(sizes) >= 8 and max(sizes) < 12_000
    assert got.where("j is null").count() == 5
    assert got.where("t >= 5 and j <> least(3, (t - 5) div 9000)").count() == 0


def test_asof_join_edges(spark):
    ls = spark.createDataFrame([(1, 1, 5), (2, None, 5), (3, 1, None)], "i int, k int, t int")
    rs = spark.createDataFrame([(7, 1, 5)], "j int, k int, rt int")
    assert sorted((r.i, r.j) for r in asof_join(ls, rs, ["k"], "t", "rt").collect()) == [(1, 7), (2, None), (3, None)]
    assert asof_join(ls.limit(0), rs, ["k"], "t", "rt").count() == 0
    assert [r.j for r in asof_join(ls, rs.limit(0), ["k"], "t", "rt").collect()] == [None] * 3
    with pytest.raises(ValueError, match="types"):
        asof_join(ls, rs.withColumn("rt", F.col("rt").cast("long")), ["k"], "t", "rt")
    with pytest.raises(ValueError, match="i"):
        asof_join(ls, rs.withColumnRenamed("j", "i"), ["k"], "t", "rt")
