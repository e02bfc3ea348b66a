"""Grouping-set lattice, sketches and moving frames."""

import bisect
import datetime
import random

import pytest
from pyspark.sql import functions as F

from starloom.operators import lattice
from starloom.operators.frames import chunked, moving

D0 = datetime.date(2024, 1, 1)


@pytest.fixture(scope="module")
def sales(spark):
    """50,000 sales; one product has a third of them; some dimensions are NULL."""
    i = F.col("id")
    product = F.when(i % 3 == 0, F.lit("hot")).when(i % 97 == 0, F.lit(None)).otherwise(F.concat(F.lit("p"), i % 40))
    price = F.when(i % 11 == 0, F.lit(None)).otherwise(F.pmod(F.xxhash64("id"), F.lit(100_000))).cast("long")
    return spark.range(50_000).select(F.concat(F.lit("r"), i % 7).alias("room"), product.alias("product"), (i % 5).alias("year"), price.alias("price"), F.pmod(F.hash("id"), F.lit(9_000)).alias("member"))


def measures():
    return [lattice.rows("n"), lattice.total("price_sum", F.col("price")), lattice.least("low", F.col("price")), lattice.largest("high", F.col("price")), lattice.average("mean", F.col("price"))]


def test_lattice_equals_grouping_sets(spark, sales):
    sets = [("year", "room", "product"), ("year", "room"), ("year", "product"), ("room",), ("year",), ()]
    got = lattice.grouping_sets(sales, sets, measures())
    sales.createOrReplaceTempView("lattice_sales")
    want = spark.sql("""select year, room, product, cast(grouping_id(year, room, product) as bigint) grouping_id, count(*) n,
        sum(price) price_sum, min(price) low, max(price) high, cast(sum(price) as double) / count(price) mean from lattice_sales
        group by grouping sets ((year, room, product), (year, room), (year, product), (room), (year), ())""")
    assert got.columns == want.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_lattice_reads_the_facts_once(spark, sales, tmp_path):
    path = str(tmp_path / "sales")
    sales.write.parquet(path)
    got = lattice.grouping_sets(spark.read.parquet(path), [("year", "room"), ("year",), ("room",), ()], measures())
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan and "parquet" not in plan.lower()  # all sets come from the stored finest aggregate


def test_lattice_of_nothing(spark, sales):
    rows = lattice.grouping_sets(sales.limit(0), [("room",), ()], measures()).collect()
    assert [(r.room, r.grouping_id, r.n, r.price_sum, r["mean"]) for r in rows] == [(None, 1, 0, None, None)]
    with pytest.raises(ValueError, match="set"):
        lattice.grouping_sets(sales, [], measures())


def test_distinct_estimates_merge_within_their_error(spark, sales):
    m = [lattice.distinct_estimate("members", F.col("member"))]
    stored = lattice.partials(sales, ["year", "room", "product"], m)
    for dims in (["year"], ["room"], ["product"], []):
        exact = {tuple(r[d] for d in dims): r["n"] for r in sales.groupBy(*dims).agg(F.count_distinct("member").alias("n")).collect()}
        got = {tuple(r[d] for d in dims): r["members"] for r in lattice.rolled_up(stored, dims, m).collect()}
        assert got.keys() == exact.keys()
        for k, n in exact.items():
            assert abs(got[k] - n) <= max(2, 4 * 1.04 / 2 ** (lattice.LG_K / 2) * n), (dims, k)


def test_quantiles_merge_within_their_rank_error(spark, sales):
    ranks = (0.05, 0.5, 0.95)
    m = [lattice.quantiles("q", F.col("price"), ranks)]
    stored = lattice.partials(sales, ["year", "room", "product"], m)
    for dims in (["room"], ["product"], []):
        values = {}
        for r in sales.select(*dims, "price").collect():
            values.setdefault(tuple(r[d] for d in dims), []).append(r.price)
        for r in lattice.rolled_up(stored, dims, m).collect():
            have = sorted(v for v in values[tuple(r[d] for d in dims)] if v is not None)
            for rank, q in zip(ranks, r["q"]):
                low, high = bisect.bisect_left(have, q) / len(have), bisect.bisect_right(have, q) / len(have)
                assert low - 0.01 <= rank <= high + 0.01
    none = sales.select("room", F.lit(None).cast("long").alias("price"))
    assert {r["q"] for r in lattice.rolled_up(lattice.partials(none, ["room"], m), ["room"], m).collect()} == {None}


def _brute(rows, length):
    out = []
    for k, t, v in rows:
        frame = [x for kk, tt, x in rows if kk == k and t is not None and tt is not None and 0 <= (t - tt).days <= length] if t is not None else [x for kk, tt, x in rows if kk == k and tt is None]
        known = [x for x in frame if x is not None]
        out.append((k, t, v, sum(known) if known else None, len(frame)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("chunk_rows", [500_000, 20, 3])
def test_moving_frames_equal_brute_force(spark, chunk_rows):
    rng = random.Random(chunk_rows)
    rows = [("hot" if rng.random() < 0.4 else rng.choice(["a", "b", None]), None if rng.random() < 0.03 else D0 + datetime.timedelta(rng.randrange(-40, 80)), rng.choice([None, 1, 5, 9])) for _ in range(300)]
    df = spark.createDataFrame(rows, "k string, day date, v int")
    for length in (0, 6, 30):
        got = moving(df, ["k"], "day", length, {"s": F.sum("v"), "n": F.count(F.lit(1))}, chunk_rows)
        assert sorted(map(tuple, got.collect()), key=repr) == _brute(rows, length)
    assert moving(df.limit(0), ["k"], "day", 6, {"s": F.sum("v")}).count() == 0


def test_hot_key_is_cut_and_others_are_not(spark):
    i = F.col("id")
    df = spark.range(60_000).select(F.when(i % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), i % 500)).alias("k"), F.date_add(F.lit(D0), (i % 2000).cast("int")).alias("day"))
    parts = chunked(df, ["k"], "day", 6, chunk_rows=2_000)
    sizes = parts.groupBy("k", "_chunk").count().where("k = 'hot'").select("count").collect()
    assert len(sizes) >= 9 and max(r[0] for r in sizes) <= 2_500
    assert parts.where("k <> 'hot' and (_halo or _chunk <> 0)").count() == 0
    assert parts.where("not _halo").count() == 60_000
    assert parts.where("_halo").count() <= 20 * 7 * 11  # frames that reach over a border
