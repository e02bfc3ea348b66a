"""Properties of the flagship load on the smallest scale factor."""

from dataclasses import replace
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starloom import schemas
from starloom.operators import checks
from starloom.operators.facts import canonical_names, reaggregate, sales_aggregated, staged_sales
from starloom.plans import publish, star
from starloom.plans.catalog import operational
from starloom.sources.fixtures import Sources

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def loads(spark):
    src = Sources(spark, SF_SMALL)
    op = operational(src)
    return {
        "src": src,
        "two": star.two_stage_load(spark, op, src.level_map()),
        "first": star.keys_first_load(spark, op, src.level_map()),
        "gap_two": star.two_stage_load(spark, operational(src, gap=True), src.level_map(gap=True)),
        "gap_first": star.keys_first_load(spark, operational(src, gap=True), src.level_map(gap=True)),
    }


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_two_stage_equals_keys_first(loads):
    for name in ("product", "member", "room", "time", "salesfact"):
        assert _rows(getattr(loads["two"], name)) == _rows(getattr(loads["first"], name)), name


def test_two_stage_equals_keys_first_with_missing_products(loads):
    assert _rows(loads["gap_two"].salesfact) == _rows(loads["gap_first"].salesfact)
    # some facts resolve to the default product
    assert loads["gap_first"].salesfact.filter("productid = 1").count() > 0


def test_totals_preserved(loads):
    sale = loads["src"].sale
    exp = sale.agg((F.sum("price").cast("decimal(38,0)") / 100).cast("decimal(20,2)").alias("k"),
                   F.count(F.lit(1)).alias("n")).first()
    for key in ("first", "gap_first", "two"):
        got = loads[key].salesfact.agg(F.sum("kroner_sales").alias("k"), F.sum("unit_sales").alias("n")).first()
        assert Decimal(got.k) == Decimal(exp.k) and got.n == exp.n, key


def test_fact_passes_integrity_checks(loads):
    wh = loads["gap_first"]
    report = checks.warehouse_report(wh.tables(), schemas.PRIMARY_KEYS, schemas.FOREIGN_KEYS)
    bad = report.filter("violations > 0").collect()
    assert bad == []
    assert report.count() == len(schemas.PRIMARY_KEYS) + 8 + 4


def test_schemas_and_defaults(loads):
    wh = loads["first"]
    for name, schema in publish.TARGET_SCHEMAS.items():
        got = [(f.name, f.dataType) for f in wh.tables()[name].schema.fields]
        assert got == [(f.name, f.dataType) for f in schema.fields], name
    seed = wh.product.filter("productid = 1").first()
    assert (seed.product_name, seed.status, seed.product_type) == ("undefined", "inactive", None)
    assert wh.room.filter("roomid = 1").first().room_name == "Unknown room"
    assert wh.member.agg(F.min("memberid")).first()[0] == 1
    assert wh.time.filter("holiday != 'Not a holiday' or event != 'No event'").count() == 0


def test_keys_dense(loads):
    wh = loads["first"]
    for name, key in (("product", "productid"), ("member", "memberid"), ("room", "roomid"), ("time", "timeid")):
        s = wh.tables()[name].agg(F.min(key), F.max(key), F.count("*"), F.countDistinct(key)).first()
        assert s[0] == 1 and s[1] == s[2] == s[3], name


def test_publish_round_trip(spark, loads, tmp_path):
    root = str(tmp_path / "wh")
    run1 = publish.write_run(spark, loads["first"].tables(), root=root, run_id="r1")
    assert publish.current_run(spark, root) == run1
    back = publish.read_table(spark, "salesfact", root=root)
    assert _rows(back) == _rows(loads["first"].salesfact)
    publish.write_run(spark, {"room": loads["first"].room}, root=root, run_id="r2")
    assert publish.current_run(spark, root) == "r2"
    assert publish.read_table(spark, "salesfact", root=root, run_id="r1").count() == back.count()


def test_shuffle_path_equals_broadcast_path(spark, loads):
    src = loads["src"]
    wh = star.keys_first_load(spark, operational(src, gap=True), src.level_map(gap=True), max_broadcast_rows=0)
    assert _rows(wh.salesfact) == _rows(loads["gap_first"].salesfact)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_fact_plan_shape(spark, loads):
    src = loads["src"]
    op = operational(src)
    wh = loads["first"]
    agg = star.keyed_sales(op, wh.product, wh.member, wh.room)
    plan = _plan(agg)
    # sale data: joined map-side, exactly one exchange (the aggregate by key);
    # no single-partition window; Python only below a broadcast (dimension side)
    sale_side = plan.split("BroadcastExchange")[0]
    assert "SinglePartition" not in sale_side and "Window" not in sale_side
    assert sale_side.count("Exchange hashpartitioning") == 1
    assert "ArrowEvalPython" not in sale_side and "BatchEvalPython" not in sale_side
    # map-side partial aggregate below the exchange: hot keys collapse before the shuffle
    assert sale_side.index("partial_sum") > sale_side.index("Exchange hashpartitioning")


def test_one_large_map_costs_one_shuffle(spark, loads):
    """Only the largest map is beyond the budget: the others stay broadcast,
    sales are shuffled for that join and for the aggregate."""
    src = loads["src"]
    wh = loads["first"]
    op = operational(src)
    counts = sorted(t.count() for t in (op.product, op.room, op.member))
    limit = counts[0] + counts[1]
    agg = star.keyed_sales(op, wh.product, wh.member, wh.room, max_broadcast_rows=limit)
    plan = agg._jdf.queryExecution().sparkPlan().toString()
    # the sale spine: everything above the scan of lineitem
    spine = plan[:plan.index("lineitem")]
    assert spine.count("SortMergeJoin") == 1
    assert spine.count("partial_sum(price") == 1
    # a third of all sales on one member, in that same plan
    hot = replace(op, sale=op.sale.withColumn(
        "member_id", F.when(F.xxhash64("product_id", "ts") % 3 == 0, F.lit(1)).otherwise(F.col("member_id")).cast(
            op.sale.schema["member_id"].dataType)))
    a = star.keyed_sales(hot, wh.product, wh.member, wh.room, max_broadcast_rows=limit)
    b = star.keyed_sales(hot, wh.product, wh.member, wh.room)
    assert _rows(a) == _rows(b)


def _counted(spark, op):
    """The same sources, and a counter of the sale rows that are read."""
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    return replace(op, sale=op.sale.mapInArrow(count, op.sale.schema)), read


def test_two_stage_reads_sales_once(spark, loads):
    op = operational(loads["src"])
    n = op.sale.count()
    counted, read = _counted(spark, op)
    names = op.product.select("name")
    staged = staged_sales(sales_aggregated(counted.sale, op.product, op.room, op.member), names=names)
    staged.collect()
    assert read.value == n
    reaggregate(staged).collect()
    assert read.value == 2 * n
    wh = star.two_stage_load(spark, counted, loads["src"].level_map())
    wh.salesfact.collect()
    assert read.value == 3 * n
    wh.release()


def test_names_outside_the_given_ones_fail(spark):
    df = spark.createDataFrame([("<b>A</b>",), (None,), ("B",)], "name string")
    known = spark.createDataFrame([("<b>A</b>",), ("B",)], "name string")
    assert {r.name for r in canonical_names(df, "name", names=known).collect()} == {"A", "B", None}
    with pytest.raises(Exception, match="outside the given names"):
        canonical_names(df, "name", names=known.limit(1)).collect()


def test_keys_first_keeps_nothing_and_drops_orphans_like_two_stage(spark, loads):
    src = loads["src"]
    op = operational(src)
    # a sale of a room that does not exist, at a moment of its own
    orphan = op.sale.limit(1).withColumn("room_id", F.lit(-1).cast(op.sale.schema["room_id"].dataType)).withColumn(
        "ts", F.lit("1999-01-01 12:00:00").cast(op.sale.schema["ts"].dataType))
    bad = replace(op, sale=op.sale.unionByName(orphan))
    first = star.keys_first_load(spark, bad, src.level_map())
    two = star.two_stage_load(spark, bad, src.level_map())
    assert first.kept == ()
    for name in ("time", "salesfact"):
        assert _rows(getattr(first, name)) == _rows(getattr(two, name)) == _rows(getattr(loads["first"], name))
    two.release()


@pytest.mark.parametrize("load", [star.keys_first_load, star.two_stage_load])
def test_load_options(spark, loads, load):
    src = loads["src"]
    wh = load(spark, operational(src), src.level_map(), insert_only_product=True, pad_day_name=True)
    days = {(r.day_of_week, r.is_weekday) for r in wh.time.collect()}
    assert {len(d) for d, _ in days} == {9}
    assert {d for d, flag in days if flag == "Yes"} <= {"Wednesday"}
    rows = star.product_rows(operational(src), src.level_map())
    first = {r.product_name: r.s for r in rows.groupBy("product_name").agg(F.min_by("status", "id").alias("s")).collect()}
    got = {r.product_name: r.status for r in wh.product.filter("productid > 1").collect()}
    assert got == first
    wh.release()


def test_names_that_clean_to_one_merge(spark):
    cols = ("year int, month int, season string, day int, day_of_week string, time_of_day string, "
            "product_name string, room_name string, gender string, is_active boolean, "
            "kroner_sales decimal(10,2), unit_sales long")
    base = (2024, 1, "Winter", 1, "Monday", "Noon")
    rows = [base + ("<b>A</b> &amp; B", "Hall", "M", True, Decimal("1.50"), 1),
            base + ("A & B", "Hall", "M", True, Decimal("2.25"), 2)]
    staged = staged_sales(spark.createDataFrame(rows, cols))
    assert sorted(r.product_name for r in staged.collect()) == ["A & B", "A & B"]
    merged = reaggregate(staged).collect()
    assert len(merged) == 1 and merged[0].kroner_sales == Decimal("3.75") and merged[0].unit_sales == 3
    assert merged[0].gender == "Male"


def test_missing_product_policies(spark, loads):
    src = loads["src"]
    op = operational(src, gap=True)
    with pytest.raises(Exception, match="no product member"):
        star.two_stage_load(spark, op, src.level_map(gap=True), on_missing_product="error").salesfact.collect()
    nulls = star.two_stage_load(spark, op, src.level_map(gap=True), on_missing_product="null").salesfact
    assert nulls.filter("productid is null").count() > 0


def test_job_from_parquet_tables(spark, loads, tmp_path):
    from starloom.plans import job

    src = loads["src"]
    op = operational(src)
    tables_dir = tmp_path / "oltp"
    for name in job.OPERATIONAL:
        getattr(op, name).write.parquet(str(tables_dir / name))
    run_id, report = job.run(spark, job.operational_from(spark, str(tables_dir)), src.level_map(),
                             str(tmp_path / "wh"))
    assert report and all(r["violations"] == 0 for r in report)
    fact = publish.read_table(spark, "salesfact", root=str(tmp_path / "wh"), run_id=run_id)
    assert _rows(fact) == _rows(loads["first"].salesfact)


def test_sales_aggregated_paths_agree(spark, loads):
    src = loads["src"]
    a = sales_aggregated(src.sale, src.product, src.room, src.member)
    b = sales_aggregated(src.sale, src.product, src.room, src.member, max_broadcast_rows=0)
    assert a.schema == b.schema
    assert _rows(a) == _rows(b)
