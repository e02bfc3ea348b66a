"""How many jobs a load needs before its first action, and loads whose
references are trusted."""

import pytest
from pyspark.sql import functions as F

from starloom.plans import star
from starloom.plans.catalog import operational
from starloom.sources.fixtures import Sources

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def src(spark, tmp_path_factory):
    """Operational tables as stored tables, as a real load reads them."""
    root = tmp_path_factory.mktemp("oltp")
    views = Sources(spark, SF_SMALL)
    op = operational(views)
    tables = {n: getattr(op, n) for n in ("sale", "product", "category", "product_categories", "room", "member")} | {"levels": views.level_map()}
    for name, df in tables.items():
        df.write.parquet(str(root / name))
    read = {name: spark.read.parquet(str(root / name)) for name in tables}
    levels = read.pop("levels")
    return star.Operational(**read), levels


def test_load_needs_few_jobs(spark, src):
    sc = spark.sparkContext
    sc.setJobGroup("load-jobs", "load")
    try:
        star.keys_first_load(spark, *src)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert 0 < len(sc.statusTracker().getJobIdsForGroup("load-jobs")) <= 36


def _rows(wh):
    return {name: sorted(map(repr, df.collect())) for name, df in wh.tables().items()}


def test_trusted_load_equals_checked_load(spark, src):
    assert _rows(star.keys_first_load(spark, *src, trusted=True)) == _rows(star.keys_first_load(spark, *src))


def test_trusted_moments_read_the_time_alone(spark, src):
    plan = star.sold_moments(src[0], trusted=True)._jdf.queryExecution().executedPlan().toString()
    schemas = [line for line in plan.splitlines() if "ReadSchema" in line]
    assert len(schemas) == 1 and "struct<ts:" in schemas[0] and "_id" not in schemas[0]
    assert "Join" not in plan


@pytest.mark.parametrize("column", ["product_id", "room_id", "member_id"])
def test_trusted_load_fails_on_an_unknown_reference(spark, src, column):
    op, levels = src
    broken = star.Operational(**{**vars(op), "sale": op.sale.withColumn(column, F.when(F.col("price") % 97 == 0, -1).otherwise(F.col(column)))})
    wh = star.keys_first_load(spark, broken, levels, trusted=True)
    with pytest.raises(Exception, match="unknown reference"):
        wh.salesfact.collect()
    checked = star.keys_first_load(spark, broken, levels).salesfact
    assert checked.agg(F.sum("unit_sales")).first()[0] == op.sale.where("price % 97 <> 0").count()


def test_ensure_needs_an_order_for_attributes(spark):
    from starloom.operators.dims import DimensionSpec, dim_ensure

    spec = DimensionSpec("d", "id", ["name", "other"], ["name"])
    rows = spark.createDataFrame([("a", 1), ("a", 2)], "name string, other int")
    dim = rows.limit(0).select(F.lit(0).cast("long").alias("id"), "name", "other")
    with pytest.raises(ValueError, match="seq"):
        dim_ensure(dim, rows, spec)
    assert [tuple(r) for r in dim_ensure(dim, rows, spec, seq="other").collect()] == [(1, "a", 1)]


def test_sales_are_joined_once(spark, src):
    """With key maps beyond the budget, fact and time members come from the
    stored aggregate, not from the sale tables again."""
    wh = star.keys_first_load(spark, *src, max_broadcast_rows=0)
    files = wh.salesfact.inputFiles()
    assert files and all("/stored-" in f for f in files)
    assert _rows(wh) == _rows(star.keys_first_load(spark, *src))


def test_wide_sides_are_added_after_the_shuffles(spark):
    from starloom.operators.joins import join_sides

    big = spark.createDataFrame([(1, 2, 3, 5)], "a long, b long, c long, price long")
    sides = {"a": spark.createDataFrame([(1, "wide")], "a long, name string"), "b": spark.createDataFrame([(2, "x" * 40)], "b long, label string"),
             "c": spark.createDataFrame([(3, "F")], "c long, gender string")}
    measured = [(10, 1_000), (5_000_000, 200_000_000), (4_000_000, 36_000_000)]
    joined = join_sides(big, sides, measured=measured)
    assert joined.columns[:3] == ["a", "b", "c"]  # the last join's key comes first
    assert [tuple(r) for r in joined.select("price", "name", "label", "gender").collect()] == [(5, "wide", "x" * 40, "F")]
