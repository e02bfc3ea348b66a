"""Nothing is lost silently, both plans fail alike, and a run that breaks a
constraint is not published."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from starloom.operators.keys import assign_keys
from starloom.plans import job, publish, star
from starloom.plans.catalog import operational
from starloom.sources.fixtures import Sources

from conftest import SF_SMALL

PLANS = [star.keys_first_load, star.two_stage_load]


@pytest.fixture(scope="module")
def source(spark):
    src = Sources(spark, SF_SMALL)
    return operational(src), src.level_map()


@pytest.mark.parametrize("load", PLANS)
def test_sale_without_timestamp_fails(spark, source, load):
    op, levels = source
    lost = op.sale.limit(1).withColumn("ts", F.lit(None).cast("timestamp"))
    bad = replace(op, sale=op.sale.unionByName(lost))
    with pytest.raises(Exception):
        load(spark, bad, levels).salesfact.collect()


@pytest.mark.parametrize("load", PLANS)
def test_error_policy_concerns_sold_products_only(spark, source, load):
    op, levels = source
    new = op.product.limit(1).withColumns({"id": F.lit(10**9).cast(op.product.schema["id"].dataType), "name": F.lit("never sold")})
    unsold = replace(op, product=op.product.unionByName(new))
    n = op.sale.count()
    try:
        without = load(spark, op, levels, "error").salesfact.agg(F.sum("unit_sales")).first()[0]
    except Exception:
        with pytest.raises(Exception):  # the fixture itself sells such a product
            load(spark, unsold, levels, "error").salesfact.collect()
    else:
        assert without == n
        assert load(spark, unsold, levels, "error").salesfact.agg(F.sum("unit_sales")).first()[0] == n
    sold = replace(unsold, sale=op.sale.unionByName(op.sale.limit(1).withColumn("product_id", F.lit(10**9).cast(op.sale.schema["product_id"].dataType))))
    with pytest.raises(Exception):
        load(spark, sold, levels, "error").salesfact.collect()


def test_tied_keys_do_not_depend_on_size_or_partitions(spark):
    rows = spark.range(400).select((F.col("id") % 10).alias("k"), F.col("id").alias("v"), F.lit(None).cast("string").alias("n"))
    want = {(r.k, r.v): i for i, r in enumerate(sorted(rows.collect()), 1)}
    for partitions, local in ((None, 1000), (1, 0), (4, 0), (200, 0)):
        got = assign_keys(rows.repartition(7), ["k"], num_partitions=partitions, local_max_rows=local)
        assert {(r.k, r.v): r.id for r in got.collect()} == want


def test_job_keeps_the_callers_cache_and_publishes_clean_runs_only(spark, source, tmp_path):
    op, levels = source
    mine = spark.range(5).cache()
    mine.count()
    root = str(tmp_path / "wh")
    first, report = job.run(spark, op, levels, root)
    assert publish.current_run(spark, root) == first
    assert mine.storageLevel.useMemory
    mine.unpersist()
    assert {r["check"] for r in report} >= {"primary_key", "natural_key", "foreign_key", "not_null", "max_length", "decimal_range"}
    long_name = F.when(F.col("id") == op.room.agg(F.min("id")).first()[0], F.lit("x" * 101)).otherwise(F.col("name"))
    second, report = job.run(spark, replace(op, room=op.room.withColumn("name", long_name)), levels, root)
    assert any(r["violations"] for r in report if r["check"] == "max_length")
    assert second != first and publish.current_run(spark, root) == first
