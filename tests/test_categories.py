from pyspark.sql import functions as F

from starloom.operators import categories as cat
from starloom.sources.fixtures import Sources

from conftest import SF_SMALL

LEVELS = {"product_type": ["Drikke", "Events"], "category": ["Sodavand", "Kaffe"], "subcategory": ["Øl"]}


def _bridged(spark, rows):
    return spark.createDataFrame(rows, "id long, pname string, cname string, active boolean, alcohol_content_ml double")


def _rows(spark):
    # product 1: no category; 2: one; 3: three; 4: four (the 4th, by name, is dropped);
    # 5: two on the same level (the later one wins) plus an unknown name
    return _bridged(spark, [
        (2, "p2", "Kaffe", True, 0.0),
        (3, "p3", "Drikke", True, 0.0), (3, "p3", "Sodavand", True, 0.0), (3, "p3", "Øl", True, 0.0),
        (4, "p4", "Drikke", True, 0.0), (4, "p4", "Events", True, 0.0), (4, "p4", "Kaffe", True, 0.0),
        (4, "p4", "Sodavand", True, 0.0),
        (5, "p5", "Kaffe", True, 0.0), (5, "p5", "Mystery", True, 0.0), (5, "p5", "Sodavand", True, 0.0),
    ])


def test_pivot_and_dropped(spark):
    ranked = cat.rank_categories(_rows(spark))
    piv = {r.id: (r.cat_01, r.cat_02, r.cat_03) for r in cat.pivot_categories(ranked).collect()}
    assert piv[2] == ("Kaffe", None, None)
    assert piv[3] == ("Drikke", "Sodavand", "Øl")
    assert piv[4] == ("Drikke", "Events", "Kaffe")
    assert 1 not in piv
    assert [tuple(r) for r in cat.dropped_count(ranked).collect()] == [(4, 1)]


def test_route_direct_equals_route_pivoted(spark):
    ranked = cat.rank_categories(_rows(spark))
    levels = cat.level_map(spark, LEVELS)
    direct = cat.route_categories(ranked, levels, k=cat.MAX_CATEGORIES)
    pivoted = cat.route_pivoted(cat.pivot_categories(ranked), LEVELS)
    cols = ["id", "product_type", "category", "subcategory"]
    assert sorted(map(tuple, direct.select(cols).collect())) == sorted(map(tuple, pivoted.select(cols).collect()))
    got = {r.id: (r.product_type, r.category, r.subcategory) for r in direct.collect()}
    assert got[3] == ("Drikke", "Sodavand", "Øl")
    assert got[4] == ("Events", "Kaffe", None)     # Drikke then Events: later wins
    assert got[5] == (None, "Sodavand", None)      # Kaffe then Sodavand; Mystery ignored
    whole = {r.id: (r.product_type, r.category, r.subcategory) for r in cat.route_categories(ranked, levels).collect()}
    assert whole[4] == ("Events", "Sodavand", None)  # the fourth category counts too
    assert {k: v for k, v in whole.items() if k != 4} == {k: v for k, v in got.items() if k != 4}


def test_fixture_reaches_the_routing_rules(spark):
    src = Sources(spark, SF_SMALL)
    ranked = cat.rank_categories(cat.bridge_join(src.product, src.category(), src.product_categories()))
    top = cat.topk_per_group(ranked.drop("rn"), ["id", "pname"], [F.col("cname").asc_nulls_first()], cat.MAX_CATEGORIES)
    assert top.count() < ranked.count()
    assert ranked.filter(F.col("cname") == "Seasonal").count() > 0
    two = ranked.filter(F.col("cname").isin("S", "M", "L", "XL")).groupBy("id").count().filter("count > 1")
    assert two.count() > 0


def test_topk_per_group(spark):
    top = cat.topk_per_group(_rows(spark), ["id"], [F.col("cname")], 2)
    counts = {r.id: r["count"] for r in top.groupBy("id").count().collect()}
    assert counts == {2: 1, 3: 2, 4: 2, 5: 2}


def test_default_level_table(spark):
    lm = cat.level_map(spark)
    assert lm.count() == 13
    assert lm.filter("level = 'subcategory'").count() == 4
