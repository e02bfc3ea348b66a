from starloom.operators import checks


def test_duplicate_keys(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (2, 1)], "a long, b long")
    assert [tuple(r) for r in checks.duplicate_keys(df, ["a", "b"]).collect()] == [(1, 1, 2)]


def test_missing_references_ignores_null(spark):
    child = spark.createDataFrame([(1,), (2,), (None,)], "fk long")
    parent = spark.createDataFrame([(1,)], "pk long")
    assert [r.fk for r in checks.missing_references(child, "fk", parent, "pk").collect()] == [2]


def test_null_values(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, 5, None)], "id long, a long, b string")
    got = sorted(tuple(r) for r in checks.null_values(df, ["a", "b"], ["id"]).collect())
    assert got == [(1, "a"), (2, "b")]


def test_too_long_101_characters(spark):
    df = spark.createDataFrame([(1, "x" * 100), (2, "y" * 101)], "id long, name string")
    assert [tuple(r) for r in checks.too_long(df, {"name": 100}, ["id"]).collect()] == [(2, "name", 101)]


def test_decimal_range(spark):
    df = spark.createDataFrame([(1, 99999999.99), (2, 100000000.00), (3, None)], "id long, v double")
    assert [r.id for r in checks.out_of_decimal_range(df, "v", 10, 2, ["id"]).collect()] == [2]


def test_bridge_file_round_trip(spark, tmp_path):
    from starloom.plans import publish
    from starloom.sources.fixtures import Sources
    from starloom.sources.readers import read_pairs

    from conftest import SF_SMALL

    pairs = Sources(spark, SF_SMALL).product_categories()
    path = str(tmp_path / "bridge_csv")
    pairs.write.option("header", "true").csv(path)
    back = read_pairs(spark, path)
    replaced = publish.replace_table(spark, back, "bridge", root=str(tmp_path / "wh"))
    assert sorted(map(tuple, replaced.collect())) == sorted(map(tuple, pairs.collect()))
    # a second replace overwrites instead of appending
    replaced = publish.replace_table(spark, back.limit(5), "bridge", root=str(tmp_path / "wh"))
    assert replaced.count() == 5
