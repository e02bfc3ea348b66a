import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starloom import schemas
from starloom.operators.dims import (
    DimensionSpec,
    dim_ensure,
    dim_insert,
    empty_dimension,
    lookup,
    scd1_upsert,
    seed_members,
)
from starloom.operators.facts import PRODUCT_SPEC, ROOM_SPEC
from starloom.operators.keys import assign_keys, next_key
from starloom.plans import star

from conftest import SF_MID


@pytest.mark.parametrize("n", [1, 4, 50, 200])
def test_assign_keys_matches_row_number(spark, n):
    li = spark.read.parquet(f"{SF_MID}/lineitem.parquet").select("l_orderkey", "l_linenumber").distinct()
    keyed = assign_keys(li, ["l_orderkey", "l_linenumber"], key="id", num_partitions=n, local_max_rows=0)
    ref = li.withColumn("rid", F.row_number().over(W.orderBy("l_orderkey", "l_linenumber")))
    assert keyed.join(ref, ["l_orderkey", "l_linenumber"]).filter("id != rid").count() == 0
    stats = keyed.agg(F.min("id"), F.max("id"), F.countDistinct("id"), F.count("*")).first()
    assert tuple(stats) == (1, 45832, 45832, 45832)


@pytest.mark.parametrize("local", [0, 100])
def test_assign_keys_nulls_first_and_start(spark, local):
    df = spark.createDataFrame([("b",), (None,), ("a",)], "k string")
    got = sorted((r.id, r.k) for r in assign_keys(df, ["k"], key="id", start=10, local_max_rows=local).collect())
    assert got == [(10, None), (11, "a"), (12, "b")]


def test_small_and_distributed_paths_agree(spark):
    li = spark.read.parquet(f"{SF_MID}/lineitem.parquet").select("l_orderkey", "l_linenumber").distinct()
    a = assign_keys(li, ["l_orderkey", "l_linenumber"], key="id", num_partitions=7, local_max_rows=0)
    b = assign_keys(li, ["l_orderkey", "l_linenumber"], key="id")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("local", [0, 100])
def test_assign_keys_empty(spark, local):
    df = spark.createDataFrame([], "k string")
    assert assign_keys(df, ["k"], local_max_rows=local).count() == 0


SPEC = DimensionSpec("d", "key", ["name", "status", "size"], ["name"], type1=("status",))
SCHEMA = "key long, name string, status string, size double"


def _dim(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_scd1_same_name_first_attrs_last_status(spark):
    rows = spark.createDataFrame([(1, "A", "active", 1.0), (2, "A", "inactive", 2.0)],
                                 "id long, name string, status string, size double")
    dim = scd1_upsert(_dim(spark, []), rows, SPEC, seq="id")
    assert [tuple(r) for r in dim.collect()] == [(1, "A", "inactive", 1.0)]


def test_scd1_overwrites_only_type1(spark):
    base = _dim(spark, [(1, "A", "active", 1.0), (2, "B", "active", 5.0)])
    rows = spark.createDataFrame([(7, "A", "inactive", 9.0), (8, "C", "active", 3.0)],
                                 "id long, name string, status string, size double")
    got = sorted(tuple(r) for r in scd1_upsert(base, rows, SPEC, seq="id").collect())
    assert got == [(1, "A", "inactive", 1.0), (2, "B", "active", 5.0), (3, "C", "active", 3.0)]


def test_dim_ensure_is_idempotent_and_first_wins(spark):
    rows = spark.createDataFrame([(2, "A", "x", 2.0), (1, "A", "y", 1.0), (3, "B", "z", 3.0)],
                                 "id long, name string, status string, size double")
    once = dim_ensure(_dim(spark, []), rows, SPEC, seq="id")
    twice = dim_ensure(once, rows, SPEC, seq="id")
    assert sorted(tuple(r) for r in once.collect()) == [(1, "A", "y", 1.0), (2, "B", "z", 3.0)]
    assert sorted(tuple(r) for r in twice.collect()) == sorted(tuple(r) for r in once.collect())


def test_dim_insert_keeps_duplicates_and_lookup_takes_smallest(spark):
    seed = seed_members(spark, [star.ROOM_SEED], schemas.ROOM)
    rooms = spark.createDataFrame([(10, "Hall"), (11, "Hall"), (12, "Bar")], "id long, room_name string")
    dim = dim_insert(seed, rooms, ROOM_SPEC, order=["id"])
    assert sorted(tuple(r) for r in dim.collect()) == [(1, "Unknown room"), (2, "Hall"), (3, "Hall"), (4, "Bar")]
    facts = spark.createDataFrame([("Hall",), ("Bar",), ("Nowhere",)], "room_name string")
    got = {r.room_name: r.roomid for r in lookup(facts, dim, ROOM_SPEC, "default").collect()}
    assert got == {"Hall": 2, "Bar": 4, "Nowhere": 1}


def test_lookup_policies(spark):
    dim = spark.createDataFrame([(1, "undefined"), (2, "Cola")], "productid long, product_name string")
    spec = DimensionSpec("product", "productid", ["product_name"], ["product_name"], default_id=1)
    facts = spark.createDataFrame([("Cola",), ("Beer",), (None,)], "product_name string")
    got = [r.productid for r in lookup(facts, dim, spec, "default").orderBy(F.col("product_name").asc_nulls_last()).collect()]
    assert got == [1, 2, 1]
    got = [r.productid for r in lookup(facts, dim, spec, "null").orderBy(F.col("product_name").asc_nulls_last()).collect()]
    assert got == [None, 2, None]
    with pytest.raises(Exception, match="no product member"):
        lookup(facts, dim, spec, "error").collect()
    with pytest.raises(ValueError):
        lookup(facts, dim, DimensionSpec("m", "k", ["a"], ["a"]), "default")


def test_composite_lookup_null_gender_is_missing(spark):
    from starloom.operators.facts import MEMBER_SPEC

    dim = spark.createDataFrame([(1, "Male", True), (2, "Female", False)], "memberid long, gender string, is_active boolean")
    facts = spark.createDataFrame([("Male", True), (None, True)], "gender string, is_active boolean")
    with pytest.raises(Exception, match="no member member"):
        lookup(facts, dim, MEMBER_SPEC, "error").collect()
    assert lookup(facts.limit(1), dim, MEMBER_SPEC, "error").first().memberid == 1


def test_next_key_and_empty_dimension(spark):
    empty = empty_dimension(spark, schemas.ROOM)
    assert empty.count() == 0 and next_key(empty, "roomid") == 1
    seed = seed_members(spark, [star.PRODUCT_SEED], schemas.PRODUCT)
    r = seed.first()
    assert (r.productid, r.product_name, r.product_type, r.status, r.alcohol_content_ml) == (1, "undefined", None, "inactive", 0.0)
    assert next_key(seed, "productid") == 2


def test_product_spec_is_the_declared_one():
    assert PRODUCT_SPEC.lookup == ["product_name"] and tuple(PRODUCT_SPEC.type1) == ("status",)


def test_salted_lookup_matches_plain(spark, monkeypatch):
    import starloom.operators.dims as D

    dim = spark.createDataFrame([(i, f"n{i}") for i in range(1, 6)], "productid long, product_name string")
    spec = DimensionSpec("product", "productid", ["product_name"], ["product_name"], default_id=1)
    # one hot name holds most fact rows; one name is missing
    facts = spark.createDataFrame([("n2", i) for i in range(200)] + [("n3", 1), ("zz", 2)], "product_name string, v long")
    plain = sorted(tuple(r) for r in lookup(facts, dim, spec, "default").collect())
    monkeypatch.setattr(D, "sized", lambda df, *a, **k: (df, False))  # force the shuffle path
    salted = sorted(tuple(r) for r in lookup(facts, dim, spec, "default", salt=8).collect())
    assert salted == plain and len(salted) == 202


def test_null_safe_composite_lookup(spark):
    from starloom.operators.facts import MEMBER_SPEC

    dim = spark.createDataFrame([(1, "Male", True), (2, None, True)], "memberid long, gender string, is_active boolean")
    facts = spark.createDataFrame([("Male", True, 10), (None, True, 20)], "gender string, is_active boolean, v long")
    got = sorted((r.v, r.memberid) for r in lookup(facts, dim, MEMBER_SPEC, "error", null_safe=True).collect())
    assert got == [(10, 1), (20, 2)]
    assert lookup(facts, dim, MEMBER_SPEC, "null").filter("v = 20").first().memberid is None
