"""Registered queries: one per operator of the inventory.

Every query takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
whole input tables (no sampling, no id subsets). Column names equal those of
the matching SQL oracle in :mod:`starloom.plans.oracles`.
"""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom import schemas
from starloom.functions.html import with_html_text
from starloom.functions.money import money_sum
from starloom.functions.recode import GENDER_CODES, bool_label, fill_defaults, recode
from starloom.functions.timeparts import date_parts, day_name, season, time_of_day, weekday_flag
from starloom.operators import categories as cat
from starloom.operators import checks, lattice, layout
from starloom.operators.dims import (
    DimensionSpec,
    dim_ensure,
    dim_insert,
    lookup,
    scd1_upsert,
    seed_members,
)
from starloom.operators.facts import (
    MEMBER_SPEC,
    PRODUCT_SPEC,
    ROOM_SPEC,
    TIME_SPEC,
    canonical_names,
    reaggregate,
    sales_aggregated,
    staged_sales,
    star_join,
    time_dimension,
)
from starloom.operators.asof import asof_join
from starloom.operators.frames import moving
from starloom.operators.intervals import interval_join
from starloom.operators.joins import anti_join, semi_join
from starloom.operators.keys import assign_keys
from starloom.plans import publish, star
from starloom.plans.difference import difference
from starloom.sources.fixtures import Sources
from starloom.sources.readers import read_insert_script, rename_columns
from starloom.streaming import incremental

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return register


def operational(src: Sources, gap: bool = False) -> star.Operational:
    return star.Operational(sale=src.sale, product=src.product, category=src.category(gap),
                            product_categories=src.product_categories(gap), room=src.room,
                            member=src.member)


def _staged(src: Sources) -> DataFrame:
    sales = sales_aggregated(src.sale, src.product, src.room, src.member)
    return staged_sales(sales, names=src.product.select("name"))


def _ranked(src: Sources, gap: bool = False) -> DataFrame:
    return cat.rank_categories(cat.bridge_join(src.product, src.category(gap), src.product_categories(gap)))


def _product_dim(spark: SparkSession, src: Sources, gap: bool = False) -> DataFrame:
    op, levels = operational(src, gap), src.level_map(gap)
    known = star.source_sizes(op, levels)
    rows = star.product_rows(op, levels, star.product_names(op, known), known)
    return star.product_dimension(spark, rows, at_most=known.product[0])


# -- sources -------------------------------------------------------------------
@query("scan_source")
def scan_source(spark, sf_dir):
    """Room source: SELECT name AS room_name FROM room."""
    return Sources(spark, sf_dir).room.select(F.col("name").alias("room_name"))


@query("scan_renamed")
def scan_renamed(spark, sf_dir):
    """Member source with its output columns renamed positionally."""
    m = Sources(spark, sf_dir).member.select("gender", "active").dropDuplicates()
    return rename_columns(m, ["gender", "is_active"])


@query("member_distinct")
def member_distinct(spark, sf_dir):
    return Sources(spark, sf_dir).member.select("gender", "active").distinct()


@query("project_alias")
def project_alias(spark, sf_dir):
    p = Sources(spark, sf_dir).product
    return p.select("id", F.col("name").alias("pname"), "active", "alcohol_content_ml")


# -- scalar functions ----------------------------------------------------------
@query("date_parts")
def q_date_parts(spark, sf_dir):
    e = Sources(spark, sf_dir).table("events")
    return e.select("event_id", *date_parts("ts"))


@query("day_name")
def q_day_name(spark, sf_dir):
    e = Sources(spark, sf_dir).table("events")
    return e.select("event_id", day_name("ts").alias("day_of_week"))


@query("time_of_day_bucket")
def q_time_of_day(spark, sf_dir):
    e = Sources(spark, sf_dir).table("events")
    return e.select("event_id", F.hour("ts").alias("hour"), time_of_day("ts").alias("time_of_day"))


@query("season_bucket")
def q_season(spark, sf_dir):
    o = Sources(spark, sf_dir).table("orders")
    return o.select("o_orderkey", F.month("o_orderdate").alias("month"), season("o_orderdate").alias("season"))


@query("weekday_flag")
def q_weekday_flag(spark, sf_dir):
    e = Sources(spark, sf_dir).table("events").select("event_id", day_name("ts").alias("day_of_week"))
    return e.select("event_id", "day_of_week", weekday_flag("day_of_week").alias("is_weekday"))


@query("bool_label")
def q_bool_label(spark, sf_dir):
    p = Sources(spark, sf_dir).product
    return p.select("id", "active", bool_label("active").alias("status"))


@query("recode_dict")
def q_recode_dict(spark, sf_dir):
    m = Sources(spark, sf_dir).member
    return m.select("id", recode("gender", GENDER_CODES, "error", name="gender code").alias("gender"))


# Segment labels for the default-policy recode; one segment is
# deliberately left out of the map.
SEGMENT_LABELS = {"BUILDING": "Building", "MACHINERY": "Machinery", "FURNITURE": "Furniture",
                  "HOUSEHOLD": "Household"}
SEGMENT_DEFAULT = "Other"


@query("recode_default")
def q_recode_default(spark, sf_dir):
    c = Sources(spark, sf_dir).table("customer")
    return c.select("c_custkey", recode("c_mktsegment", SEGMENT_LABELS, "default",
                                        SEGMENT_DEFAULT).alias("segment"))


@query("html_text")
def q_html_text(spark, sf_dir):
    pages = Sources(spark, sf_dir).table("pages").select("page_id", "html")
    return with_html_text(pages, "html", "text").select("page_id", "text")


@query("canonical_names")
def q_canonical_names(spark, sf_dir):
    p = Sources(spark, sf_dir).product.select("id", "name")
    return canonical_names(p, "name", out="clean_name")


# -- bridge, window, pivot, routing ---------------------------------------------
@query("bridge_join")
def q_bridge_join(spark, sf_dir):
    src = Sources(spark, sf_dir)
    return cat.bridge_join(src.product, src.category(), src.product_categories())


@query("rank_in_group")
def q_rank_in_group(spark, sf_dir):
    return _ranked(Sources(spark, sf_dir)).select("id", "pname", "cname", "rn")


@query("topk_per_group")
def q_topk(spark, sf_dir):
    src = Sources(spark, sf_dir)
    bridged = cat.bridge_join(src.product, src.category(), src.product_categories())
    return cat.topk_per_group(bridged, ["id", "pname"], [F.col("cname").asc_nulls_first()],
                              cat.MAX_CATEGORIES).select("id", "cname", "rn")


@query("category_pivot")
def q_category_pivot(spark, sf_dir):
    return cat.pivot_categories(_ranked(Sources(spark, sf_dir)))


@query("category_route")
def q_category_route(spark, sf_dir):
    src = Sources(spark, sf_dir)
    routed = cat.route_categories(_ranked(src), src.level_map())
    return routed.select("id", "product_type", "category", "subcategory")


@query("fill_defaults")
def q_fill_defaults(spark, sf_dir):
    src = Sources(spark, sf_dir)
    routed = cat.route_categories(_ranked(src), src.level_map())
    return fill_defaults(routed).select("id", "product_type", "category", "subcategory")


# -- joins and aggregates --------------------------------------------------------
@query("star_join")
def q_star_join(spark, sf_dir):
    src = Sources(spark, sf_dir)
    j = star_join(src.sale, src.product, src.room, src.member)
    return j.select("product_id", "room_id", "member_id", "price", F.hour("ts").alias("sale_hour"),
                    "p_name", "r_name", "gender", "active")


@query("sales_aggregated")
def q_sales_aggregated(spark, sf_dir):
    src = Sources(spark, sf_dir)
    return sales_aggregated(src.sale, src.product, src.room, src.member)


@query("money_sum")
def q_money_sum(spark, sf_dir):
    s = Sources(spark, sf_dir).sale
    return s.groupBy("room_id").agg(money_sum("price").alias("kroner_sales"))


@query("staged_sales")
def q_staged(spark, sf_dir):
    return _staged(Sources(spark, sf_dir))


@query("reaggregate_staging")
def q_reaggregate(spark, sf_dir):
    return reaggregate(_staged(Sources(spark, sf_dir)))


# -- keys and dimensions ---------------------------------------------------------
@query("surrogate_keys")
def q_surrogate_keys(spark, sf_dir):
    li = Sources(spark, sf_dir).table("lineitem").select("l_orderkey", "l_linenumber").distinct()
    return assign_keys(li, ["l_orderkey", "l_linenumber"], key="id")


@query("surrogate_keys_tied")
def q_surrogate_keys_tied(spark, sf_dir):
    """Keys by supplier alone: its many ties follow the remaining columns."""
    li = Sources(spark, sf_dir).table("lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey")
    return assign_keys(li, ["l_suppkey"], key="id")


@query("dim_member")
def q_dim_member(spark, sf_dir):
    return star.member_dimension(spark, Sources(spark, sf_dir).member)


@query("dim_room")
def q_dim_room(spark, sf_dir):
    return star.room_dimension(spark, Sources(spark, sf_dir).room)


@query("dim_insert")
def q_dim_insert(spark, sf_dir):
    """A second, unconditional insert of the same rooms: duplicates kept."""
    src = Sources(spark, sf_dir)
    first = star.room_dimension(spark, src.room)
    rows = src.room.select("id", F.col("name").alias("room_name"))
    return dim_insert(first, rows, ROOM_SPEC, order=["id"])


CATEGORY_SPEC = DimensionSpec("category", "id", ["name"], ["name"])
CATEGORY_NAME = T.StructType([T.StructField("name", T.StringType(), True)])


@query("dim_append_members")
def q_dim_append(spark, sf_dir):
    """Category table plus two reference names appended after the last id."""
    src = Sources(spark, sf_dir)
    extra = seed_members(spark, [{"name": n} for n in star.EXTRA_CATEGORIES], CATEGORY_NAME)
    return dim_insert(src.category(), extra, CATEGORY_SPEC, order=["name"])


@query("default_members")
def q_default_members(spark, sf_dir):
    """Seeded default members as they stand after a full dimension load."""
    src = Sources(spark, sf_dir)
    p = _product_dim(spark, src).filter(F.col("productid") == PRODUCT_SPEC.default_id).select(
        F.lit("product").alias("dimension"), F.col("productid").alias("key"),
        F.col("product_name").alias("name"))
    r = star.room_dimension(spark, src.room).filter(F.col("roomid") == ROOM_SPEC.default_id).select(
        F.lit("room").alias("dimension"), F.col("roomid").alias("key"), F.col("room_name").alias("name"))
    return p.unionByName(r)


@query("scd1_product")
def q_scd1_product(spark, sf_dir):
    return _product_dim(spark, Sources(spark, sf_dir))


@query("scd1_update_existing")
def q_scd1_update(spark, sf_dir):
    """Product rows loaded in two batches split at the middle source id; the
    second batch overwrites the status of names already present."""
    src = Sources(spark, sf_dir)
    rows = star.product_rows(operational(src), src.level_map())
    bounds = src.product.agg(F.min("id").alias("lo"), F.max("id").alias("hi")).collect()[0]
    mid = (bounds["lo"] + bounds["hi"]) // 2
    seed = seed_members(spark, [star.PRODUCT_SEED], schemas.PRODUCT)
    first = scd1_upsert(seed, rows.filter(F.col("id") <= mid), PRODUCT_SPEC, seq="id")
    return scd1_upsert(first, rows.filter(F.col("id") > mid), PRODUCT_SPEC, seq="id")


@query("dim_ensure")
def q_dim_ensure(spark, sf_dir):
    """Insert-only ensure of all product rows into the dimension built from
    the gapped bridge: only the missing names are added."""
    src = Sources(spark, sf_dir)
    base = _product_dim(spark, src, gap=True)
    rows = star.product_rows(operational(src), src.level_map())
    return dim_ensure(base, rows, PRODUCT_SPEC, seq="id")


@query("dim_time")
def q_dim_time(spark, sf_dir):
    return time_dimension(_staged(Sources(spark, sf_dir)))


@query("dim_lookup_single")
def q_lookup_single(spark, sf_dir):
    src = Sources(spark, sf_dir)
    rows = reaggregate(_staged(src))
    f = lookup(rows, _product_dim(spark, src), PRODUCT_SPEC, "error")
    f = lookup(f, star.room_dimension(spark, src.room), ROOM_SPEC, "error")
    return f.select("year", "month", "day", "time_of_day", "product_name", "room_name", "gender",
                    "is_active", "productid", "roomid")


@query("dim_lookup_composite")
def q_lookup_composite(spark, sf_dir):
    src = Sources(spark, sf_dir)
    time = time_dimension(star.sold_moments(operational(src)))
    f = lookup(reaggregate(_staged(src)), time, TIME_SPEC, "error")
    f = lookup(f, star.member_dimension(spark, src.member), MEMBER_SPEC, "error")
    return f.select("year", "month", "day", "time_of_day", "product_name", "room_name", "gender",
                    "is_active", "timeid", "memberid")


@query("dim_lookup_default")
def q_lookup_default(spark, sf_dir):
    """Product lookup against the gapped dimension; misses get key 1."""
    src = Sources(spark, sf_dir)
    rows = reaggregate(_staged(src))
    f = lookup(rows, _product_dim(spark, src, gap=True), PRODUCT_SPEC, "default")
    return f.select("year", "month", "day", "time_of_day", "product_name", "room_name", "gender",
                    "is_active", "productid")


# -- facts -----------------------------------------------------------------------
@query("fact_sales")
def q_fact_sales(spark, sf_dir):
    src = Sources(spark, sf_dir)
    return star.two_stage_load(spark, operational(src), src.level_map()).salesfact


@query("fact_sales_keys_first")
def q_fact_keys_first(spark, sf_dir):
    src = Sources(spark, sf_dir)
    return star.keys_first_load(spark, operational(src), src.level_map()).salesfact


@query("fact_sales_unknown_product")
def q_fact_unknown(spark, sf_dir):
    src = Sources(spark, sf_dir)
    return star.two_stage_load(spark, operational(src, gap=True), src.level_map(gap=True)).salesfact


@query("star_rollup")
def q_star_rollup(spark, sf_dir):
    src = Sources(spark, sf_dir)
    return star.star_rollup(star.keys_first_load(spark, operational(src), src.level_map()))


@query("full_reload")
def q_full_reload(spark, sf_dir):
    """A load of the gapped products, then a full one: the second replaces
    every table of the first, and its fact is read back."""
    src = Sources(spark, sf_dir)
    root = f"{publish.output_root(spark)}/reload-{uuid.uuid4().hex}"
    for gap in (True, False):
        wh = star.keys_first_load(spark, operational(src, gap), src.level_map(gap))
        publish.write_run(spark, wh.tables(), root=root)
    return publish.read_table(spark, "salesfact", root=root)


@query("commit_points")
def q_commit_points(spark, sf_dir):
    """Rows per published table, counted after a later run was written but not
    published: readers still see the first run."""
    src = Sources(spark, sf_dir)
    root = f"{publish.output_root(spark)}/commit-{uuid.uuid4().hex}"
    wh = star.keys_first_load(spark, operational(src), src.level_map())
    publish.write_run(spark, wh.tables(), root=root)
    publish.write_run(spark, {t: df.limit(0) for t, df in wh.tables().items()}, root=root, publish=False)
    counts = [publish.read_table(spark, t, root=root).agg(F.count(F.lit(1)).alias("n"))
              .select(F.lit(t).alias("table"), "n") for t in wh.tables()]
    return reduce(DataFrame.unionAll, counts)


@query("bridge_replace")
def q_bridge_replace(spark, sf_dir):
    """Bridge pairs written as a new version of their table and read back."""
    src = Sources(spark, sf_dir)
    return publish.replace_table(spark, src.product_categories(), "product_categories")


# -- joins beyond the star ---------------------------------------------------------
@query("semi_join_bloom")
def q_semi_join_bloom(spark, sf_dir):
    """Sales per product of the products that have a category. The product
    side is taken as beyond the broadcast budget: a Bloom filter of its keys
    drops the other sales before the exchange."""
    src = Sources(spark, sf_dir)
    known = src.bridge_named(gap=True).select("product_id").distinct()
    kept = semi_join(src.sale.select("product_id", "price"), known, ["product_id"], max_rows=0)
    return kept.groupBy("product_id").agg(F.count(F.lit(1)).alias("sales"), F.sum("price").alias("price"))


@query("anti_join_bloom")
def q_anti_join_bloom(spark, sf_dir):
    """Single sales of products without a category; sales that the filter
    does not know pass map-side."""
    src = Sources(spark, sf_dir)
    known = src.bridge_named(gap=True).select("product_id").distinct()
    return anti_join(src.sale.select("product_id", "member_id", "price"), known, ["product_id"], max_rows=0)


@query("interval_join")
def q_interval_join(spark, sf_dir):
    """Events within two hours from each signup (the end is outside)."""
    e = Sources(spark, sf_dir).table("events")
    opened = e.where("event_type = 'signup'").select(F.col("event_id").alias("signup_id"), F.col("ts").alias("opens"), (F.col("ts") + F.expr("interval 2 hours")).alias("closes"))
    near = interval_join(opened, e.select("event_id", "ts", "value"), ("opens", "closes"), ("ts", "ts"), half_open=True, rows="events", sums={"hundredths": F.round(F.col("value") * 100)})
    return near.groupBy("signup_id").agg(F.sum("events").alias("events"), F.sum("hundredths").alias("hundredths"))


@query("interval_join_keyed")
def q_interval_join_keyed(spark, sf_dir):
    """Shipments to a customer while one of the customer's orders is open: from
    its date on for up to 180 days, some for a single day."""
    src = Sources(spark, sf_dir)
    o = src.table("orders").select("o_orderkey", F.col("o_custkey").alias("customer"), F.to_date("o_orderdate").alias("opened"))
    opened = o.withColumn("closed", F.date_add("opened", (F.pmod("o_orderkey", F.lit(181))).cast("int")))
    li = src.table("lineitem").select("l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("shipped"))
    shipped = li.join(o.select(F.col("o_orderkey").alias("l_orderkey"), "customer"), "l_orderkey")
    return interval_join(opened, shipped, ("opened", "closed"), ("shipped", "shipped"), ["customer"]).select("o_orderkey", "l_orderkey", "l_linenumber")


@query("asof_join")
def q_asof_join(spark, sf_dir):
    """The customer's latest order at or before each shipment."""
    src = Sources(spark, sf_dir)
    o = src.table("orders").select(F.col("o_custkey").alias("customer"), F.col("o_orderkey").alias("latest_order"), "o_orderdate")
    li = src.table("lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    shipped = li.join(src.table("orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("customer")), "l_orderkey")
    return asof_join(shipped, o, ["customer"], "l_shipdate", "o_orderdate", seq=["latest_order"]).select("l_orderkey", "l_linenumber", "latest_order", "o_orderdate")


@query("asof_join_strict")
def q_asof_join_strict(spark, sf_dir):
    """The user's latest purchase strictly before each event; most first
    events have none."""
    e = Sources(spark, sf_dir).table("events")
    bought = e.where("event_type = 'purchase'").select("user_id", F.col("event_id").alias("purchase_id"), F.col("ts").alias("purchased"))
    return asof_join(e.select("event_id", "user_id", "ts"), bought, ["user_id"], "ts", "purchased", seq=["purchase_id"], allow_exact=False).select("event_id", "purchase_id", "purchased")


# -- rollups and frames ------------------------------------------------------------
def _dated_sales(src: Sources) -> DataFrame:
    ts = F.col("ts")
    return src.sale.select(F.year(ts).alias("year"), F.month(ts).alias("month"), F.dayofmonth(ts).alias("day"), "room_id", "product_id", "member_id", "price")


@query("grouping_lattice")
def q_grouping_lattice(spark, sf_dir):
    """Day, month and year by room and product, with totals."""
    sets = [("year", "month", "day", "room_id", "product_id"), ("year", "month", "room_id"), ("year", "month", "product_id"), ("year", "month", "day"), ("year", "room_id"), ("year", "product_id"),
            ("year", "month"), ("room_id",), ("product_id",), ("year",), ()]
    price = F.col("price")
    measures = [lattice.rows("unit_sales"), lattice.total("total", price), lattice.least("lowest", price), lattice.largest("highest", price), lattice.average("mean", price)]
    return lattice.grouping_sets(_dated_sales(Sources(spark, sf_dir)), sets, measures)


@query("distinct_rollup")
def q_distinct_rollup(spark, sf_dir):
    """Members that bought in each month: exactly, and whether the estimate
    merged from the sketches of the fact grain (month, room) is within four
    standard errors."""
    sales = _dated_sales(Sources(spark, sf_dir))
    m = [lattice.distinct_estimate("estimate", F.col("member_id"))]
    rolled = lattice.rolled_up(lattice.partials(sales, ["year", "month", "room_id"], m), ["year", "month"], m)
    exact = sales.groupBy("year", "month").agg(F.count_distinct("member_id").alias("members"))
    error = F.greatest(F.lit(2.0), F.lit(4 * 1.04 / 2 ** (lattice.LG_K / 2)) * F.col("members"))
    return exact.join(rolled, ["year", "month"]).select("year", "month", "members", (F.abs(F.col("estimate") - F.col("members")) <= error).alias("within_error"))


@query("quantile_rollup")
def q_quantile_rollup(spark, sf_dir):
    """Price quartiles per room, merged from the sketches of the fact grain
    (month, room): whether all of them are within one percent of their rank."""
    sales = _dated_sales(Sources(spark, sf_dir))
    ranks = (0.25, 0.5, 0.75)
    m = [lattice.quantiles("q", F.col("price"), ranks)]
    rolled = lattice.rolled_up(lattice.partials(sales, ["year", "month", "room_id"], m), ["room_id"], m)
    both = sales.select("room_id", "price").join(rolled, "room_id")
    counts = [F.count_if(F.col("price") < F.col("q")[i]).alias(f"below{i}") for i in range(3)] + [F.count_if(F.col("price") <= F.col("q")[i]).alias(f"upto{i}") for i in range(3)]
    counted = both.groupBy("room_id").agg(F.count(F.lit(1)).alias("sales"), *counts)
    good = F.lit(True)
    for i, rank in enumerate(ranks):
        good = good & (F.col(f"below{i}") <= (rank + 0.01) * F.col("sales")) & (F.col(f"upto{i}") >= (rank - 0.01) * F.col("sales"))
    return counted.select("room_id", "sales", good.alias("within_error"))


@query("moving_frame")
def q_moving_frame(spark, sf_dir):
    """Each sale with the seven-day takings of its room up to its day; rooms
    with more than 250 sales are cut into chunks."""
    sale = Sources(spark, sf_dir).sale.select("room_id", F.to_date("ts").alias("day"), "price")
    return moving(sale, ["room_id"], "day", 6, {"week_price": F.sum("price"), "week_sales": F.count(F.lit(1))}, chunk_rows=250)


# -- versions and layout -----------------------------------------------------------
@query("run_difference")
def q_run_difference(spark, sf_dir):
    """Two published versions of the orders: in the second one some are gone,
    some have another status and some come up twice."""
    src = Sources(spark, sf_dir)
    root = f"{publish.output_root(spark)}/difference-{uuid.uuid4().hex}"
    o = src.table("orders").select("o_orderkey", "o_custkey", "o_orderstatus", F.to_date("o_orderdate").alias("o_date"))
    old = publish.replace_table(spark, o, "orders", root)
    key = F.col("o_orderkey")
    changed = o.where(key % 97 != 0).withColumn("o_orderstatus", F.when(key % 89 == 0, "X").otherwise(F.col("o_orderstatus")))
    new = publish.replace_table(spark, changed.unionByName(o.where((key % 83 == 0) & (key % 97 != 0) & (key % 89 != 0))), "orders", root)
    return difference(old, new, ["o_orderkey"])


@query("clustered_layout")
def q_clustered_layout(spark, sf_dir):
    """Sales written along a curve over (day, product) and read back for a
    quarter of a year and a tenth of the products."""
    src = Sources(spark, sf_dir)
    sale = src.sale.select(F.to_date("ts").alias("day"), "product_id", "room_id", "price")
    path = f"{publish.output_root(spark)}/clustered-{uuid.uuid4().hex}"
    columns = ["day", "product_id"]
    layout.write_clustered(sale, path, columns)
    top = src.product.agg(F.max("id")).first()[0]
    return layout.read_clustered(spark, path, columns, {"day": (datetime.date(1998, 1, 1), datetime.date(1998, 3, 31)), "product_id": (0, top // 10)})


# -- streaming ----------------------------------------------------------------------
@query("incremental_events")
def q_incremental_events(spark, sf_dir):
    """Events loaded as a stream in two parts, then all of them once more:
    takings and events per user and day."""
    e = Sources(spark, sf_dir).table("events").select("event_id", "ts", "user_id", "value")
    root = f"{publish.output_root(spark)}/incremental-{uuid.uuid4().hex}"
    measures = [lattice.rows("events"), lattice.total("hundredths", F.round(F.col("value") * 100).cast("long"))]
    keys = {"user_id": F.col("user_id"), "day": F.to_date("ts")}
    middle = e.agg(F.percentile_approx(F.unix_micros(F.col("ts").cast("timestamp")), 0.5)).first()[0]
    early = F.unix_micros(F.col("ts").cast("timestamp")) <= F.lit(middle)
    for part in (e.where(early), e.where(~early), e):
        part.write.mode("append").parquet(f"{root}/in")
        incremental.load_available(spark, f"{root}/in", e.schema, root, "event_id", "ts", keys, measures, delay="60 days")
    return incremental.totals(spark, root, ["user_id", "day"], measures)


@query("bridge_script")
def q_bridge_script(spark, sf_dir):
    """Bridge pairs written as a script of INSERT statements and read back."""
    src = Sources(spark, sf_dir)
    path = f"{publish.output_root(spark)}/bridge-{uuid.uuid4().hex}"
    statement = F.concat(F.lit("\nINSERT INTO shop.product_categories (product_id, category_id)\n VALUES ("), "product_id", F.lit(", "), "category_id", F.lit(")"))
    src.product_categories().select(statement.alias("value")).write.option("lineSep", ";").text(path)
    return read_insert_script(spark, path, "product_categories", ["product_id", "category_id"])


# -- integrity checks --------------------------------------------------------------
@query("check_pk")
def q_check_pk(spark, sf_dir):
    li = Sources(spark, sf_dir).table("lineitem")
    return checks.duplicate_keys(li, ["l_orderkey", "l_linenumber"])


@query("check_fk")
def q_check_fk(spark, sf_dir):
    src = Sources(spark, sf_dir)
    return checks.missing_references(src.table("documents"), "doc_id", src.table("labels"),
                                     "doc_id").select("doc_id")


@query("check_not_null")
def q_check_not_null(spark, sf_dir):
    src = Sources(spark, sf_dir)
    d = src.table("documents").select("doc_id").join(src.table("labels").select("doc_id", "quality"),
                                                     "doc_id", "left")
    return checks.null_values(d, ["quality"], ["doc_id"])


@query("check_length")
def q_check_length(spark, sf_dir):
    d = Sources(spark, sf_dir).table("documents")
    return checks.too_long(d, {"text": 100}, ["doc_id"])


@query("check_decimal_range")
def q_check_decimal(spark, sf_dir):
    li = Sources(spark, sf_dir).table("lineitem")
    v = li.select("l_orderkey", "l_linenumber", (F.col("l_extendedprice") * 1000).alias("value"))
    return checks.out_of_decimal_range(v, "value", 10, 2, ["l_orderkey", "l_linenumber"])
