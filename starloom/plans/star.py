"""The flagship job: operational tables -> four dimensions + one fact table.

Two equivalent plans are offered:

* :func:`two_stage_load` follows the original job: aggregate sales at the
  10-column grain, stage them (names cleaned, codes recoded), aggregate the
  staged rows again, resolve the four keys and regroup by key.
* :func:`keys_first_load` resolves source ids to surrogate keys on the
  dimension side first (small, broadcast maps) and aggregates the sale table
  once, by key, with map-side partial aggregation. One shuffle of sale data
  instead of three; equal results because money is kept in integer
  hundredths until the end and season/weekday are functions of the date.

Both take ``insert_only_product`` (existing and repeated products keep the
status they came with first) and ``pad_day_name`` (weekdays blank-padded to nine
characters; the weekday flag then holds for Wednesday only).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom import schemas
from starloom.functions.money import hundredths_to_money
from starloom.functions.recode import GENDER_CODES, bool_label, fill_defaults, recode
from starloom.functions.timeparts import time_of_day_code, time_of_day_label
from starloom.operators import categories as cat
from starloom.operators.dims import (
    conform,
    dim_ensure,
    dim_insert,
    empty_dimension,
    lookup,
    scd1_upsert,
    seed_members,
)
from starloom.operators.facts import (
    FACT_KEYS,
    MEMBER_SPEC,
    PRODUCT_SPEC,
    ROOM_SPEC,
    TIME_LOOKUP,
    TIME_SPEC,
    canonical_names,
    load_facts,
    reaggregate,
    sales_aggregated,
    staged_sales,
    time_dimension,
)
from starloom.operators.joins import all_fit, join_sides, sizes, small_side
from starloom.operators.keys import materialize, stored

# Default members seeded before any load.
PRODUCT_SEED = {"productid": 1, "product_name": "undefined", "status": "inactive", "alcohol_content_ml": 0.0}
ROOM_SEED = {"roomid": 1, "room_name": "Unknown room"}
# Reference category names appended to the category table.
EXTRA_CATEGORIES = ["Drikke", "Miscellaneous"]


@dataclass
class Operational:
    """The operational tables the job reads."""
    sale: DataFrame
    product: DataFrame
    category: DataFrame
    product_categories: DataFrame
    room: DataFrame
    member: DataFrame


@dataclass
class Warehouse:
    product: DataFrame
    member: DataFrame
    room: DataFrame
    time: DataFrame
    salesfact: DataFrame
    kept: tuple[DataFrame, ...] = ()  # persisted inputs of the lazy tables

    def release(self) -> None:
        """Frees what the load persisted, once its tables are written."""
        for df in self.kept:
            df.unpersist()

    def tables(self) -> dict[str, DataFrame]:
        return {"product": self.product, "member": self.member, "room": self.room,
                "time": self.time, "salesfact": self.salesfact}


# -- sizes ----------------------------------------------------------------------
Size = tuple[int, int]  # rows, bytes of column data


@dataclass(frozen=True)
class SourceSizes:
    """Measured once per load. Dimensions and key maps are derived from these
    tables and have no more rows, plus seeded members, and no longer names."""

    product: Size
    room: Size
    member: Size
    category: Size
    levels: Size

    def dimension(self, table: str) -> Size:
        n, b = getattr(self, table)
        return n + 1, b + 64


def source_sizes(src: Operational, levels: DataFrame) -> SourceSizes:
    return SourceSizes(*sizes([src.product.select("id", "name"), src.room.select("id", "name"),
                               src.member.select("id", "gender", "active"), src.category.select("id", "name"),
                               levels.select("name", "level")]))


# -- dimensions ---------------------------------------------------------------
def product_names(src: Operational, known: SourceSizes) -> DataFrame:
    """(id, product_name): the clean name of every product, computed once."""
    named = src.product.select("id", F.col("name").alias("product_name"))
    return materialize(canonical_names(named, "product_name", size=known.product))


def product_rows(src: Operational, levels: DataFrame, names: DataFrame | None = None,
                 known: SourceSizes | None = None) -> DataFrame:
    """Product members from the bridge: routed levels, defaults, status
    label, clean name (joined from ``names``, if given). Products without a
    category do not appear."""
    bridged = cat.bridge_join(src.product, src.category, src.product_categories, known and known.category)
    routed = cat.route_categories(cat.rank_categories(bridged), levels, size=known and known.levels)
    rows = fill_defaults(routed).select(
        "id", F.col("pname").alias("product_name"), "product_type", "category", "subcategory",
        bool_label("active").alias("status"), "alcohol_content_ml")
    if names is None:
        return canonical_names(rows, "product_name", names=src.product.select("name"))
    return rows.drop("product_name").join(names, "id")


def product_dimension(spark: SparkSession, rows: DataFrame, insert_only: bool = False,
                      at_most: int | None = None) -> DataFrame:
    seed = seed_members(spark, [PRODUCT_SEED], schemas.PRODUCT)
    load = dim_ensure if insert_only else scd1_upsert
    dim = load(seed, rows, PRODUCT_SPEC, seq="id", start=PRODUCT_SEED["productid"] + 1, at_most=at_most)
    return materialize(conform(dim, PRODUCT_SPEC, schemas.PRODUCT))


def member_rows(member: DataFrame, on_unknown: str = "error") -> DataFrame:
    """Distinct (gender, active) pairs, gender recoded."""
    pairs = member.select("gender", "active").distinct().toDF("gender", "is_active")
    return pairs.withColumn("gender", recode("gender", GENDER_CODES, on_unknown, name="gender code"))


def member_dimension(spark: SparkSession, member: DataFrame) -> DataFrame:
    # recoded pairs: as many as there are codes, times three states of active
    dim = dim_ensure(empty_dimension(spark, schemas.MEMBER), member_rows(member), MEMBER_SPEC, start=1,
                     at_most=3 * (len(GENDER_CODES) + 1))
    return materialize(conform(dim, MEMBER_SPEC, schemas.MEMBER))


def room_dimension(spark: SparkSession, room: DataFrame, at_most: int | None = None) -> DataFrame:
    seed = seed_members(spark, [ROOM_SEED], schemas.ROOM)
    rows = room.select("id", F.col("name").alias("room_name"))
    dim = dim_insert(seed, rows, ROOM_SPEC, order=["id"], start=ROOM_SEED["roomid"] + 1, at_most=at_most)
    return materialize(conform(dim, ROOM_SPEC, schemas.ROOM))


# -- two-stage plan -------------------------------------------------------------
def two_stage_load(spark: SparkSession, src: Operational, levels: DataFrame,
                   on_missing_product: str = "default", insert_only_product: bool = False,
                   pad_day_name: bool = False) -> Warehouse:
    known = source_sizes(src, levels)
    rows = product_rows(src, levels, product_names(src, known), known)
    product = product_dimension(spark, rows, insert_only_product, known.product[0])
    member = member_dimension(spark, src.member)
    room = room_dimension(spark, src.room, known.room[0])
    sales = sales_aggregated(src.sale, src.product, src.room, src.member, pad_day_name=pad_day_name)
    staged = staged_sales(sales, names=src.product.select("name"))
    staged = staged.persist(StorageLevel.MEMORY_AND_DISK)
    time = time_dimension_from_moments(staged, pad_day_name)
    fact = load_facts(reaggregate(staged), time, product, member, room, on_missing_product)
    return Warehouse(product, member, room, time, fact, (staged,))


# -- keys-first plan -------------------------------------------------------------
def product_key_map(names: DataFrame, product: DataFrame, known: SourceSizes, on_missing: str = "default") -> DataFrame:
    """source product id -> productid, by clean name."""
    named = names.select(F.col("id").alias("product_id"), "product_name")
    return lookup(named, product, PRODUCT_SPEC, on_missing, size=known.dimension("product")).select("product_id", "productid")


def member_key_map(src: Operational, member: DataFrame, known: SourceSizes) -> DataFrame:
    coded = src.member.select(F.col("id").alias("member_id"),
                              recode("gender", GENDER_CODES, "error", name="gender code").alias("gender"),
                              F.col("active").alias("is_active"))
    return lookup(coded, member, MEMBER_SPEC, "error", size=known.dimension("member")).select("member_id", "memberid")


def room_key_map(src: Operational, room: DataFrame, known: SourceSizes) -> DataFrame:
    named = src.room.select(F.col("id").alias("room_id"), F.col("name").alias("room_name"))
    return lookup(named, room, ROOM_SPEC, "default", size=known.dimension("room")).select("room_id", "roomid")


def sale_moments(src: Operational) -> DataFrame:
    """Sales by source ids and moment (date, tinyint bucket). The fact's time
    key must not be NULL: a sale without a moment fails the load."""
    ts = F.col("ts")
    sale_date = F.coalesce(F.to_date(ts), F.raise_error(F.lit("sale without timestamp")).cast("date"))
    return src.sale.select("product_id", "room_id", "member_id", "price",
                           sale_date.alias("sale_date"), time_of_day_code(ts).alias("tod"))


def _moment_columns() -> list:
    d = F.col("sale_date")
    return [F.year(d).alias("year"), F.month(d).alias("month"), F.dayofmonth(d).alias("day"),
            time_of_day_label("tod").alias("time_of_day")]


def _source_ids(src: Operational) -> list[DataFrame]:
    """The ids that the key maps hold, without computing these."""
    return [t.select("id") for t in (src.product, src.room, src.member)]


def _map_sizes(known: SourceSizes) -> list[Size]:
    """(id, key) per product, room and member."""
    return [(n, 16 * n) for n, _ in (known.product, known.room, known.member)]


def keyed_sales(src: Operational, product: DataFrame, member: DataFrame, room: DataFrame,
                on_missing_product: str = "default", max_broadcast_rows: int | None = None, trusted: bool = False,
                names: DataFrame | None = None, known: SourceSizes | None = None) -> DataFrame:
    """Sales aggregated at the final grain (three keys + moment).

    The moment travels as (date, tinyint bucket): a narrow shuffle key; the
    calendar columns are derived after the aggregate, on far fewer rows.
    Key maps (one row per product, member or room) within the broadcast budget
    are joined map-side, and the aggregate by key is the only shuffle of sale
    data; its partial step collapses hot keys first. A map beyond the budget
    adds one shuffle join, of the sales that can match only, in which AQE
    splits the partition of a hot key. Sales of an unknown product, room or
    member are left out; with ``trusted`` references they are an error. ``names``
    (clean product names) and ``known`` sizes are computed if not given."""
    if known is None:
        ids = [src.product.select("id", "name"), src.room.select("id", "name"), src.member.select("id", "gender", "active")]
        known = SourceSizes(*sizes(ids), (0, 0), (0, 0))
    names = product_names(src, known) if names is None else names
    # "error" concerns products that were sold: a product without a member
    # stays NULL in the map and fails only when a sale refers to it
    in_map = "null" if on_missing_product == "error" else on_missing_product
    maps = {"product_id": product_key_map(names, product, known, in_map), "room_id": room_key_map(src, room, known),
            "member_id": member_key_map(src, member, known)}
    keyed = join_sides(sale_moments(src), maps, "left" if trusted else "inner", _source_ids(src), max_broadcast_rows,
                       _map_sizes(known))
    if trusted:
        for key in ("roomid", "memberid", *(["productid"] if on_missing_product == "default" else [])):
            keyed = keyed.withColumn(key, F.coalesce(key, F.raise_error(F.lit(f"sale with an unknown reference: no {key}")).cast("long")))
    agg = (keyed.groupBy("productid", "memberid", "roomid", "sale_date", "tod")
           .agg(F.sum("price").alias("price"), F.count(F.lit(1)).alias("unit_sales")))
    productid = F.col("productid")
    if on_missing_product == "error":
        productid = F.coalesce(productid, F.raise_error(F.lit("sale of a product without a member")).cast("long"))
    return agg.select(productid.alias("productid"), "memberid", "roomid", *_moment_columns(), "price", "unit_sales")


def sold_moments(src: Operational, max_broadcast_rows: int | None = None, trusted: bool = False,
                 known: SourceSizes | None = None) -> DataFrame:
    """Distinct moments of the sales whose product, room and member exist: a
    narrow scan of its own, so that the fact streams to its writer instead of
    being kept to be read twice. With ``trusted`` references every sale counts
    and the scan reads the time alone."""
    sales = sale_moments(src).drop("price")
    if not trusted:
        ids = _source_ids(src)
        sides = {c: t.toDF(c) for c, t in zip(("product_id", "room_id", "member_id"), ids)}
        sales = join_sides(sales, sides, "left_semi", ids, max_broadcast_rows, known and _map_sizes(known))
    return sales.select("sale_date", "tod").distinct().select(*_moment_columns())


def time_dimension_from_moments(moments: DataFrame, pad_day_name: bool = False) -> DataFrame:
    return sized_time_dimension(moments, pad_day_name)[0]


def sized_time_dimension(moments: DataFrame, pad_day_name: bool = False) -> tuple[DataFrame, int]:
    """The time dimension and its number of members: the distinct moments are
    stored and counted, so that their keys need no pass of their own."""
    found = materialize(moments.select(*TIME_LOOKUP).distinct())
    n = found.count()
    return materialize(conform(time_dimension(found, pad_day_name, n), TIME_SPEC, schemas.TIME)), n


def keys_first_load(spark: SparkSession, src: Operational, levels: DataFrame,
                    on_missing_product: str = "default", max_broadcast_rows: int | None = None,
                    insert_only_product: bool = False, pad_day_name: bool = False, trusted: bool = False) -> Warehouse:
    """Key maps beyond the broadcast budget cost a shuffle of the sales each.
    Then the sales are joined once: their aggregate is stored in the shared
    folder, and both the time dimension and the fact are made from it. Otherwise
    a narrow scan finds the moments and the fact streams to its writer.
    ``trusted``: every sale refers to a product, room and member that exist. It
    spares the moment scan its joins; a sale that breaks the promise fails the
    load instead of being left out."""
    known = source_sizes(src, levels)
    names = product_names(src, known)
    product = product_dimension(spark, product_rows(src, levels, names, known), insert_only_product, known.product[0])
    member = member_dimension(spark, src.member)
    room = room_dimension(spark, src.room, known.room[0])
    agg = keyed_sales(src, product, member, room, on_missing_product, max_broadcast_rows, trusted, names, known)
    if trusted or all_fit(spark, _map_sizes(known), max_broadcast_rows):
        sold = sold_moments(src, max_broadcast_rows, trusted, known)
    else:
        sold = agg = stored(agg)
    time, moments = sized_time_dimension(sold, pad_day_name)
    tkeys = small_side(time.select("timeid", *TIME_LOOKUP), size=(moments, 64 * moments))
    fact = agg.join(tkeys, TIME_LOOKUP).select(
        *FACT_KEYS, hundredths_to_money("price").alias("kroner_sales"),
        F.col("unit_sales").cast("int").alias("unit_sales"))
    return Warehouse(product, member, room, time, fact)


def star_rollup(wh: Warehouse) -> DataFrame:
    """Fact rows joined back to readable attributes (independent of how
    surrogate keys were numbered)."""
    sides = {"timeid": wh.time.select("timeid", *TIME_LOOKUP), "productid": wh.product.select("productid", "product_name"),
             "memberid": wh.member.select("memberid", "gender", "is_active"), "roomid": wh.room.select("roomid", "room_name")}
    f = join_sides(wh.salesfact, sides)
    return f.select(*TIME_LOOKUP, "product_name", "gender", "is_active", "room_name",
                    "kroner_sales", "unit_sales")


__all__ = ["Operational", "Warehouse", "keys_first_load", "two_stage_load", "star_rollup"]
