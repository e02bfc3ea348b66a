"""Sales aggregation, staging, re-aggregation, time members and fact load."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom import schemas
from starloom.functions.html import with_html_text
from starloom.functions.money import money, money_sum
from starloom.functions.recode import GENDER_CODES, recode
from starloom.functions.timeparts import (
    calendar_from_date,
    day_name,
    season,
    time_member_columns,
    time_of_day_code,
    time_of_day_label,
)
from starloom.operators.dims import DimensionSpec, lookup
from starloom.operators.joins import budget, fits_broadcast, fits_budget, join_sides
from starloom.operators.keys import assign_keys

# Grain of the sales aggregate and of the staging table.
SALES_GRAIN = ["is_active", "gender", "product_name", "room_name", "year", "season", "month",
               "day", "day_of_week", "time_of_day"]
STAGED_COLUMNS = [f.name for f in schemas.STAGED_SALE.fields]
TIME_LOOKUP = ["year", "month", "day", "time_of_day"]
TIME_ATTRIBUTES = ["year", "month", "day", "time_of_day", "season", "day_of_week", "is_weekday",
                   "holiday", "event"]
FACT_KEYS = ["timeid", "productid", "memberid", "roomid"]

PRODUCT_SPEC = DimensionSpec("product", "productid",
                             ["product_type", "category", "subcategory", "product_name", "status",
                              "alcohol_content_ml"],
                             ["product_name"], type1=("status",), default_id=1)
MEMBER_SPEC = DimensionSpec("member", "memberid", ["gender", "is_active"], ["gender", "is_active"])
ROOM_SPEC = DimensionSpec("room", "roomid", ["room_name"], ["room_name"], default_id=1)
TIME_SPEC = DimensionSpec("time", "timeid", TIME_ATTRIBUTES, TIME_LOOKUP)


def _star_sides(product: DataFrame, room: DataFrame, member: DataFrame) -> dict[str, DataFrame]:
    return {"product_id": product.select(F.col("id").alias("product_id"), F.col("name").alias("p_name")),
            "room_id": room.select(F.col("id").alias("room_id"), F.col("name").alias("r_name")),
            "member_id": member.select(F.col("id").alias("member_id"), "gender", "active")}


def star_join(sale: DataFrame, product: DataFrame, room: DataFrame, member: DataFrame) -> DataFrame:
    """sale x product x room x member, inner, with the columns the sales
    aggregate needs. Sides are broadcast within the checked budget; for any
    other, AQE splits skewed partitions of its shuffle join."""
    return join_sides(sale.select("product_id", "room_id", "member_id", "price", "ts"),
                      _star_sides(product, room, member))


def sales_aggregated(sale: DataFrame, product: DataFrame, room: DataFrame, member: DataFrame,
                     max_broadcast_rows: int | None = None, pad_day_name: bool = False) -> DataFrame:
    """Sales at the 10-column grain: kroner_sales = ROUND(SUM(price)/100, 2),
    unit_sales = COUNT(*).

    The moment is grouped as (date, tinyint bucket), of which the calendar
    columns are functions; they are derived afterwards. Sides within the budget
    are joined map-side, so the aggregate (partial before the exchange, which
    collapses a hot group) is the only shuffle; every larger side adds one."""
    ts = F.col("ts")
    moments = sale.select("product_id", "room_id", "member_id", "price",
                          F.to_date(ts).alias("sale_date"), time_of_day_code(ts).alias("tod"))
    joined = join_sides(moments, _star_sides(product, room, member), max_rows=max_broadcast_rows)
    d = F.col("sale_date")
    return (joined.groupBy("sale_date", "tod", "p_name", "r_name", "gender", "active")
            .agg(money_sum("price").alias("kroner_sales"), F.count(F.lit(1)).alias("unit_sales"))
            .select(F.year(d).alias("year"), F.month(d).alias("month"), season(d).alias("season"),
                    F.dayofmonth(d).alias("day"), day_name(d, pad_day_name).alias("day_of_week"),
                    time_of_day_label("tod").alias("time_of_day"), F.col("p_name").alias("product_name"),
                    F.col("r_name").alias("room_name"), "gender", F.col("active").alias("is_active"),
                    "kroner_sales", "unit_sales"))


def canonical_names(df: DataFrame, column: str, out: str | None = None,
                    names: DataFrame | None = None, size: tuple[int, int] | None = None) -> DataFrame:
    """Replace an HTML-bearing name column by its plain text.

    The text job runs once per *distinct* raw name (a dimension-sized set),
    never per sale; the raw -> clean map is joined back (broadcast when its
    size is checked small). ``names`` (one column) holds the raw names when a
    smaller frame than ``df`` knows them all, so ``df`` is read once; a name
    that it lacks is an error. ``size``: (rows, bytes) that the names are known
    not to exceed, instead of measuring them."""
    out = out or column
    raw = (df.select(column) if names is None else names).toDF("_raw").distinct()
    cleaned = with_html_text(raw, "_raw", "_clean").withColumn("_known", F.lit(True))
    # the check reads raw names (same rows, half the bytes), so it runs no Python
    half = budget(df.sparkSession)[1] // 2
    if fits_broadcast(raw, max_bytes=half) if size is None else fits_budget(df.sparkSession, size, max_bytes=half):
        cleaned = F.broadcast(cleaned)
    joined = df.join(cleaned, df[column].eqNullSafe(cleaned["_raw"]), "left")
    clean = F.col("_clean")
    if names is not None:
        missing = df[column].isNotNull() & F.col("_known").isNull()
        clean = F.when(missing, F.raise_error(F.lit(f"{column} outside the given names")).cast("string")).otherwise(clean)
    if out == column:
        cols = [clean.alias(out) if c == column else df[c] for c in df.columns]
    else:
        cols = [df[c] for c in df.columns] + [clean.alias(out)]
    return joined.select(*cols)


def staged_sales(sales_agg: DataFrame, on_unknown_gender: str = "error",
                 names: DataFrame | None = None) -> DataFrame:
    """The staging rows: product names cleaned, gender codes recoded, cast to
    the staging schema. ``names`` as in :func:`canonical_names`: with the name
    column of the product table, sales are read once."""
    cleaned = canonical_names(sales_agg, "product_name", names=names)
    out = cleaned.withColumn("gender", recode("gender", GENDER_CODES, on_unknown_gender, name="gender code"))
    return out.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.STAGED_SALE.fields])


def reaggregate(staged: DataFrame) -> DataFrame:
    """Group staged rows again at the same grain (cleaning can merge names)."""
    return (staged.groupBy(*SALES_GRAIN)
            .agg(money(F.sum("kroner_sales")).alias("kroner_sales"),
                 F.sum("unit_sales").cast("long").alias("unit_sales"))
            .select(*STAGED_COLUMNS))


def time_members(rows: DataFrame, pad_day_name: bool = False) -> DataFrame:
    """Distinct observed moments (year, month, day, time_of_day) with their
    calendar attributes. Season and weekday are functions of the date, so
    they are derived after the distinct (a hash aggregate with no string
    buffers) instead of being carried through it."""
    return (rows.select(*TIME_LOOKUP).distinct()
            .select(*TIME_LOOKUP, *calendar_from_date(pad_day_name=pad_day_name))
            .select(*TIME_LOOKUP, "season", "day_of_week", *time_member_columns()))


def time_dimension(rows: DataFrame, pad_day_name: bool = False, at_most: int | None = None) -> DataFrame:
    """Time dimension keyed 1.. in (year, month, day, time_of_day) order."""
    members = time_members(rows, pad_day_name)
    return assign_keys(members, TIME_LOOKUP, key="timeid", at_most=at_most).select(*TIME_SPEC.columns)


def load_facts(staged: DataFrame, time_dim: DataFrame, product_dim: DataFrame, member_dim: DataFrame,
               room_dim: DataFrame, on_missing_product: str = "default") -> DataFrame:
    """Resolve the four keys and regroup by them (several natural keys may
    resolve to one default member, so the composite key must be re-made)."""
    f = lookup(staged, time_dim, TIME_SPEC, "error")
    f = lookup(f, product_dim, PRODUCT_SPEC, on_missing_product)
    f = lookup(f, member_dim, MEMBER_SPEC, "error")
    f = lookup(f, room_dim, ROOM_SPEC, "default")
    return regroup_facts(f)


def regroup_facts(f: DataFrame, keys: Sequence[str] = FACT_KEYS) -> DataFrame:
    return (f.groupBy(*keys)
            .agg(money(F.sum("kroner_sales")).alias("kroner_sales"),
                 F.sum("unit_sales").cast("int").alias("unit_sales"))
            .select(*schemas.SALESFACT.fieldNames()))
