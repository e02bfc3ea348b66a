"""Product <-> category bridge: join, rank, pivot, top-k and level routing.

Group sizes here are bounded: bridge pairs are unique, so one product has at
most as many rows as there are categories. The ``rn <= k`` filters are
planned by Spark as a partial (pre-shuffle) plus final window group limit.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from starloom.operators.joins import small_side

# Routing levels of the product hierarchy and their category
# names (a name found in no list is ignored).
LEVELS = {
    "product_type": ["Drikke", "Miscellaneous", "Spiselige varer", "Events"],
    "category": ["Sodavand", "Vitamin vand", "Kaffe", "Alkoholdie varer", "Energidrik"],
    "subcategory": ["Øl", "Special øl", "Hård spiritus", "Spiritus"],
}
LEVEL_NAMES = ("product_type", "category", "subcategory")
# Slots of the pivot and of the top-k; routing has no such limit.
MAX_CATEGORIES = 3


def level_map(spark: SparkSession, levels: dict | None = None) -> DataFrame:
    """(name, level) rows from a literal level dictionary."""
    levels = levels or LEVELS
    rows = [F.struct(F.lit(name).alias("name"), F.lit(level).alias("level"))
            for level, names in levels.items() for name in names]
    return spark.range(1).select(F.inline(F.array(*rows)))


def bridge_join(product: DataFrame, category: DataFrame, product_categories: DataFrame,
                size: tuple[int, int] | None = None) -> DataFrame:
    """Inner 3-way join; products without any category drop out. ``size``:
    (rows, bytes) of the categories, if known.

    Output: id, pname, cname, active, alcohol_content_ml."""
    cat = small_side(category.select(F.col("id").alias("category_id"), F.col("name").alias("cname")), size=size)
    pc = product_categories.select("product_id", "category_id").join(cat, "category_id")
    p = product.select("id", F.col("name").alias("pname"), "active", "alcohol_content_ml")
    return p.join(pc, p.id == pc.product_id, "inner").select(
        "id", "pname", "cname", "active", "alcohol_content_ml")


def rank_in_group(df: DataFrame, partition: Sequence[str], order: Sequence, name: str = "rn") -> DataFrame:
    """row_number() per group in a defined order."""
    return df.withColumn(name, F.row_number().over(W.partitionBy(*partition).orderBy(*order)))


def topk_per_group(df: DataFrame, partition: Sequence[str], order: Sequence, k: int,
                   name: str = "rn") -> DataFrame:
    """First ``k`` rows of each group (the feature itself is a limit)."""
    return rank_in_group(df, partition, order, name).filter(F.col(name) <= k)


def rank_categories(bridged: DataFrame) -> DataFrame:
    """Number each product's categories by name (rn = 1, 2, ...)."""
    return rank_in_group(bridged, ["id", "pname"], [F.col("cname").asc_nulls_first()])


def pivot_categories(ranked: DataFrame, k: int = MAX_CATEGORIES) -> DataFrame:
    """One row per product with cat_01..cat_0k; a slot with no category is
    NULL. Categories past the k-th are dropped (see :func:`dropped_count`)."""
    slots = [F.max(F.when(F.col("rn") == i, F.col("cname"))).alias(f"cat_{i:02d}") for i in range(1, k + 1)]
    return (ranked.filter(F.col("rn") <= k)
            .groupBy("id", "pname", "active", "alcohol_content_ml").agg(*slots))


def dropped_count(ranked: DataFrame, k: int = MAX_CATEGORIES) -> DataFrame:
    """Per product, how many categories the k-slot pivot leaves out."""
    return (ranked.groupBy("id").agg(F.count(F.when(F.col("rn") > k, 1)).alias("dropped"))
            .filter(F.col("dropped") > 0))


def route_pivoted(pivoted: DataFrame, levels: dict | None = None, k: int = MAX_CATEGORIES) -> DataFrame:
    """Route cat_01..cat_0k into levels; a later slot overwrites an earlier
    one of the same level; a name in no level is ignored."""
    levels = levels or LEVELS
    out = pivoted
    for level in LEVEL_NAMES:
        names = levels.get(level, [])
        slots = [F.when(F.col(f"cat_{i:02d}").isin(names), F.col(f"cat_{i:02d}")) for i in range(k, 0, -1)]
        out = out.withColumn(level, F.coalesce(*slots) if names else F.lit(None).cast("string"))
    return out


def route_categories(ranked: DataFrame, levels: DataFrame, k: int | None = None,
                     size: tuple[int, int] | None = None) -> DataFrame:
    """Routing without the pivot: join each ranked category to its level
    (``levels``: name, level) and keep, per product and level, the name with
    the highest rank. All categories count, unless ``k`` limits them to the
    first k as the pivot does (:func:`dropped_count` reports what that loses).
    ``size``: (rows, bytes) of the levels, if known.

    Output: id, pname, active, alcohol_content_ml, product_type, category,
    subcategory."""
    lv = small_side(levels.select(F.col("name").alias("cname"), "level"), size=size)
    counted = ranked if k is None else ranked.filter(F.col("rn") <= k)
    tagged = counted.join(lv, "cname", "left")

    def pick(level: str) -> Column:
        hit = F.col("level") == level
        return F.max_by(F.when(hit, F.col("cname")), F.when(hit, F.col("rn"))).alias(level)

    return tagged.groupBy("id", "pname", "active", "alcohol_content_ml").agg(*[pick(lv_) for lv_ in LEVEL_NAMES])
