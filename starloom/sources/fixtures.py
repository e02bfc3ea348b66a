"""Operational source tables, expressed as views over the test tables.

The warehouse job reads six operational tables (sale, product, category,
product/category bridge, room, member). Tests and benchmarks derive them
from the TPC-H-like tables in ``sf_dir``, as described in FIXTURES.md, so
every query's work grows with the input scale. All views are lazy; Catalyst
prunes the Parquet scans down to the columns each query uses.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Fixture rules (see FIXTURES.md).
MALE_SEGMENTS = ["BUILDING", "MACHINERY"]
FEMALE_SEGMENTS = ["FURNITURE", "HOUSEHOLD"]
GAP_NAME_PREFIXES = ["blue", "cold"]
SUBCATEGORY_SIZES = ["S", "M", "L", "XL"]
UNLISTED_CATEGORY = "Seasonal"  # found on no level
BRAND_PREFIX = "Brand#"


class Sources:
    """Lazy source views over the tables of one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._categories: dict[bool, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # -- operational tables -------------------------------------------------
    @property
    def sale(self) -> DataFrame:
        """product_id, room_id, member_id, price (integer hundredths), ts."""
        li = self.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey",
                                           "l_suppkey", "l_extendedprice")
        o = self.table("orders").select("o_orderkey", "o_custkey", "o_orderdate")
        hour = ((F.col("l_orderkey") + F.col("l_linenumber") * 5) % 24).cast("int")
        return li.join(o, li.l_orderkey == o.o_orderkey, "inner").select(
            F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("room_id"),
            F.col("o_custkey").alias("member_id"),
            F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("price"),
            (F.col("o_orderdate") + F.make_dt_interval(F.lit(0), hour, F.lit(0), F.lit(0))).alias("ts"),
        )

    @property
    def product(self) -> DataFrame:
        """id, name (HTML on even ids), active, alcohol_content_ml."""
        p = self.table("part")
        html_name = F.concat(F.lit("<b>"), "p_name", F.lit("</b> &amp; co"))
        plain_name = F.concat("p_name", F.lit(" & co"))
        return p.select(
            F.col("p_partkey").alias("id"),
            F.when(F.col("p_partkey") % 2 == 0, html_name).otherwise(plain_name).alias("name"),
            (F.col("p_size") > 25).alias("active"),
            F.col("p_retailprice").alias("alcohol_content_ml"),
        )

    @property
    def member(self) -> DataFrame:
        """id, gender code M/F/U, active."""
        seg = F.col("c_mktsegment")
        gender = F.when(seg.isin(MALE_SEGMENTS), "M").when(seg.isin(FEMALE_SEGMENTS), "F").otherwise("U")
        return self.table("customer").select(
            F.col("c_custkey").alias("id"), gender.alias("gender"),
            (F.col("c_acctbal") >= 0).alias("active"))

    @property
    def room(self) -> DataFrame:
        return self.table("supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))

    def bridge_named(self, gap: bool = False) -> DataFrame:
        """(product_id, cname): up to five categories per product, some of them two
        on one level or one on no level.

        ``gap=True`` leaves out every part whose name starts with one of
        GAP_NAME_PREFIXES, so whole product names miss the dimension."""
        p = self.table("part").select("p_partkey", "p_name", "p_type", "p_brand", "p_size")
        if gap:
            keep = None
            for prefix in GAP_NAME_PREFIXES:
                c = ~F.col("p_name").startswith(prefix)
                keep = c if keep is None else keep & c
            p = p.filter(keep)
        p = p.filter(F.col("p_size") % 10 != 0)
        size_class = (F.when(F.col("p_size") < 17, "S").when(F.col("p_size") < 34, "M").otherwise("L"))
        first = p.select(F.col("p_partkey").alias("product_id"), F.col("p_type").alias("cname"))
        second = p.filter(F.col("p_size") % 3 != 0).select("p_partkey", "p_brand")
        third = p.filter(F.col("p_size") % 2 == 0).select("p_partkey", size_class)
        fourth = p.filter(F.col("p_size") % 4 == 0).select("p_partkey", F.lit("XL"))
        fifth = p.filter(F.col("p_size") % 7 == 0).select("p_partkey", F.lit(UNLISTED_CATEGORY))
        return reduce(DataFrame.unionAll, [first, *[d.toDF("product_id", "cname") for d in (second, third, fourth, fifth)]])

    def category(self, gap: bool = False) -> DataFrame:
        """Category table (id, name): ids dense in name order."""
        from starloom.operators.keys import assign_keys

        if gap not in self._categories:
            names = self.bridge_named(gap).select(F.col("cname").alias("name")).distinct()
            self._categories[gap] = assign_keys(names, ["name"], key="id")
        return self._categories[gap]

    def product_categories(self, gap: bool = False) -> DataFrame:
        """Bridge by ids (product_id, category_id)."""
        cat = self.category(gap)
        return (self.bridge_named(gap).join(cat.withColumnRenamed("name", "cname"), "cname")
                .select("product_id", F.col("id").alias("category_id")))

    # -- routing levels -----------------------------------------------------
    def level_map(self, gap: bool = False) -> DataFrame:
        """(name, level) for every category name that has a level, by the fixture rule."""
        names = self.bridge_named(gap).select(F.col("cname").alias("name")).distinct()
        names = names.filter(F.col("name") != UNLISTED_CATEGORY)
        return names.select("name", level_of(F.col("name")).alias("level"))


def level_of(name: Column) -> Column:
    """Fixture routing rule as an expression."""
    return (F.when(name.startswith(BRAND_PREFIX), "category")
            .when(name.isin(SUBCATEGORY_SIZES), "subcategory").otherwise("product_type"))
