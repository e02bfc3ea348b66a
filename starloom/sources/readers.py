"""Query sources: a table or query read as a lazy DataFrame.

Production reads the operational database over JDBC, split into parallel
range reads on a numeric column so no single task pulls a whole table;
tests read Parquet. Either way the result is a lazy DataFrame, and Catalyst
prunes columns and pushes filters into the scan.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def read_query(spark: SparkSession, url: str, query: str | None = None, table: str | None = None,
               partition_column: str | None = None, lower_bound: int | None = None,
               upper_bound: int | None = None, num_partitions: int | None = None,
               fetch_size: int = 10_000, properties: dict | None = None) -> DataFrame:
    """JDBC source. Give ``table`` plus ``partition_column``/bounds/
    ``num_partitions`` for big tables (the sale table): Spark then issues
    ``num_partitions`` range queries in parallel. A free-form ``query``
    cannot be split by Spark and should only be used for small sources."""
    if (query is None) == (table is None):
        raise ValueError("give exactly one of query= or table=")
    r = spark.read.format("jdbc").option("url", url).option("fetchsize", str(fetch_size))
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    if query is not None:
        return r.option("query", query).load()
    r = r.option("dbtable", table)
    if partition_column:
        if None in (lower_bound, upper_bound, num_partitions):
            raise ValueError("partitioned reads need lower_bound, upper_bound and num_partitions")
        r = (r.option("partitionColumn", partition_column)
             .option("lowerBound", str(lower_bound)).option("upperBound", str(upper_bound))
             .option("numPartitions", str(num_partitions)))
    return r.load()


def rename_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Positional renaming of a source's output columns."""
    if len(names) != len(df.columns):
        raise ValueError(f"{len(names)} names for {len(df.columns)} columns")
    return df.toDF(*names)


def read_pairs(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Bridge pairs kept as a data file (product_id, category_id)."""
    schema = T.StructType([T.StructField("product_id", T.LongType()),
                           T.StructField("category_id", T.LongType())])
    if fmt == "csv":
        return spark.read.schema(schema).option("header", "true").csv(path)
    return spark.read.schema(schema).format(fmt).load(path)


def read_insert_script(spark: SparkSession, path: str, table: str, columns: Sequence[str], line_end: str = ";") -> DataFrame:
    """Rows of the ``INSERT INTO <table> (...) VALUES (...)`` statements of SQL
    scripts, as whole numbers: the form in which a bridge table is kept as a
    script. Statements end with ``line_end`` and may span lines; several rows
    after one VALUES and any order of the named columns are read; statements on
    other tables are left alone. A statement that lacks one of ``columns`` or
    has other values than numbers or NULL there is an error. Files are split at
    the statement's end, so a script is read in parallel."""
    statements = spark.read.option("lineSep", line_end).text(path)
    name = re.escape(table)
    pattern = rf"(?is)^\s*insert\s+into\s+(?:[\w\"]+\.)?\"?{name}\"?\s*\(([^)]*)\)\s*values\s*(.*)$"
    own = statements.where(F.col("value").rlike(pattern))
    named = F.transform(F.split(F.regexp_extract("value", pattern, 1), ","), lambda c: F.lower(F.trim(F.translate(c, '"\n\r\t', ""))))
    rows = own.select(named.alias("named"), F.explode(F.regexp_extract_all("value", F.lit(r"\(([^()]*)\)"), F.lit(1))).alias("row"), F.monotonically_increasing_id().alias("_at"))
    # the first brackets are the column list
    listed = F.transform(F.split("row", ","), lambda c: F.lower(F.trim(F.translate(c, '"\n\r\t', ""))))
    values = rows.where(listed != F.col("named")).select("named", F.transform(F.split("row", ","), lambda v: F.trim(F.translate(v, "\n\r\t", ""))).alias("values"))

    def value(column: str) -> Column:
        at = F.array_position("named", column.lower())
        text = F.when(at > 0, F.get("values", (at - 1).cast("int"))).otherwise(F.raise_error(F.lit(f"a statement without column {column}")).cast("string"))
        return F.when(F.upper(text) != "NULL", text).cast("long").alias(column)

    return values.select(*[value(c) for c in columns])
