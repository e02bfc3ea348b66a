"""Clustered file layout by a space-filling curve.

Rows are range-partitioned by a key that interleaves the bits of several
columns (a Z-order curve), so a file covers a small range of each of them, and
a filter on any of the columns leaves most files out. Each column is first
ranked into ``2 ** bits`` slices of about equal numbers of rows (approximate
quantiles, one aggregate), so uneven values fill the curve evenly.

A zone table (file, least and largest value of each column) is written beside
the data. A reader looks a filter's ranges up there and opens the files that
may hold rows only; Parquet statistics prune further inside them. The zone
table has one row a file.

NULLs come before every value; a file that holds NULLs alone has a zone without
bounds, which no range meets.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators.intervals import whole_number

BITS = 8
FILES = 64


def slices(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> dict[str, list]:
    """Upper bounds of the slices of each column: at most 2 ** bits - 1
    numbers a column."""
    at = F.array(*[F.lit(i / (1 << bits)) for i in range(1, 1 << bits)])
    found = df.agg(*[F.percentile_approx(whole_number(df, c), at, 100 * (1 << bits)).alias(f"q{i}") for i, c in enumerate(columns)]).first()
    return {c: sorted(set(found[f"q{i}"] or [])) for i, c in enumerate(columns)}


def slice_number(value: Column, cuts: Sequence, bits: int = BITS) -> Column:
    """The number of cuts below the value plus one, by halving; 0 for NULL."""
    known = F.array(*[F.lit(c) for c in cuts]).cast("array<bigint>")
    state = F.struct(F.lit(0).alias("a"), F.lit(len(cuts)).alias("b"))
    step = lambda s, _: F.when(s["a"] >= s["b"], s).otherwise(F.when(F.get(known, F.floor((s["a"] + s["b"]) / 2).cast("int")) < value, F.struct((F.floor((s["a"] + s["b"]) / 2).cast("int") + 1).alias("a"), s["b"].alias("b"))).otherwise(F.struct(s["a"].alias("a"), F.floor((s["a"] + s["b"]) / 2).cast("int").alias("b"))))
    number = F.aggregate(F.sequence(F.lit(0), F.lit(bits)), state, step, lambda s: s["a"])
    return F.coalesce(F.when(value.isNotNull(), number + 1), F.lit(0)).cast("long")  # NULLs first


def with_curve_key(df: DataFrame, bounds: Mapping[str, list], key: str, bits: int = BITS) -> DataFrame:
    """``df`` with ``key``: the bits of the columns' slice numbers, interleaved,
    the highest first. The numbers are columns of their own, so that each is
    computed once a row and stands once in the plan, not once for each bit."""
    n = len(bounds)
    numbers = [f"{key}_slice_{i}" for i in range(n)]
    numbered = df.withColumns({c: slice_number(whole_number(df, column), cuts, bits)
                               for c, (column, cuts) in zip(numbers, bounds.items(), strict=True)})
    out = F.lit(0).cast("long")
    for i, c in enumerate(numbers):
        for bit in range(bits + 1):
            out = out.bitwiseOR(F.shiftleft(F.shiftright(c, bit).bitwiseAND(1), bit * n + (n - 1 - i)))
    return numbered.withColumn(key, out).drop(*numbers)


def write_clustered(df: DataFrame, path: str, columns: Sequence[str], files: int = FILES, bits: int = BITS) -> None:
    """Writes ``df`` below ``path``/data in about ``files`` files clustered by
    ``columns`` (integers, dates or timestamps), and their zones."""
    if not columns or len(columns) * (bits + 1) > 62:
        raise ValueError("at least one column, and no more bits than a long has")
    spark = df.sparkSession
    keyed = with_curve_key(df, slices(df, columns, bits), "_z", bits)
    ordered = keyed.repartitionByRange(files, "_z").sortWithinPartitions("_z").drop("_z")
    ordered.write.parquet(f"{path}/data")
    stored = spark.read.parquet(f"{path}/data")
    bounds = [f(F.col(f"`{c}`")).alias(f"{name}_{i}") for i, c in enumerate(columns) for f, name in ((F.min, "low"), (F.max, "high"))]
    # the name alone: the path comes URL-encoded, and a folder may be moved
    zones = stored.groupBy(F.col("_metadata.file_name").alias("file")).agg(F.count(F.lit(1)).alias("n"), *bounds)
    zones.coalesce(1).write.parquet(f"{path}/zones")


def matching_files(spark: SparkSession, path: str, columns: Sequence[str], ranges: Mapping[str, tuple[Any, Any]]) -> list[str]:
    """Files that may hold rows with every column in its closed range."""
    zones = spark.read.parquet(f"{path}/zones")
    for column, (low, high) in ranges.items():
        i = list(columns).index(column)
        zones = zones.where((F.col(f"high_{i}") >= F.lit(low)) & (F.col(f"low_{i}") <= F.lit(high)))
    return sorted(f"{path}/data/{r['file']}" for r in zones.select("file").collect())  # at most one a file written


def read_clustered(spark: SparkSession, path: str, columns: Sequence[str], ranges: Mapping[str, tuple[Any, Any]]) -> DataFrame:
    """Rows with every column in its closed range, from the files that may
    hold any. ``columns`` as they were given to :func:`write_clustered`."""
    files = matching_files(spark, path, columns, ranges)
    rows = spark.read.parquet(*files) if files else spark.read.parquet(f"{path}/data").limit(0)
    for column, (low, high) in ranges.items():
        rows = rows.where(F.col(f"`{column}`").between(F.lit(low), F.lit(high)))
    return rows
