"""Run-to-run difference: what changed between two versions of a table.

Both versions are cut into buckets by a hash of the key columns. Of each bucket
an order-free sum over the rows' hashes is taken; only buckets whose sums differ
are compared row by row. Two equal runs cost one narrow aggregate each, and
only rows of unequal buckets are shuffled.

The comparison counts rows (EXCEPT ALL in both directions): a row that comes up
twice in one version and once in the other is a difference of one. NULLs equal
NULLs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.operators.joins import small_side
from starloom.operators.keys import materialize

BUCKETS = 65_536
_LOW = (1 << 32) - 1


def _row_hash(columns: Sequence[str], seed: int) -> Column:
    """Hash of a whole row; which columns are NULL is part of it."""
    nulls = F.concat(*[F.col(f"`{c}`").isNull().cast("int").cast("string") for c in columns])
    return F.xxhash64(F.lit(seed), nulls, *[F.col(f"`{c}`") for c in columns])


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(buckets))


def bucket_sums(df: DataFrame, keys: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n, sums of the halves of two row hashes): the same for the same
    rows in any order. Halves are 32 bits, so the sums are exact up to 2 ** 31
    rows a bucket; beyond that they overflow with an error."""
    columns = sorted(df.columns)
    hashed = df.select(bucket_of(keys, buckets).alias("bucket"), _row_hash(columns, 1).alias("a"), _row_hash(columns, 2).alias("b"))
    halves = [f(h).alias(f"{h}{i}") for h in ("a", "b") for i, f in enumerate((lambda c: F.sum(F.col(c).bitwiseAND(_LOW)), lambda c: F.sum(F.shiftright(c, 32))))]
    return hashed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), *halves)


def unequal_buckets(old: DataFrame, new: DataFrame, keys: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    sums = [bucket_sums(df, keys, buckets) for df in (old, new)]
    a, b = (s.select("bucket", F.struct(*[c for c in s.columns if c != "bucket"]).alias(name)) for s, name in zip(sums, ("a", "b")))
    return materialize(a.join(b, "bucket", "full").where(~F.col("a").eqNullSafe(F.col("b"))).select("bucket"))


def difference(old: DataFrame, new: DataFrame, keys: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """The rows whose number differs, with ``change``: how many more there are
    in ``new`` (negative: in ``old``)."""
    if sorted(old.columns) != sorted(new.columns) or any(old.schema[c].dataType != new.schema[c].dataType for c in old.columns):
        raise ValueError("both versions must have the same columns and types")
    columns = old.columns
    changed = small_side(unequal_buckets(old, new, keys, buckets))
    sides = []
    for df, sign in ((old, -1), (new, 1)):
        rows = df.select(*[F.col(f"`{c}`") for c in columns], bucket_of(keys, buckets).alias("bucket")).join(changed, "bucket", "left_semi")
        sides.append(rows.drop("bucket").withColumn("change", F.lit(sign).cast("long")))
    both = sides[0].unionByName(sides[1])
    return both.groupBy(*[F.col(f"`{c}`") for c in columns]).agg(F.sum("change").alias("change")).where("change <> 0")
