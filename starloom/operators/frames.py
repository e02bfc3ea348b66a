"""Moving frames without a hot partition.

A window partitioned by key puts every row of a key into one task. Here the
time line of a key with more than ``chunk_rows`` rows is cut into chunks; a row
goes to its own chunk and, as a halo, to the later chunks whose first frames
reach back to it. The window then runs per (key, chunk), and the halo rows are
dropped. Chunks of a key are at least as long as the frame, so a row has at
most one copy; other keys are one chunk without any.

How wide the chunks of a key are is measured: its span divided by its number of
chunks of ``chunk_rows`` rows. The table of such keys has no more rows than the
input divided by ``chunk_rows``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starloom.operators.intervals import whole_number
from starloom.operators.joins import small_side
from starloom.operators.keys import materialize

CHUNK_ROWS = 500_000


def chunked(df: DataFrame, keys: Sequence[str], time: str, length: int, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """The rows with their chunk (``_chunk``), the time as a number (``_t``)
    and whether they are a copy (``_halo``)."""
    keys = list(keys)
    rows = df.withColumn("_t", whole_number(df, time))
    span = F.max("_t") - F.min("_t") + 1
    hot = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), span.alias("_span")).where(F.col("_n") > chunk_rows)
    width = F.greatest(F.lit(max(1, length)).cast("long"), F.ceil(F.col("_span") / F.ceil(F.col("_n") / chunk_rows)))
    hot = materialize(hot.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], width.cast("long").alias("_width")))
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    marked = rows.join(small_side(hot), same, "left").drop(*[f"_k{i}" for i in range(len(keys))])
    number = lambda t: F.when(F.col("_width").isNull() | F.col("_t").isNull(), F.lit(0)).otherwise(F.floor(t / F.col("_width"))).cast("long")
    own, last = number(F.col("_t")), number(F.col("_t") + length)
    out = marked.withColumn("_own", own).withColumn("_chunk", F.explode(F.array_distinct(F.array(F.col("_own"), last))))
    return out.withColumn("_halo", F.col("_chunk") != F.col("_own")).drop("_own", "_width")


def moving(df: DataFrame, keys: Sequence[str], time: str, length: int, aggregates: dict[str, Column], chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """``df`` with each aggregate over the rows of the same keys whose time lies
    in the ``length`` units up to the row's own (days of a date, microseconds of a
    timestamp), as a RANGE frame: rows of the same time are in each other's.
    Rows without a time are a frame of their own per key."""
    parts = chunked(df, keys, time, length, chunk_rows)
    frame = W.partitionBy(*keys, "_chunk").orderBy("_t").rangeBetween(-length, 0)
    out = parts.withColumns({name: a.over(frame) for name, a in aggregates.items()})
    return out.where(~F.col("_halo")).select(*[F.col(f"`{c}`") for c in df.columns], *aggregates)
