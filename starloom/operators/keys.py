"""Dense surrogate keys without a single-partition window.

``row_number() over (order by k)`` moves every row into one task. Instead:

1. range-partition on the natural key and sort inside each partition;
2. cut the lineage with a reliable checkpoint, so the sampled range split
   is fixed even if a task or executor has to be recomputed later;
3. count rows per partition (one number per partition reaches the driver)
   and turn the counts into cumulative offsets;
4. key = start + offset[partition] + position inside the partition.

The result equals ``start - 1 + row_number() over (order by natural key,
NULLs first)`` for any number of partitions.

Inputs proven small (at most ``LOCAL_MAX_ROWS`` rows, by a distributed
count of the persisted input) take the plain window: one task sorts a
bounded number of rows. Both ways order ties by every other column and give
the same keys; the persisted input is released once the keys are stored.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starloom.session import checkpoint_dir

_ROW_BITS = 33  # monotonically_increasing_id = partition index << 33 | row position
# Largest input numbered by a single window task.
LOCAL_MAX_ROWS = 100_000


def _order(cols: Sequence) -> list[Column]:
    return [(F.col(c) if isinstance(c, str) else c).asc_nulls_first() for c in cols]


def assign_keys(df: DataFrame, order_cols: Sequence, key: str = "id", start: int | Column = 1,
                num_partitions: int | None = None, local_max_rows: int = LOCAL_MAX_ROWS,
                at_most: int | None = None) -> DataFrame:
    """Add ``key``: dense ids ``start, start+1, ...`` in ``order_cols`` order.

    Rows with equal ``order_cols`` are ordered by their remaining columns, so
    the numbering is the same for any size and any number of partitions (rows
    equal in every column are interchangeable). ``start`` may be a literal or
    a Column such as the result of :func:`next_key`. ``at_most`` is a number
    of rows that the input is known not to exceed: if it is small enough for
    the plain window, nothing has to be counted and the result is lazy.
    """
    start_col = start if isinstance(start, Column) else F.lit(start)
    spark = df.sparkSession
    order = _order([*order_cols, *[c for c in df.columns if c not in order_cols]])
    if at_most is not None and at_most <= local_max_rows:
        keyed = start_col.cast("long") + F.row_number().over(W.orderBy(*order)) - 1
        return df.select(keyed.alias(key), *[F.col(c) for c in df.columns])
    # The input is computed once: the size count, range sampling, the
    # checkpoint job and its write all read this persisted copy.
    source = df.persist(StorageLevel.MEMORY_AND_DISK)
    checkpoint_dir(spark)
    if local_max_rows > 0 and source.count() <= local_max_rows:
        keyed = start_col.cast("long") + F.row_number().over(W.orderBy(*order)) - 1
        out = source.select(keyed.alias(key), *[F.col(c) for c in source.columns]).checkpoint(eager=True)
        source.unpersist()
        return out
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = source.repartitionByRange(n, *order).sortWithinPartitions(*order).checkpoint(eager=True)
    source.unpersist()

    pid = F.spark_partition_id()
    counts = dict((r["pid"], r["n"]) for r in
                  ranged.groupBy(pid.alias("pid")).agg(F.count(F.lit(1)).alias("n")).collect())
    if not counts:
        return ranged.select(F.lit(None).cast("long").alias(key), *ranged.columns)
    # offsets[p] = rows in partitions before p; one entry per partition, so
    # the literal is bounded by the partition count. Catalyst folds it into
    # a constant array: an O(1) lookup per row.
    offsets, total = [], 0
    for p in range(max(counts) + 1):
        offsets.append(total)
        total += counts.get(p, 0)
    offset_of = F.element_at(F.array(*[F.lit(o).cast("long") for o in offsets]), pid + 1)
    position = F.monotonically_increasing_id() - F.shiftleft(pid.cast("long"), _ROW_BITS)
    keyed = start_col.cast("long") + offset_of + position
    return ranged.select(keyed.alias(key), *[F.col(c) for c in ranged.columns])


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and cut its lineage with a reliable checkpoint
    (in the cluster's shared ``spark.checkpoint.dir``). Used for finished
    dimensions, which every lookup reads again."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """Like :func:`materialize`, as a compressed table: for results of the size
    of the sales, which are smaller on disk and pruned by column when read."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path, compression="zstd")
    return spark.read.schema(df.schema).parquet(path)


def next_key(dim: DataFrame, key: str) -> int:
    """1 + the largest key of a dimension (1 when empty)."""
    top = dim.agg(F.max(key).alias("m")).collect()[0]["m"]
    return 1 if top is None else int(top) + 1
