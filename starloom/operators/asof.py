"""As-of join: the latest right row at or before each left row of the same key.

1. Both sides go into one tagged table, range-partitioned by (key, time) and
   sorted, right rows first at equal times. A key with a third of all rows is
   spread over as many partitions as it needs. The table is checkpointed, so
   the sampled split is the same for both passes below, also if an executor is lost.
2. Borders: of each partition, its first and last key and the last right row of
   the last key. The driver carries them from partition to partition: one row
   a partition.
3. Each partition fills its rows forward, starting with the row carried over
   its border, in Arrow batches.

Left rows without a partner keep NULLs; a NULL key or time has no partner.
Right rows with a NULL key or time are no one's partner. Among right rows of
the same time, the one with the largest ``seq`` columns counts.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.operators.keys import materialize


def _changes(batch: pa.RecordBatch, keys: Sequence[str]) -> np.ndarray:
    """Where a row's key differs from that of the row before (first: true)."""
    out = np.zeros(batch.num_rows, bool)
    out[:1] = True
    for k in keys:
        codes = batch.column(k).dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        out[1:] |= codes[1:] != codes[:-1]
    return out


def _key(batch: pa.RecordBatch, keys: Sequence[str], at: int) -> tuple:
    return tuple(batch.column(k)[at].as_py() for k in keys)


def _filled(batch: pa.RecordBatch, keys: Sequence[str], last: tuple | None, carried: pa.Array) -> np.ndarray:
    """For each row the position of the right row that counts: in the batch, or
    ``num_rows`` for the one carried in, or -1."""
    n = batch.num_rows
    at = np.arange(n)
    new = _changes(batch, keys)
    begin = np.maximum.accumulate(np.where(new, at, 0))
    right = batch.column("_tag").to_numpy(zero_copy_only=False) == 0
    found = np.maximum.accumulate(np.where(right, at, -1))
    found = np.where(found >= begin, found, -1)
    if last is not None and len(carried) and _key(batch, keys, 0) == last:
        found[(begin == 0) & (found < 0)] = n
    return found


def _fill(rows: DataFrame, keys: list[str], left: Sequence[str], right_type: T.StructType, carries: dict[int, tuple], out: T.StructType) -> DataFrame:
    """Left rows with the right row that counts, partition by partition."""
    names = [f.name for f in out.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, carried, fresh = None, None, True
        for b in batches:
            if not b.num_rows:
                continue
            rights = b.column("_right")
            if fresh:
                got = carries.get(b.column("_part")[0].as_py())
                last, carried = (got[0], got[1].cast(rights.type)) if got else (None, pa.array([], rights.type))
                fresh = False
            found = _filled(b, keys, last, carried)
            both = pa.concat_arrays([rights, carried])
            of = pa.array(found, mask=found < 0)
            taken = both.take(of)
            is_left = np.flatnonzero(b.column("_tag").to_numpy(zero_copy_only=False) == 1)
            if len(is_left):
                pick = pa.array(is_left)
                mine, theirs = b.column("_left").take(pick), taken.take(pick)
                known = theirs.is_valid()
                cols = [mine.field(i) for i in range(mine.type.num_fields)]
                cols += [pc.if_else(known, theirs.field(i), pa.scalar(None, theirs.type.field(i).type)) for i in range(theirs.type.num_fields)]
                yield pa.RecordBatch.from_arrays(cols, names)
            end = b.num_rows - 1
            last, carried = _key(b, keys, end), taken.slice(end, 1) if found[end] >= 0 else pa.array([], rights.type)

    return rows.mapInArrow(run, out)


def _borders(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(part, last key, whether it is the only one, last right row of it)."""
    key_type = T.StructType([T.StructField(k, rows.schema[k].dataType) for k in keys])
    schema = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("key", key_type), T.StructField("only", T.BooleanType()), T.StructField("right", rows.schema["_right"].dataType)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = None
        for b in batches:
            if not b.num_rows:
                continue
            rights = b.column("_right")
            if part is None:
                part, first, last, carried = b.column("_part")[0].as_py(), _key(b, keys, 0), None, pa.array([], rights.type)
            found = _filled(b, keys, last, carried)
            end = b.num_rows - 1
            held = pa.concat_arrays([rights, carried]).take(pa.array(found[end:], mask=found[end:] < 0))
            last, carried = _key(b, keys, end), held if found[end] >= 0 else pa.array([], rights.type)
            struct = pa.StructArray.from_arrays([b.column(k).slice(end, 1) for k in keys], fields=[b.schema.field(k) for k in keys])
        if part is not None:
            right = carried if len(carried) else pa.nulls(1, rights.type)
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), struct, pa.array([first == last]), right], ["part", "key", "only", "right"])

    return rows.mapInArrow(run, schema)


def asof_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_time: str, right_time: str,
              seq: Sequence[str] = (), allow_exact: bool = True, num_partitions: int | None = None) -> DataFrame:
    """Every left row with the columns of the latest right row of its key (names
    other than ``keys`` must differ). ``allow_exact=False`` takes only right
    rows strictly before the left row's time."""
    keys, seq = list(keys), list(seq)
    taken = [c for c in right.columns if c not in keys]
    clash = set(left.columns) & set(taken)
    if clash:
        raise ValueError(f"columns of both sides that are not keys: {sorted(clash)}")
    if left.schema[left_time].dataType != right.schema[right_time].dataType or any(left.schema[k].dataType != right.schema[k].dataType for k in keys):
        raise ValueError("keys and times must have the same types on both sides")
    spark = left.sparkSession
    own = lambda cols: F.struct(*[F.col(f"`{c}`") for c in cols])
    whole = [F.col(f"`{c}`").isNotNull() for c in (*keys, right_time)]
    for cond in whole:
        right = right.where(cond)
    right_type = T.StructType([T.StructField(c, right.schema[c].dataType) for c in taken])
    left_type = T.StructType([T.StructField(f.name, f.dataType) for f in left.schema.fields])
    # right rows before left rows of the same time, or after them
    tags = (F.lit(0), F.lit(1)) if allow_exact else (F.lit(1), F.lit(0))
    key_cols = [F.col(f"`{k}`") for k in keys]
    seq_type = right.select(own(seq).alias("s")).schema["s"].dataType if seq else T.StructType([T.StructField("x", T.IntegerType())])
    seq_col = own(seq) if seq else F.lit(None).cast(seq_type)
    rights = right.select(*key_cols, F.col(f"`{right_time}`").alias("_time"), tags[0].alias("_order"), F.lit(0).alias("_tag"), seq_col.alias("_seq"), F.lit(None).cast(left_type).alias("_left"), own(taken).cast(right_type).alias("_right"))
    # a left row with a NULL key part or time has no partner: it goes past the sort
    usable = F.lit(True)
    for c in (*keys, left_time):
        usable = usable & F.col(f"`{c}`").isNotNull()
    lefts = left.where(usable).select(*key_cols, F.col(f"`{left_time}`").alias("_time"), tags[1].alias("_order"), F.lit(1).alias("_tag"), F.lit(None).cast(seq_type).alias("_seq"), own(left.columns).cast(left_type).alias("_left"), F.lit(None).cast(right_type).alias("_right"))
    order = [*key_cols, F.col("_time"), F.col("_order"), F.col("_seq")]
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = materialize(rights.unionByName(lefts).repartitionByRange(n, *order).sortWithinPartitions(*order).drop("_time", "_order", "_seq"))
    rows = ranged.withColumn("_part", F.spark_partition_id())
    carries: dict[int, tuple] = {}
    state = None
    borders = _borders(rows.drop("_left"), keys).toArrow().sort_by("part").combine_chunks()  # one row a partition
    for i, part in enumerate(borders.column("part").to_pylist()):
        key = tuple(borders.column("key")[i].as_py().values())
        if state is not None:
            carries[part] = state
        if borders.column("right")[i].is_valid:
            state = (key, pa.array([borders.column("right")[i].as_py()], borders.column("right").type))
        elif not (state is not None and borders.column("only")[i].as_py() and state[0] == key):
            state = None
    out = T.StructType([*left_type.fields, *right_type.fields])
    joined = _fill(rows, keys, left.columns, right_type, carries, out)
    alone = left.where(~usable).select(*[F.col(f"`{c}`") for c in left.columns], *[F.lit(None).cast(f.dataType).alias(f.name) for f in right_type.fields])
    return joined.unionByName(alone)
