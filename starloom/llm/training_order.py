"""Training-order materialisation (operator 1).

Every sequence gets a global slot by a keyed pseudo-random permutation of
0 .. n-1: a Feistel network over the next even power of two, walked along its
cycle until the value is below n (at most four steps on average). The slot
follows from the sequence's number alone, so no sort, no random column and no
table of the order is needed, and the inverse tells which sequence a slot holds.

A shard is read as a whole by one task, so ``shard_rows`` times the record
length, times a few copies, has to fit the memory of an executor's slot.

Shard s holds the slots from s * shard_rows on, in order, as records of one
fixed length: the ids as little-endian integers, filled up with the padding
value, and a line feed. A slot's bytes are found by arithmetic alone, reading is
sequential, and a reader resumes from the number of its next slot.

Each shard is one range partition of the slots and one file, written by Spark's
text writer (a record is raw bytes to it) to any file system Spark reaches.

Sequences are numbered densely from their place in a stored copy of the input:
only one count per partition goes through the driver and back as a broadcast
table with one row per partition.

Defined results: null tokens are the empty sequence; repeated rows get a slot
each; longer sequences than ``stride`` tokens are an error; an empty table
gives no shards.
"""

from __future__ import annotations

import hashlib
import json
import zlib
from collections.abc import Callable, Iterator
from dataclasses import asdict, dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import stored

ROUNDS = 8
SHARD_ROWS = 2_048
_ROW_BITS = 33  # monotonically_increasing_id: partition << 33 | row


@dataclass(frozen=True)
class Permutation:
    """Keyed permutation of 0 .. n-1 and its inverse, on arrays."""

    n: int
    key: str
    rounds: int = ROUNDS

    @property
    def half(self) -> int:
        """Bits of each half of the network's values."""
        return max(1, ((self.n - 1).bit_length() + 1) // 2)

    def _keys(self) -> list[int]:
        return [int.from_bytes(hashlib.sha256(f"{self.key}/{r}".encode()).digest()[:8], "little") for r in range(self.rounds)]

    def _mix(self, x: np.ndarray, key: int) -> np.ndarray:
        """Round function: multiply-xorshift of value and round key."""
        with np.errstate(over="ignore"):
            x = x + np.uint64(key)
            for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
                x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        return (x ^ (x >> np.uint64(31))) & np.uint64((1 << self.half) - 1)

    def _pass(self, x: np.ndarray, keys: list[int], back: bool) -> np.ndarray:
        bits = np.uint64(self.half)
        left, right = x >> bits, x & np.uint64((1 << self.half) - 1)
        for key in reversed(keys) if back else keys:
            if back:
                left, right = right ^ self._mix(left, key), left
            else:
                left, right = right, left ^ self._mix(right, key)
        return left << bits | right

    def _walk(self, x: np.ndarray, back: bool) -> np.ndarray:
        x = np.asarray(x)
        if len(x) and (x.min() < 0 or x.max() >= self.n):
            raise ValueError("value outside of the permutation")
        keys, out = self._keys(), self._pass(x.astype(np.uint64), self._keys(), back)
        while len(far := np.flatnonzero(out >= np.uint64(self.n))):
            out[far] = self._pass(out[far], keys, back)
        return out.astype(np.int64)

    def slot(self, index: np.ndarray) -> np.ndarray:
        return self._walk(index, False)

    def index(self, slot: np.ndarray) -> np.ndarray:
        return self._walk(slot, True)


@dataclass(frozen=True)
class Layout:
    """What a reader has to know about a folder of shards."""

    n: int
    stride: int
    shard_rows: int
    dtype: str
    pad: int
    key: str

    @property
    def record(self) -> int:
        """Bytes of a record, line feed included."""
        return self.stride * np.dtype(self.dtype).itemsize + 1


def numbered(rows: DataFrame, name: str = "sequences") -> tuple[DataFrame, int]:
    """(rows with ``_index`` 0 .. n-1, n), stored in the shared folder."""
    rows = stored(rows.withColumn("_at", F.monotonically_increasing_id()), name, level=9)
    part = F.shiftright("_at", _ROW_BITS)
    counts = {r["p"]: r["n"] for r in rows.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()}
    offsets, n = [], 0
    for p in sorted(counts):
        offsets.append((p, n))
        n += counts[p]
    table = rows.sparkSession.createDataFrame(offsets, "_part long, _offset long")
    joined = rows.withColumn("_part", part).join(F.broadcast(table), "_part")
    return joined.withColumn("_index", F.col("_offset") + F.col("_at") - F.shiftleft("_part", _ROW_BITS)).drop("_at", "_part", "_offset"), n


def slot_of(index: Column, order: Permutation) -> Column:
    @F.pandas_udf("long")
    def slots(values: pd.Series) -> pd.Series:
        return pd.Series(order.slot(values.to_numpy()))

    return slots(index)


def write_shards(sequences: DataFrame, path: str, key: str, stride: int, dtype: str = "<u2", shard_rows: int = SHARD_ROWS) -> Layout:
    """Writes (tokens: bytes of ``dtype`` ids) as shards below ``path``. The
    largest value of the type is the padding and no id."""
    size = np.dtype(dtype).itemsize
    pad = int(np.iinfo(dtype).max)
    rows, n = numbered(sequences.select("tokens"))
    layout = Layout(n, stride, shard_rows, dtype, pad, key)
    tokens = F.coalesce("tokens", F.lit(b""))
    fits = F.assert_true(F.octet_length(tokens) <= stride * size, F.lit("a sequence is longer than the stride"))
    record = F.rpad(tokens, F.lit(stride * size), F.lit(b"\xff" * size))
    rows = rows.where(fits.isNull()).select(slot_of(F.col("_index"), Permutation(max(1, n), key)).alias("slot"), record.cast("string").alias("record"))
    rows = rows.withColumn("shard", F.expr(f"cast(slot div {shard_rows} as int)"))
    shards = max(1, -(-n // shard_rows))
    dealt = rows.repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "slot")
    dealt.select("record", "shard").write.partitionBy("shard").text(f"{path}/shards")
    sequences.sparkSession.createDataFrame([(json.dumps(asdict(layout)),)], "value string").coalesce(1).write.text(f"{path}/layout")
    return layout


def read_layout(spark: SparkSession, path: str) -> Layout:
    return Layout(**json.loads(spark.read.text(f"{path}/layout").first()["value"]))


_DESCRIBED = "sequence_index long, slot long, shard int, offset long, n_tokens long, ids_crc32 long"


def read_slots(spark: SparkSession, path: str, start: int = 0, stop: int | None = None, describe: bool = False) -> DataFrame:
    """(slot, shard, offset, tokens) of the slots from ``start`` up to ``stop``:
    only the shards of that range are read, each as one file. ``offset`` is the
    record's first byte in its shard. With ``describe`` the rows are those of
    :func:`described`, made by the worker that reads the shard: a pass of its
    own would hold a second worker for each task."""
    layout = read_layout(spark, path)
    stop = layout.n if stop is None else min(stop, layout.n)
    schema = _DESCRIBED if describe else "slot long, shard int, offset long, tokens binary"
    if start >= stop:
        return spark.createDataFrame([], schema)
    end = layout.record

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pad = np.array(layout.pad, layout.dtype).tobytes()
        for b in batches:
            for shard, content in zip(b.column("shard").to_pylist(), b.column("content"), strict=True):
                view = memoryview(content.as_buffer())
                rows = len(view) // end
                if rows * end != len(view):
                    raise ValueError(f"shard {shard} is not a whole number of records")
                first = shard * layout.shard_rows
                wanted = range(max(start - first, 0), min(stop - first, rows))
                for at in range(wanted.start, wanted.stop, 1024):
                    some = range(at, min(at + 1024, wanted.stop))
                    ids = np.frombuffer(view, np.uint8)[some.start * end : some.stop * end].reshape(-1, end)[:, :-1].copy().view(layout.dtype)
                    n = layout.stride - (ids[:, ::-1] != layout.pad).argmax(axis=1)
                    n[(ids == layout.pad).all(axis=1)] = 0
                    yield pa.RecordBatch.from_arrays([pa.array([first + i for i in some], pa.int64()), pa.array([shard] * len(some), pa.int32()), pa.array([i * end for i in some], pa.int64()), pa.array([r[:m].tobytes() for r, m in zip(ids, n.tolist(), strict=True)], pa.binary())], ["slot", "shard", "offset", "tokens"])

    first, last = start // layout.shard_rows, (stop - 1) // layout.shard_rows
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/shards")
    wanted_files = files.where(F.col("shard").between(first, last)).select(F.col("shard").cast("int"), "content")
    digests = _digests(layout)
    return wanted_files.mapInArrow((lambda batches: digests(run(batches))) if describe else run, schema)


def _digests(layout: Layout) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = Permutation(max(1, layout.n), layout.key)
        for b in batches:
            ids = [np.frombuffer(t, layout.dtype).astype("<u4") for t in b.column("tokens").to_pylist()]
            index = order.index(b.column("slot").to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array(index), b.column("slot"), b.column("shard"), b.column("offset"), pa.array([len(i) for i in ids], pa.int64()), pa.array([zlib.crc32(i.tobytes()) for i in ids], pa.int64())], ["sequence_index", "slot", "shard", "offset", "n_tokens", "ids_crc32"])

    return run


def described(slots: DataFrame, layout: Layout) -> DataFrame:
    """(sequence_index, slot, shard, offset, n_tokens, ids_crc32) of slots read
    back; the CRC-32 is over the ids as little-endian unsigned 32-bit integers."""
    return slots.mapInArrow(_digests(layout), _DESCRIBED)
