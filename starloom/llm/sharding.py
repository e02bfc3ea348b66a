"""Shard placement by a permutation-filled lookup table (operator 4).

Every shard has a preference order over the slots of a table of prime size:
it starts at an offset and steps by a skip, both taken from hashes of its name,
and since the size is prime it meets every slot once. Shards take turns, each
claiming the first free slot of its order, until the table is full; so shares
differ by one slot at most (with weights: a shard takes its turn in proportion
to its weight). When a shard goes, its slots are claimed by others and few of
the remaining ones move.

A key's slot is its hash modulo the table size. The table has ``size`` rows and
nothing else, whatever the data is, so it is broadcast: placement is one probe
for each row, without a shuffle.

Defined results: a null key has a hash like any other value and is placed;
equal keys go to the same shard; an empty table gives no rows.
"""

from __future__ import annotations

import xxhash
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import only

TABLE_SIZE = 65_537
MAX_TABLE_SIZE = 5_000_011  # the table is broadcast: 12 bytes a slot
SEED = 7


def is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def shard_names(n: int) -> list[str]:
    return [f"shard-{i:05d}" for i in range(n)]


def fill_table(names: Sequence[str], size: int = TABLE_SIZE, weights: Sequence[float] | None = None) -> list[int]:
    """Shard number of every slot."""
    if not is_prime(size) or size > MAX_TABLE_SIZE:
        raise ValueError(f"the table size must be a prime up to {MAX_TABLE_SIZE}")
    if not names or len(set(names)) != len(names) or len(names) > size:
        raise ValueError("shard names must be distinct, at least one and no more than there are slots")
    weights = list(weights or [1.0] * len(names))
    if len(weights) != len(names) or min(weights) <= 0:
        raise ValueError("one positive weight for each shard")
    top = max(weights)
    at = [xxhash.xxh64_intdigest(n.encode(), SEED) % size for n in names]
    skip = [xxhash.xxh64_intdigest(n.encode(), SEED + 1) % (size - 1) + 1 for n in names] if size > 2 else [1] * len(names)
    table, left, credit = [-1] * size, size, [0.0] * len(names)
    while left:
        for i in range(len(names)):
            credit[i] += weights[i] / top
            if credit[i] < 1:
                continue
            credit[i] -= 1
            while table[at[i]] >= 0:
                at[i] = (at[i] + skip[i]) % size
            table[at[i]] = i
            left -= 1
            if not left:
                break
    return table


def lookup_table(spark: SparkSession, table: Sequence[int], names: Sequence[str]) -> DataFrame:
    """(slot, shard, shard_name) of a filled table, one row for each slot."""
    return spark.createDataFrame([(i, s, names[s]) for i, s in enumerate(table)], "slot int, shard int, shard_name string")


def place(rows: DataFrame, key: str, names: Sequence[str], size: int = TABLE_SIZE, weights: Sequence[float] | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """The key and the columns ``keep`` of rows with slot, shard and shard_name."""
    clash = {key, *keep} & {"slot", "shard", "shard_name"}
    if clash:
        raise ValueError(f"columns that this operator sets itself: {sorted(clash)}")
    table = lookup_table(rows.sparkSession, fill_table(names, size, weights), names)
    keyed = only(rows, key, *[k for k in keep if k != key]).withColumn("slot", F.pmod(F.xxhash64(F.col(f"`{key}`")), F.lit(size)).cast("int"))
    out = keyed.join(F.broadcast(table), "slot")
    return out.select(*[F.col(f"`{c}`") for c in keyed.columns], "shard", "shard_name")


def write_shards(placed: DataFrame, path: str, files_per_shard: int = 1) -> None:
    """Writes placed rows as Parquet, a folder for each shard. With more than
    one file a shard, rows are dealt to its files by a hash of all columns, so
    that a key that holds much of the data does not end in one task."""
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in placed.columns]), F.lit(files_per_shard))
    placed.withColumn("_salt", salt).repartition("shard", "_salt").drop("_salt").write.partitionBy("shard").parquet(path)
