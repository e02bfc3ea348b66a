"""Size-checked broadcast and skew-tolerant equi-joins."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.operators import bloom
from starloom.operators.keys import materialize

# The sides that one plan broadcasts are proven to hold together at most this
# many rows and bytes of column data (both can be set in the session); larger
# sides are shuffle-joined, where AQE splits skewed partitions.
MAX_ROWS_CONF = "starloom.broadcast.maxRows"
MAX_BYTES_CONF = "starloom.broadcast.maxBytes"
BROADCAST_MAX_ROWS = 2_000_000
BROADCAST_MAX_BYTES = 256 * 1024 * 1024

_FIXED_WIDTH = 8  # bytes counted per non-string value (an upper bound for scalars)


def _row_bytes(df: DataFrame) -> Column:
    parts = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            parts.append(F.coalesce(F.octet_length(F.col(f.name)), F.lit(0)))
        else:
            parts.append(F.lit(_FIXED_WIDTH))
    return sum(parts[1:], parts[0]) if parts else F.lit(0)


def budget(spark: SparkSession) -> tuple[int, int]:
    """(rows, bytes) that the broadcast sides of one plan may hold together."""
    return (int(spark.conf.get(MAX_ROWS_CONF, str(BROADCAST_MAX_ROWS))),
            int(spark.conf.get(MAX_BYTES_CONF, str(BROADCAST_MAX_BYTES))))


def sizes(sides: Sequence[DataFrame]) -> list[tuple[int, int]]:
    """(rows, bytes of column data) of every side, in one aggregate. Each
    partition sends one partial (count, bytes) row, so no task gathers rows (a
    ``limit`` would funnel up to ``partitions * max_rows`` rows into a single
    task), and there is one exchange for all sides."""
    tagged = [df.select(F.lit(i).alias("i"), _row_bytes(df).cast("long").alias("b")) for i, df in enumerate(sides)]
    sums = reduce(DataFrame.unionAll, tagged).groupBy("i").agg(F.count(F.lit(1)).alias("n"), F.sum("b").alias("b"))
    found = {r["i"]: (r["n"], r["b"] or 0) for r in sums.collect()}
    return [found.get(i, (0, 0)) for i in range(len(sides))]


def _chosen(measured: Sequence[tuple[int, int]], spark: SparkSession, max_rows: int | None = None,
            max_bytes: int | None = None) -> list[bool]:
    rows, size = budget(spark)
    rows = rows if max_rows is None else max_rows
    size = size if max_bytes is None else max_bytes
    chosen = [False] * len(measured)
    for i in sorted(range(len(measured)), key=lambda i: (measured[i][1], measured[i][0])):
        n, b = measured[i]
        if n > rows or b > size:
            break
        chosen[i], rows, size = True, rows - n, size - b
    return chosen


def within_budget(sides: Sequence[DataFrame], max_rows: int | None = None,
                  max_bytes: int | None = None) -> list[bool]:
    """Which sides may be broadcast in one plan: the smallest first, as long
    as all of them together stay within the budget."""
    return _chosen(sizes(sides), sides[0].sparkSession, max_rows, max_bytes)


def fits_broadcast(df: DataFrame, max_rows: int | None = None, max_bytes: int | None = None) -> bool:
    """True when ``df`` alone stays within the broadcast budget."""
    return within_budget([df], max_rows, max_bytes)[0]


def fits_budget(spark: SparkSession, size: tuple[int, int], max_rows: int | None = None,
                max_bytes: int | None = None) -> bool:
    """True when a side of at most ``size`` (rows, bytes) stays within the
    broadcast budget by itself."""
    return _chosen([size], spark, max_rows, max_bytes)[0]


def all_fit(spark: SparkSession, measured: Sequence[tuple[int, int]], max_rows: int | None = None) -> bool:
    """True when sides of these (rows, bytes) can all be broadcast in one plan."""
    return all(_chosen(measured, spark, max_rows))


def sized(df: DataFrame, max_rows: int | None = None,
          max_bytes: int | None = None) -> tuple[DataFrame, bool]:
    """(``df`` with a broadcast hint, True) if its size is proven small,
    else (``df``, False)."""
    small = fits_broadcast(df, max_rows, max_bytes)
    return (F.broadcast(df) if small else df), small


def small_side(df: DataFrame, max_rows: int | None = None, max_bytes: int | None = None,
               size: tuple[int, int] | None = None) -> DataFrame:
    """``df`` with a broadcast hint if its size is proven small, else as is.
    ``size``: (rows, bytes) it is known not to exceed, instead of measuring."""
    if size is not None:
        return F.broadcast(df) if fits_budget(df.sparkSession, size, max_rows, max_bytes) else df
    return sized(df, max_rows, max_bytes)[0]


def join_sides(big: DataFrame, sides: dict[str, DataFrame], how: str = "inner",
               bounds: Sequence[DataFrame] | None = None, max_rows: int | None = None,
               measured: Sequence[tuple[int, int]] | None = None) -> DataFrame:
    """``big`` joined to each side by the key column that names it.

    Sides that fit the plan's budget together are joined map-side. Each of the
    others costs one shuffle of ``big``, of the rows that may find a partner
    only (a Bloom filter of the side's keys, probed before the exchange); the
    sort-merge hint keeps Catalyst from broadcasting it after all on a wrong
    estimate, and AQE splits the partition of a hot key. So that no shuffle
    carries what a later join can still add, wide sides come after narrow ones
    and, if they are joined map-side, after every shuffle.
    ``bounds`` gives cheaper frames that are at least as large as the sides, to
    be measured in their place; their first column holds all keys of the side.
    ``measured`` gives (rows, bytes) that are known already, at least as large."""
    bounds = list(bounds or [side.select(key, *[c for c in side.columns if c != key]) for key, side in sides.items()])
    measured = sizes(bounds) if measured is None else measured
    small = _chosen(measured, big.sparkSession, max_rows)
    width = [b / max(1, n) for n, b in measured]
    # a semi join adds nothing; a number for a key adds no width
    first = [s and (how == "left_semi" or w <= 2 * _FIXED_WIDTH) for s, w in zip(small, width)]
    order = sorted(range(len(sides)), key=lambda i: (not first[i], small[i], width[i]))
    for i in order:
        key, side = list(sides.items())[i]
        if small[i]:
            big = big.join(F.broadcast(side), key, how)
            continue
        if how in ("inner", "left_semi"):
            keys = bounds[i].select(F.col(bounds[i].columns[0]).alias(key))
            big = bloom.reduce_by(big, bloom.build(keys, [key], measured[i][0]), [key])
        big = big.join(side.hint("merge"), key, how)
    return big


def semi_join(big: DataFrame, side: DataFrame, on: Sequence[str], max_rows: int | None = None) -> DataFrame:
    """Rows of ``big`` that have a partner in ``side``. A side within the
    budget is broadcast; for any other, a Bloom filter of its keys drops most
    rows without one before the exchange."""
    keys, on = side.select(*on), list(on)
    (n, size), = sizes([keys])
    if _chosen([(n, size)], big.sparkSession, max_rows)[0]:
        return big.join(F.broadcast(keys), on, "left_semi")
    return bloom.reduce_by(big, bloom.build(keys, on, n), on).join(keys.hint("merge"), on, "left_semi")


def anti_join(big: DataFrame, side: DataFrame, on: Sequence[str], max_rows: int | None = None,
              narrow: DataFrame | None = None) -> DataFrame:
    """Rows of ``big`` without a partner in ``side`` (NULL keys have none).

    A side within the budget is broadcast. For any other, rows that its Bloom
    filter does not know pass map-side. The others are decided on ``narrow``
    if given: a frame with the key columns of all rows of ``big`` and little
    else. Of its rows that the filter knows, those without a partner (the false
    positives) are broadcast if they are within the budget, so no row of
    ``big`` is shuffled; if not, or without ``narrow``, the rows of ``big``
    that the filter knows are shuffle-joined."""
    keys, on = side.select(*on), list(on)
    (n, size), = sizes([keys])
    if _chosen([(n, size)], big.sparkSession, max_rows)[0]:
        return big.join(F.broadcast(keys), on, "left_anti")
    known = bloom.build(keys, on, n)
    marked = bloom.with_match(big, known, on)
    surely, maybe = marked.where("not _may_match").drop("_may_match"), marked.where("_may_match").drop("_may_match")
    if narrow is not None:
        false = materialize(bloom.reduce_by(narrow.select(*on), known, on).join(keys.hint("merge"), on, "left_anti").distinct())
        if fits_broadcast(false):
            return surely.unionByName(maybe.join(F.broadcast(false), on, "left_semi"))
    return surely.unionByName(maybe.join(keys.hint("merge"), on, "left_anti"))


def salted_join(big: DataFrame, small: DataFrame, on: Sequence[str], how: str = "inner",
                salt: int = 16, salt_from: Sequence[str] | None = None) -> DataFrame:
    """Equi-join for a hot key on the big side when the small side cannot be
    broadcast: big rows get a deterministic salt (hash of ``salt_from``
    columns, so recomputation after an executor loss routes them the same
    way) and the small side is replicated ``salt`` times."""
    cols = list(salt_from or [c for c in big.columns if c not in on])
    salt_col = F.pmod(F.xxhash64(*cols), F.lit(salt)) if cols else F.lit(0)
    b = big.withColumn("_salt", salt_col.cast("int"))
    s = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
    return b.join(s, [*on, "_salt"], how).drop("_salt")
