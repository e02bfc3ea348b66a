"""Interval join by bins.

Two tables with closed intervals [start, end] are joined where their intervals
meet. Time is cut into bins, so the join is one equi-join on the bin:

* Bins have levels, each twice as wide as the one before. An interval belongs
  to the lowest level whose bins are at least as long as it, so it touches at
  most two of them; the width of level 0 is measured (the tenth percentile of
  the lengths above 0). An interval is entered at its own level, and at the
  higher levels that the other side has. A pair meets on the higher of its two
  levels, where both touch at most two bins: however long an interval is, it
  is replicated no more than twice per level, and levels grow with the
  logarithm of the lengths.
* A pair with two common bins is emitted in the first one.
* Bins with more than ``bin_rows`` entries of a side are dealt into a grid of
  cells by a hash of the row, so a bin that holds a third of the rows is spread
  over many tasks. The counts are aggregates of the entries' bins alone.

With ``keys``, bins serve only keys with many rows on both sides: the rows of
any other key meet on the key alone (at most ``KEY_ROWS`` candidates a row), so
they are neither replicated nor entered at levels.

With ``sums`` the pairs are counted and summed up for each left row without
being listed. The partners of [a, b] are the right intervals that start at or
before b, less those that end before a: two running totals over the sorted
bounds, whose cost grows with the rows and not with the pairs.

Rows with a NULL bound or key, or an end before the start, meet nothing.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.operators.joins import small_side
from starloom.operators.keys import materialize

BIN_ROWS = 50_000
KEY_ROWS = 128  # rows of the smaller side of a key that is joined without bins


def whole_number(df: DataFrame, column: str) -> Column:
    """A bound as a whole number that keeps the order: integers as they are,
    dates in days, timestamps in microseconds."""
    kind, c = df.schema[column].dataType, F.col(f"`{column}`")
    if isinstance(kind, T.IntegralType):
        return c.cast("long")
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("long")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp"))
    raise ValueError(f"interval bounds of type {kind.simpleString()} are not supported")


def _bounded(df: DataFrame, on: tuple[str, str], keys: Sequence[str], half_open: bool) -> DataFrame:
    start, end = (whole_number(df, c) for c in on)
    if half_open and on[0] != on[1]:
        end = end - 1  # the last instant inside
    out = df.withColumns({"_start": start, "_end": end}).where("_start <= _end")
    for k in keys:
        out = out.where(F.col(f"`{k}`").isNotNull())
    return out


def measured(sides: Sequence[DataFrame]) -> tuple[int, int]:
    """(width of level 0: the tenth percentile of the lengths above 0, the
    largest length), in one job."""
    lengths = [s.select((F.col("_end") - F.col("_start")).alias("n")) for s in sides]
    both = lengths[0].unionAll(lengths[1])
    found, longest = both.agg(F.percentile_approx(F.when(F.col("n") > 0, F.col("n")), 0.1), F.max("n")).first()
    return max(1, int(found or 1)), int(longest or 0)


def _with_level(df: DataFrame, width: int, longest: int) -> DataFrame:
    length = F.col("_end") - F.col("_start")
    level, n = F.lit(0), 1
    while width << (n - 1) < longest:  # the lowest level whose bins are at least as long
        level = F.when(length > (width << (n - 1)), F.lit(n)).otherwise(level)
        n += 1
    return df.withColumn("_own", level.cast("int"))


def _entries(df: DataFrame, width: int, other: Sequence[int]) -> DataFrame:
    """A row for each bin of each level an interval is entered at."""
    known = F.array(*[F.lit(x) for x in sorted(other)]).cast("array<int>")
    higher = F.filter(known, lambda x: x > F.col("_own"))
    own = F.when(F.exists(known, lambda x: x <= F.col("_own")), F.array("_own")).otherwise(F.array().cast("array<int>"))
    at = df.withColumn("_level", F.explode(F.concat(own, higher)))
    size = F.lit(width).cast("long") * F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_level"))
    # a bin is named by where it begins; pmod rounds down below zero too
    number = lambda c: (F.col(c) - F.pmod(F.col(c), size)).cast("long")
    at = at.withColumns({"_first": number("_start"), "_last": number("_end")})
    return at.withColumn("_bin", F.explode(F.array_distinct(F.array("_first", "_last"))))


def _meets() -> Column:
    return (F.col("_a_start") <= F.col("_b_end")) & (F.col("_b_start") <= F.col("_a_end"))


def crowded_keys(sides: Sequence[DataFrame], keys: Sequence[str], bin_rows: int, key_rows: int = KEY_ROWS) -> DataFrame:
    """Keys with more than ``key_rows`` rows on both sides, or more than
    ``bin_rows`` on one, that come up on both."""
    counts = [s.groupBy(*keys).agg(F.count(F.lit(1)).alias(n)) for s, n in zip(sides, ("_l", "_r"))]
    both = counts[0].join(counts[1], list(keys))
    few = (F.least("_l", "_r") <= min(key_rows, bin_rows)) & (F.greatest("_l", "_r") <= bin_rows)
    return materialize(both.where(~few).select(*keys))


def _running(line: DataFrame, order: Sequence[str], totals: Sequence[str]) -> DataFrame:
    """Totals up to and including each row in ``order`` (its values are unique
    together). Range partitions are summed apart; one row a partition gives
    what comes before it."""
    ranged = materialize(line.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    upto = W.partitionBy("_part").orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    parts = ranged.groupBy("_part").agg(*[F.sum(c).alias(c) for c in totals])
    earlier = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)  # one row a partition
    before = parts.select("_part", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"_before{c}") for c in totals])
    sums = ranged.withColumns({f"_upto{c}": F.sum(c).over(upto) for c in totals}).join(F.broadcast(before), "_part")
    return sums.withColumns({f"_upto{c}": F.col(f"_upto{c}") + F.col(f"_before{c}") for c in totals})


def _summed(sides: Sequence[DataFrame], columns: Sequence[str], keys: Sequence[str], sums: Mapping[str, Column], rows: str) -> DataFrame:
    """Left rows that meet any right row, with the number of those and sums of
    their whole numbers."""
    left, right = sides
    exact = lambda c: c.cast("decimal(38,0)")
    # a total counts rows that have started (s) or ended (e); NULLs are counted apart
    amounts = {"n": F.lit(1)}
    for i, value in enumerate(sums.values()):
        amounts |= {f"v{i}": F.coalesce(value, F.lit(0)), f"k{i}": value.isNotNull().cast("int")}
    right = right.select(*keys, "_start", "_end", *[c.cast("long").alias(f"_m{name}") for name, c in amounts.items()])
    nothing = lambda way: [F.lit(None).cast("long").alias(f"_{way}{name}") for name in amounts]
    marks = [right.select(*keys, F.col(at).alias("_t"), *[x for w in ("s", "e") for x in ([F.col(f"_m{n}").alias(f"_{w}{n}") for n in amounts] if w == way else nothing(w))])
             for at, way in (("_start", "s"), ("_end", "e"))]
    marks += [left.select(*keys, F.col(at).alias("_t"), *nothing("s"), *nothing("e")) for at in ("_start", "_end")]
    totals = [f"_{w}{n}" for w in ("s", "e") for n in amounts]
    # a place of many rows is one row of the line
    line = reduce(DataFrame.unionAll, marks).groupBy(*keys, "_t").agg(*[F.coalesce(F.sum(exact(F.col(c))), F.lit(0)).cast("decimal(38,0)").alias(c) for c in totals])
    # The totals run over all keys: of the keys before, all rows have started and ended.
    line = _running(line, [*keys, "_t"], totals)
    started = line.select(*keys, F.col("_t").alias("_end"), *[F.col(f"_upto_s{n}").alias(f"_s{n}") for n in amounts])
    ended = line.select(*keys, F.col("_t").alias("_start"), *[(F.col(f"_upto_e{n}") - F.col(f"_e{n}")).alias(f"_e{n}") for n in amounts])
    found = left.join(started, [*keys, "_end"]).join(ended, [*keys, "_start"])
    amount = lambda n: (F.col(f"_s{n}") - F.col(f"_e{n}")).cast("long")
    out = [F.when(amount(f"k{i}") > 0, amount(f"v{i}")).alias(name) for i, name in enumerate(sums)]
    return found.where(amount("n") > 0).select(*[F.col(f"`{c}`") for c in columns], amount("n").alias(rows), *out)


def interval_join(left: DataFrame, right: DataFrame, left_on: tuple[str, str], right_on: tuple[str, str],
                  keys: Sequence[str] = (), half_open: bool = False, width: int | None = None,
                  bin_rows: int = BIN_ROWS, key_rows: int = KEY_ROWS, rows: str = "rows",
                  sums: Mapping[str, Column] | None = None) -> DataFrame:
    """Pairs of rows whose intervals meet, with all columns of both sides
    (``keys``, equal on both sides, come once; other names must differ).

    ``left_on`` and ``right_on`` name start and end; the same column twice makes
    a point. ``half_open`` takes the end as outside (points stay points).

    With ``sums`` (name: whole number of a right row) the result is each left
    row that has a partner, with their number (``rows``) and those sums."""
    keys = list(keys)
    clash = (set(left.columns) & set(right.columns)) - set(keys)
    if clash:
        raise ValueError(f"columns of both sides that are not keys: {sorted(clash)}")
    sides = [_bounded(left, left_on, keys, half_open), _bounded(right, right_on, keys, half_open)]
    if sums is not None:
        return _summed(sides, left.columns, keys, sums, rows)
    others = [F.col(f"`{c}`") for c in (*left.columns, *right.columns) if c not in keys]
    if not keys:
        return _binned(sides, left, right, keys, width, bin_rows).select(*others)
    crowded = crowded_keys(sides, keys, bin_rows, key_rows)
    a, b = (s.withColumnsRenamed({"_start": f"_{x}_start", "_end": f"_{x}_end"}) for s, x in zip(sides, "ab"))
    if crowded.isEmpty():
        return a.join(b, keys).where(_meets()).select(*keys, *others)
    crowded = small_side(crowded)
    few = a.join(crowded, keys, "left_anti").join(b, keys).where(_meets()).select(*keys, *others)
    many = _binned([s.join(crowded, keys, "left_semi") for s in sides], left, right, keys, width, bin_rows)
    return few.unionAll(many.select(*keys, *others))


def _binned(sides: Sequence[DataFrame], left: DataFrame, right: DataFrame, keys: Sequence[str], width: int | None, bin_rows: int) -> DataFrame:
    """Pairs that meet, by levels and bins."""
    narrow, longest = measured(sides)
    width = width or narrow
    sides = [_with_level(s, width, longest) for s in sides]
    levels: list[set[int]] = [set(), set()]  # at most one number a level
    tagged = sides[0].select(F.lit(0).alias("i"), "_own").unionAll(sides[1].select(F.lit(1).alias("i"), "_own"))
    for r in tagged.distinct().collect():
        levels[r["i"]].add(r["_own"])
    place = [*keys, "_level", "_bin"]
    entries = [_entries(sides[0], width, sorted(levels[1])), _entries(sides[1], width, sorted(levels[0]))]
    counts = [e.groupBy(*place).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > bin_rows) for e in entries]
    parts = [c.select(*place, F.ceil(F.col("n") / bin_rows).cast("int").alias(p)) for c, p in zip(counts, ("_l", "_r"))]
    hot = small_side(materialize(parts[0].join(parts[1], place, "full")))
    dealt = []
    for i, (e, own, other) in enumerate(((entries[0], "_l", "_r"), (entries[1], "_r", "_l"))):
        row = F.xxhash64(*[F.col(f"`{c}`") for c in (left, right)[i].columns])
        e = e.join(hot, place, "left")
        own_part = F.pmod(row, F.coalesce(own, F.lit(1))).cast("int")
        others = F.explode(F.sequence(F.lit(0), F.coalesce(other, F.lit(1)) - 1))
        dealt.append(e.withColumns({"_own_part": own_part}).withColumn("_other_part", others).drop("_l", "_r"))
    a = dealt[0].withColumnsRenamed({"_own_part": "_lp", "_other_part": "_rp", "_own": "_a_own", "_first": "_a_first", "_start": "_a_start", "_end": "_a_end"}).drop("_last")
    b = dealt[1].withColumnsRenamed({"_own_part": "_rp", "_other_part": "_lp", "_own": "_b_own", "_first": "_b_first", "_start": "_b_start", "_end": "_b_end"}).drop("_last")
    joined = a.join(b, [*place, "_lp", "_rp"])
    once = (F.greatest("_a_own", "_b_own") == F.col("_level")) & (F.greatest("_a_first", "_b_first") == F.col("_bin"))
    return joined.where(_meets() & once)
