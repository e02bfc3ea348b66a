"""Grouping-set lattice with mergeable measures.

``GROUP BY GROUPING SETS`` expands every input row once per set before it
aggregates. Here the fact table is aggregated once, at the finest grain, into
mergeable partials; every coarser set is computed from the smallest set above
it that is already there. The fact rows are shuffled once, whatever the number
of sets.

A :class:`Measure` says how a value starts (``partial``, an aggregate of input
rows), how partials merge and how the result is read off. Besides sums, counts,
extremes and averages there are sketches: distinct counts (HyperLogLog, of
2 ** ``lg_k`` registers, relative standard error about 1.04 / sqrt(2 ** lg_k))
and quantiles (KLL with parameter ``k``, rank error about 2 / k). Their size is bounded whatever
they count, and their partials may be stored per fact grain and merged by any
later rollup (:func:`partials`, :func:`rolled_up`).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.operators.keys import materialize

LG_K = 12
KLL_K = 400


@dataclass(frozen=True)
class Measure:
    """``partial`` and ``merge`` name one aggregate for each part that is
    kept; ``merge`` and ``read`` get the parts' columns."""

    name: str
    partial: tuple[Column, ...]
    merge: tuple[Callable[[Column], Column], ...]
    read: Callable[..., Column]

    @property
    def parts(self) -> list[str]:
        return [f"_{self.name}_{i}" for i in range(len(self.partial))]


def total(name: str, value: Column) -> Measure:
    return Measure(name, (F.sum(value),), (F.sum,), lambda x: x)


def rows(name: str) -> Measure:
    return Measure(name, (F.count(F.lit(1)),), (F.sum,), lambda x: F.coalesce(x, F.lit(0).cast("long")))


def least(name: str, value: Column) -> Measure:
    return Measure(name, (F.min(value),), (F.min,), lambda x: x)


def largest(name: str, value: Column) -> Measure:
    return Measure(name, (F.max(value),), (F.max,), lambda x: x)


def average(name: str, value: Column) -> Measure:
    """Mean of the values that are not NULL, as a double."""
    return Measure(name, (F.sum(value), F.count(value)), (F.sum, F.sum), lambda s, n: F.try_divide(s.cast("double"), n.cast("double")))


def distinct_estimate(name: str, value: Column, lg_k: int = LG_K) -> Measure:
    """Estimated number of different values that are not NULL."""
    empty = F.lit(0).cast("long")
    return Measure(name, (F.hll_sketch_agg(value, lg_k),), (lambda c: F.hll_union_agg(c, False),), lambda s: F.coalesce(F.hll_sketch_estimate(s), empty))


def quantiles(name: str, value: Column, ranks: Sequence[float], k: int = KLL_K) -> Measure:
    """Estimated values at the given ranks (an array of longs), NULL without values."""
    at = F.array(*[F.lit(float(r)) for r in ranks])
    sketch = F.kll_sketch_agg_bigint(value.cast("long"), k)
    counted = lambda s: F.when(F.kll_sketch_get_n_bigint(s) > 0, F.kll_sketch_get_quantile_bigint(s, at))
    return Measure(name, (sketch,), (lambda c: F.kll_merge_agg_bigint(c, k),), counted)


def partials(df: DataFrame, dims: Sequence[str], measures: Sequence[Measure]) -> DataFrame:
    """The dimensions and the parts of every measure at the grain of
    ``dims``: what a table of mergeable aggregates stores."""
    return df.groupBy(*dims).agg(*[c.alias(p) for m in measures for c, p in zip(m.partial, m.parts)])


def merged(parts: DataFrame, dims: Sequence[str], measures: Sequence[Measure]) -> DataFrame:
    """Parts at a coarser grain."""
    return parts.groupBy(*dims).agg(*[f(F.col(p)).alias(p) for m in measures for f, p in zip(m.merge, m.parts)])


def read_off(parts: DataFrame, keep: Sequence[Column], measures: Sequence[Measure]) -> DataFrame:
    return parts.select(*keep, *[m.read(*[F.col(p) for p in m.parts]).alias(m.name) for m in measures])


def rolled_up(parts: DataFrame, dims: Sequence[str], measures: Sequence[Measure]) -> DataFrame:
    """Results at the grain of ``dims``, from stored parts of a finer one."""
    return read_off(merged(parts, dims, measures), [F.col(d) for d in dims], measures)


def grouping_sets(df: DataFrame, sets: Sequence[Sequence[str]], measures: Sequence[Measure]) -> DataFrame:
    """All sets in one table: the dimensions (NULL where a set leaves one out),
    ``grouping_id`` (a bit for each dimension that is left out, the first one
    highest) and the measures. As in SQL, the empty set has one row even
    without input."""
    dims = list(dict.fromkeys(d for s in sets for d in s))
    wanted = list(dict.fromkeys(frozenset(s) for s in sets))
    if not wanted:
        raise ValueError("no grouping set")
    top = frozenset(dims)
    done = {top: materialize(partials(df, dims, measures))}
    size = {top: done[top].count()}
    for s in sorted(wanted, key=len, reverse=True):
        if s in done:
            continue
        above = min((t for t in done if s < t), key=lambda t: (size[t], len(t)))
        mine = merged(done[above], [d for d in dims if d in s], measures)
        # only a set that another one can start from is computed ahead
        if any(t < s for t in wanted):
            mine = materialize(mine)
            size[s] = mine.count()
        else:
            size[s] = size[above]
        done[s] = mine
    out = []
    for s in wanted:
        number = sum(1 << (len(dims) - 1 - i) for i, d in enumerate(dims) if d not in s)
        keep = [(F.col(d) if d in s else F.lit(None).cast(df.schema[d].dataType)).alias(d) for d in dims]
        out.append(read_off(done[s], [*keep, F.lit(number).cast("long").alias("grouping_id")], measures))
    return reduce(DataFrame.unionAll, out)
