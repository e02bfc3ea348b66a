"""Dimension operators: ensure, type-1 upsert, insert, default members, lookup.

A dimension is a DataFrame of members plus a :class:`DimensionSpec`. All
operators return new DataFrames (Parquet tables have no MERGE; publishing
writes a new run directory, see ``plans.publish``).

Determinism: whenever the job must pick "the first" or "the last" row of a
natural key, the caller names a sequence column (``seq``) that orders the
batch; no operator relies on row order.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.operators.joins import fits_budget, salted_join, sized
from starloom.operators.keys import assign_keys, next_key

POLICIES = ("error", "default", "null")


@dataclass(frozen=True)
class DimensionSpec:
    name: str
    key: str
    attributes: Sequence[str]
    lookup: Sequence[str]
    type1: Sequence[str] = field(default_factory=tuple)
    default_id: int | None = None

    @property
    def columns(self) -> list[str]:
        return [self.key, *self.attributes]

    @property
    def plain(self) -> list[str]:
        """Attributes that keep their first value."""
        return [a for a in self.attributes if a not in self.type1]


def conform(dim: DataFrame, spec: DimensionSpec, schema: T.StructType | None = None) -> DataFrame:
    """Project (and cast) a dimension to its declared columns."""
    if schema is None:
        return dim.select(*spec.columns)
    return dim.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def empty_dimension(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


def seed_members(spark: SparkSession, rows: Sequence[dict], schema: T.StructType) -> DataFrame:
    """Default members (key given explicitly), missing attributes NULL.
    Built from literals on the JVM side (no Python round trip)."""
    if not rows:
        return empty_dimension(spark, schema)
    parts = [spark.range(1).select(*[F.lit(r.get(f.name)).cast(f.dataType).alias(f.name)
                                     for f in schema.fields]) for r in rows]
    return reduce(DataFrame.unionAll, parts)


def first_per_key(rows: DataFrame, keys: Sequence[str], attrs: Sequence[str], seq: str,
                  last: Sequence[str] = ()) -> DataFrame:
    """One row per natural key: ``attrs`` from the row with the smallest
    ``seq``, ``last`` from the row with the largest. One aggregate (sort-based,
    as its buffers hold strings), partial on the map side, so a hot key never
    gathers in one task."""
    aggs = []
    if attrs:
        aggs.append(F.min_by(F.struct(*attrs), F.col(seq)).alias("_first"))
    if last:
        aggs.append(F.max_by(F.struct(*last), F.col(seq)).alias("_last"))
    out = rows.groupBy(*keys).agg(*aggs)
    cols = [F.col(k) for k in keys]
    cols += [F.col(f"_first.{a}").alias(a) for a in attrs if a not in keys]
    cols += [F.col(f"_last.{a}").alias(a) for a in last if a not in keys]
    return out.select(*cols)


def _start(dim: DataFrame, spec: DimensionSpec, start: int | None) -> int:
    """First free key: given by a caller that built ``dim`` itself (seeds),
    else 1 + the dimension's largest key (one small job)."""
    return next_key(dim, spec.key) if start is None else start


def _append_new(dim: DataFrame, new: DataFrame, spec: DimensionSpec, start: int | None = None,
                at_most: int | None = None) -> DataFrame:
    keyed = assign_keys(new.select(*spec.attributes), list(spec.lookup), key=spec.key,
                        start=_start(dim, spec, start), at_most=at_most)
    return dim.select(*spec.columns).unionByName(keyed.select(*spec.columns))


def dim_ensure(dim: DataFrame, rows: DataFrame, spec: DimensionSpec, seq: str | None = None,
               start: int | None = None, at_most: int | None = None) -> DataFrame:
    """Insert the rows whose natural key is not yet a member.

    Within the batch the first row of a natural key (smallest ``seq``)
    supplies the attributes; only a dimension without attributes besides its
    natural key needs no ``seq``. Existing members are left untouched. New
    members get keys after the current largest key, in natural-key order.
    ``at_most``: rows of the batch, if a bound is known (see
    :func:`~starloom.operators.keys.assign_keys`)."""
    lookup = list(spec.lookup)
    others = [a for a in spec.attributes if a not in lookup]
    if others and seq is None:
        raise ValueError(f"dimension {spec.name}: seq must say which row of a natural key supplies {others}")
    batch = first_per_key(rows, lookup, others, seq) if others else rows.select(*spec.attributes).distinct()
    new = batch.join(dim.select(*lookup), lookup, "left_anti")
    return _append_new(dim, new, spec, start, at_most)


def scd1_upsert(dim: DataFrame, rows: DataFrame, spec: DimensionSpec, seq: str,
                start: int | None = None, at_most: int | None = None) -> DataFrame:
    """Type-1 slowly changing dimension.

    Per natural key of the batch: plain attributes come from the first row
    (smallest ``seq``), type-1 attributes from the last (largest ``seq``).
    Existing members get their type-1 attributes overwritten; other
    attributes and the key stay. New natural keys are inserted."""
    lookup = list(spec.lookup)
    plain = [a for a in spec.plain if a not in lookup]
    batch = first_per_key(rows, lookup, plain, seq, last=list(spec.type1))
    changes = batch.select(*lookup, *[F.col(a).alias(f"_new_{a}") for a in spec.type1],
                           F.lit(True).alias("_hit"))
    current = dim.select(*spec.columns)
    updated = current.join(changes, lookup, "left").select(
        spec.key,
        *[F.when(F.col("_hit"), F.col(f"_new_{a}")).otherwise(F.col(a)).alias(a)
          if a in spec.type1 else F.col(a) for a in spec.attributes])
    new = batch.join(current.select(*lookup), lookup, "left_anti")
    keyed = assign_keys(new.select(*spec.attributes), lookup, key=spec.key,
                        start=_start(dim, spec, start), at_most=at_most)
    return updated.unionByName(keyed.select(*spec.columns))


def dim_insert(dim: DataFrame, rows: DataFrame, spec: DimensionSpec, order: Sequence[str],
               start: int | None = None, at_most: int | None = None) -> DataFrame:
    """Unconditional append: every row becomes a member, duplicates
    included, keyed after the current largest key in ``order``."""
    keyed = assign_keys(rows, list(order), key=spec.key, start=_start(dim, spec, start), at_most=at_most)
    return dim.select(*spec.columns).unionByName(keyed.select(*spec.columns))


def key_map(dim: DataFrame, spec: DimensionSpec) -> DataFrame:
    """natural key -> smallest surrogate key (a dimension with duplicate
    natural keys, such as one filled by plain inserts, stays unambiguous)."""
    return dim.groupBy(*spec.lookup).agg(F.min(spec.key).alias(spec.key))


def lookup(facts: DataFrame, dim: DataFrame, spec: DimensionSpec, on_missing: str = "error",
           default_id: int | None = None, on: Sequence[str] | None = None,
           dedupe: bool = True, salt: int = 0, null_safe: bool = False,
           size: tuple[int, int] | None = None) -> DataFrame:
    """Add ``spec.key`` to ``facts`` by natural key (columns ``on`` of the
    facts, named like ``spec.lookup``).

    ``on_missing``: ``error`` fails on a natural key that is not a member
    (NULL keys included), ``default`` uses ``default_id`` (or the spec's),
    ``null`` leaves NULL. The dimension side is broadcast only when its size
    is checked to be small; otherwise AQE plans a shuffle join and splits
    skewed partitions, or, with ``salt`` > 0, the fact side is spread over
    ``salt`` deterministic sub-keys per natural key (for hot keys when AQE
    skew handling is off). ``null_safe=True`` matches NULL natural-key parts
    to NULL member attributes (``<=>``) instead of treating them as missing.
    ``size``: (rows, bytes) that the dimension's keys are known not to exceed,
    instead of measuring them."""
    if on_missing not in POLICIES:
        raise ValueError(f"on_missing must be one of {POLICIES}")
    default = spec.default_id if default_id is None else default_id
    if on_missing == "default" and default is None:
        raise ValueError(f"dimension {spec.name} has no default member")
    natural = list(spec.lookup)
    on = list(on or natural)
    kmap = key_map(dim, spec) if dedupe else dim.select(*natural, spec.key)
    kmap = kmap.toDF(*on, spec.key) if on != natural else kmap
    # the dimension is at least as large as its key map, and needs no grouping to be measured
    small = sized(dim.select(*natural, spec.key))[1] if size is None else fits_budget(facts.sparkSession, size)
    side = F.broadcast(kmap) if small else kmap
    if null_safe:
        renamed = kmap.select(*[F.col(c).alias(f"_k_{c}") for c in on], spec.key)
        renamed = F.broadcast(renamed) if small else renamed
        cond = [facts[c].eqNullSafe(renamed[f"_k_{c}"]) for c in on]
        joined = facts.join(renamed, cond, "left").drop(*[f"_k_{c}" for c in on])
    elif salt > 0 and not small:
        joined = salted_join(facts, kmap, on, "left", salt)
    else:
        joined = facts.join(side, on, "left")
    key = F.col(spec.key)
    if on_missing == "default":
        key = F.coalesce(key, F.lit(default).cast("long"))
    elif on_missing == "error":
        msg = F.concat(F.lit(f"no {spec.name} member for "),
                       F.to_json(F.struct(*[F.col(c) for c in on])))
        key = F.coalesce(key, F.raise_error(msg).cast("long"))
    return joined.withColumn(spec.key, key)
