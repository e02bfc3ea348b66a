"""Integrity checks the warehouse DDL would enforce, as dataset-level jobs.

Each check returns the violating rows (empty = passes), so a caller can
both assert and report. All are single shuffles or anti-joins.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.operators.joins import small_side


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Primary-key uniqueness: key values held by more than one row."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") > 1))


def missing_references(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Foreign keys: child rows whose non-NULL ``fk`` has no parent row.
    The parent side is broadcast only when its size is checked small."""
    parent_keys = small_side(parent.select(F.col(pk).alias(fk)).distinct())
    return child.filter(F.col(fk).isNotNull()).join(parent_keys, fk, "left_anti")


def null_values(df: DataFrame, columns: Sequence[str], ids: Sequence[str]) -> DataFrame:
    """Key columns that must not be NULL: one row per (id, column) hit.
    One scan for all columns."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).isNull().alias("hit")) for c in columns])
    return (df.select(*ids, F.explode(cells).alias("_c")).filter("_c.hit")
            .select(*ids, F.col("_c.column").alias("column")))


def too_long(df: DataFrame, limits: dict[str, int], ids: Sequence[str]) -> DataFrame:
    """varchar(n) limits: values longer than n characters. One scan."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.length(c).alias("length"),
                               F.lit(n).alias("limit")) for c, n in limits.items()])
    return (df.select(*ids, F.explode(cells).alias("_c")).filter("_c.length > _c.limit")
            .select(*ids, F.col("_c.column").alias("column"), F.col("_c.length").alias("length")))


def out_of_decimal_range(df: DataFrame, column: str, precision: int, scale: int,
                         ids: Sequence[str]) -> DataFrame:
    """numeric(p, s) range: non-NULL values that do not fit."""
    fits = F.col(column).try_cast(f"decimal({precision},{scale})")
    return df.filter(F.col(column).isNotNull() & fits.isNull()).select(*ids, column)


def warehouse_report(tables: dict[str, DataFrame], primary_keys: dict[str, list[str]],
                     foreign_keys: dict[str, list[tuple[str, str, str]]],
                     max_length: dict[str, dict[str, int]] | None = None,
                     natural_keys: dict[str, list[str]] | None = None,
                     decimals: dict[str, tuple[str, int, int]] | None = None) -> DataFrame:
    """One row per (table, check, detail) with the number of violations.

    Per table: each key check (primary, natural) is one aggregate by key;
    NULL keys, lengths, decimal ranges and all foreign keys are counted in one
    more pass over the table (each parent's keys joined in, broadcast when
    checked small)."""
    rows = []
    for check, keys in (("primary_key", primary_keys), ("natural_key", natural_keys or {})):
        for t, key in keys.items():
            rows.append(duplicate_keys(tables[t], key).agg(F.count(F.lit(1)).alias("violations"))
                        .select(F.lit(t).alias("table"), F.lit(check).alias("check"),
                                F.lit(",".join(key)).alias("detail"), "violations"))
    for t in sorted(set(primary_keys) | set(foreign_keys) | set(max_length or {}) | set(decimals or {})):
        df = tables[t]
        counters = [(("not_null", c), F.col(c).isNull()) for c in primary_keys.get(t, [])]
        counters += [(("max_length", c), F.coalesce(F.length(c) > n, F.lit(False)))
                     for c, n in (max_length or {}).get(t, {}).items()]
        if decimals and t in decimals:
            c, precision, scale = decimals[t]
            counters.append((("decimal_range", c),
                             F.col(c).isNotNull() & F.col(c).try_cast(f"decimal({precision},{scale})").isNull()))
        for i, (fk, parent, pk) in enumerate(foreign_keys.get(t, [])):
            keys = small_side(tables[parent].select(F.col(pk).alias(fk)).distinct()
                              .withColumn(f"_found{i}", F.lit(True)))
            df = df.join(keys, fk, "left")
            counters.append((("foreign_key", f"{fk}->{parent}.{pk}"),
                             F.col(fk).isNotNull() & F.col(f"_found{i}").isNull()))
        if not counters:
            continue
        counts = df.agg(*[F.count(F.when(cond, 1)).alias(f"c{i}") for i, (_, cond) in enumerate(counters)])
        stacked = F.array(*[F.struct(F.lit(check).alias("check"), F.lit(detail).alias("detail"),
                                     F.col(f"c{i}").alias("violations"))
                            for i, ((check, detail), _) in enumerate(counters)])
        rows.append(counts.select(F.explode(stacked).alias("_r")).select(
            F.lit(t).alias("table"), "_r.check", "_r.detail", "_r.violations"))
    return reduce(DataFrame.unionAll, rows)
