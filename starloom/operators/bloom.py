"""Bloom-filter semi-join reduction.

A shuffle join moves every row of its big side, also those that find no
partner. Here the keys of the other side are first summed up in a Bloom filter
of bounded size, which the big side probes map-side: a row whose key cannot be
there is dropped (or set apart) before the exchange.

The filter is a DataFrame, built by partial aggregates: a key sets ``PROBES``
bits of one 64-bit word; words are or-ed together, before and after the
exchange, and gathered into lines of ``LINE_WORDS`` words. Its size follows the
number of keys (``BITS_PER_KEY``) up to ``MAX_BITS``, 32 MiB, whatever the side
holds; beyond that more rows pass, none is lost. Probing is a broadcast join on
the line and one mask comparison, all in built-in functions.

A NULL in any key column never matches, as in an equi-join.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.operators.keys import materialize

BITS_PER_KEY = 16
PROBES = 4
LINE_WORDS = 128
MIN_BITS, MAX_BITS = 1 << 16, 1 << 28
_WORD_BITS = 64


@dataclass(frozen=True)
class BloomFilter:
    """``lines``: (line, words), one row per ``LINE_WORDS`` words at most;
    ``types``: of the key columns."""

    lines: DataFrame
    n_words: int
    types: tuple[str, ...]


def _keys(df: DataFrame, keys: Sequence[str]) -> tuple[list[Column], tuple[str, ...]]:
    """Key columns in a form that hashes alike wherever an equi-join finds
    them equal, and their types."""
    cols, types = [], []
    for k in keys:
        kind, c = df.schema[k].dataType, F.col(f"`{k}`")
        if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
            kind, c = T.LongType(), c.cast("long")
        elif isinstance(kind, (T.FloatType, T.DoubleType)):
            kind, c = T.DoubleType(), c.cast("double") + F.lit(0.0)  # no negative zero
        cols.append(c)
        types.append(kind.simpleString())
    return cols, tuple(types)


def _hash(keys: Sequence[Column]) -> Column:
    """Hash of the key, NULL if any part is."""
    known = keys[0].isNotNull()
    for k in keys[1:]:
        known = known & k.isNotNull()
    return F.when(known, F.xxhash64(*keys))


def _mask(h: Column) -> Column:
    """The bits a key sets in its word, from a second hash of the first."""
    again = F.xxhash64(h, F.lit(1))
    bits = [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(again, 6 * i).bitwiseAND(_WORD_BITS - 1).cast("int")) for i in range(PROBES)]
    out = bits[0]
    for b in bits[1:]:
        out = out.bitwiseOR(b)
    return out


def bits_for(n_keys: int) -> int:
    """Size in bits, a power of two."""
    wanted = max(1, n_keys) * BITS_PER_KEY
    return min(MAX_BITS, max(MIN_BITS, 1 << (wanted - 1).bit_length()))


def build(side: DataFrame, keys: Sequence[str], n_keys: int | None = None) -> BloomFilter:
    """Filter of the keys of ``side``. ``n_keys`` (rows, if known) sets the
    size; otherwise they are counted first."""
    n_words = bits_for(side.count() if n_keys is None else n_keys) // _WORD_BITS
    cols, types = _keys(side, keys)
    hashed = side.select(_hash(cols).alias("h")).where("h is not null")
    words = hashed.select(F.pmod("h", F.lit(n_words)).alias("word"), _mask(F.col("h")).alias("mask")).groupBy("word").agg(F.bit_or("mask").alias("mask"))
    placed = words.select((F.col("word") / LINE_WORDS).cast("int").alias("line"), F.pmod("word", F.lit(LINE_WORDS)).cast("int").alias("place"), "mask")
    at = F.map_from_entries(F.collect_list(F.struct("place", "mask")))
    lines = placed.groupBy("line").agg(at.alias("at"))
    filled = F.transform(F.sequence(F.lit(0), F.lit(LINE_WORDS - 1)), lambda i: F.coalesce(F.try_element_at("at", i), F.lit(0).cast("long")))
    return BloomFilter(materialize(lines.select("line", filled.alias("words"))), n_words, types)


def with_match(df: DataFrame, bloom: BloomFilter, keys: Sequence[str], name: str = "_may_match") -> DataFrame:
    """``df`` with a boolean column: false where the key is surely absent."""
    cols, types = _keys(df, keys)
    if types != bloom.types:
        raise ValueError(f"keys of type {types} cannot be looked up in a filter of {bloom.types}")
    own = df.withColumn("_h", _hash(cols))
    word = F.pmod("_h", F.lit(bloom.n_words))
    own = own.withColumns({"_line": (word / LINE_WORDS).cast("int"), "_place": F.pmod(word, F.lit(LINE_WORDS)).cast("int")})
    lines = F.broadcast(bloom.lines.select(F.col("line").alias("_line"), F.col("words").alias("_words")))
    mask = _mask(F.col("_h"))
    hit = F.coalesce(F.get("_words", F.col("_place")).bitwiseAND(mask) == mask, F.lit(False))
    return own.join(lines, "_line", "left").withColumn(name, hit).drop("_h", "_line", "_place", "_words")


def reduce_by(df: DataFrame, bloom: BloomFilter, keys: Sequence[str]) -> DataFrame:
    """The rows of ``df`` whose key may be in the filter."""
    return with_match(df, bloom, keys, "_may_match").where("_may_match").drop("_may_match")
