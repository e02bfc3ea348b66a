"""Phrase collocations by mergeable Misra-Gries summaries (operator 13).

Texts are lower-cased (A-Z), split into pieces at punctuation and line breaks
and these into words; an n-gram lies within one piece. All counts are per
language.

1. Survivors, one pass a size (1 word first): every task sums up its n-grams by
   the upper ``SENT_BITS`` bits of a hash and sends them by hash partition. A partition merges what it gets
   into a Misra-Gries summary with more counters than its mass divided by the
   threshold; the masses come first, so the capacity is known before the
   counters. What it subtracts from a counter (``error``) is below the
   threshold, so every n-gram that is frequent keeps a counter, and those with
   counter + error below the threshold are not frequent. Equal hashes only add
   up, so nothing is lost by them.
   The survivors of a size mark the bits of a map of fixed size, a stretch for
   each partition. An n-gram goes into the next size's summaries only if the
   map has its first and its last n - 1 words: a frequent n-gram's are frequent.
2. A second pass counts the n-grams whose bits are set, exactly: in a block of
   text by dense numbers of words and of pairs (shorter n-gram, next word), then
   by language and phrase in the hash partition they belong to. Bits that other
   n-grams set are harmless: too rare ones fall away by their count.
3. Candidates are joined with the counts of their two parts at every cut.
   Scores are exact decimals. A candidate that lies inside a longer one as
   frequent (``share`` percent) is dropped; if any longer one is, one with one
   word more is, so these alone are looked at.

A task holds one block of text and a bounded number of hashes at a time; a
summary's counters are bounded by ``COUNTERS`` and, with partitions chosen by
the number of words, do not grow with the data. A text longer than a block is
cut between two pieces.

Defined results: null text has no words; null language is ``und``, together
with documents that say so; repeated rows count each time; ids and other columns are not read; an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starloom.llm.common import only, stored

MIN_COUNT = 100
MAX_WORDS = 5
SHARE = 100
TOP = 2000
UNKNOWN = "und"
COUNTERS = 250_000  # counters a partition's summary should need
MAP_BITS = 26  # the map of survivors has 2 ** MAP_BITS bits
MIN_PARTITIONS = 64
BLOCK_BYTES = 8 << 20
HELD = 4_000_000  # hashes a task holds before it sums them up
SENT_BITS = 40  # of a hash, in summaries
_WORD, _GAP, _CUT = range(3)
# What separates words and pieces.
GAPS, CUTS = b" \t", b".,;:!?\n\x0b\x0c\r"


def _tables() -> tuple[np.ndarray, np.ndarray]:
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    kind = np.full(256, _WORD, np.int8)
    kind[list(GAPS)] = _GAP
    kind[list(CUTS)] = _CUT
    return lower, kind


LOWER, KIND = _tables()


class Words:
    """Words of one block: number in the block's dictionary, language number
    and piece of each word, in order."""

    def __init__(self, data: np.ndarray, ends: np.ndarray, langs: list[str]):
        d = LOWER[data]
        kind = KIND[d]
        inside = kind == _WORD
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        firsts = np.concatenate([[0], ends[:-1]])
        firsts = firsts[(firsts < len(d)) & (firsts < ends)]
        begins[firsts] = inside[firsts]
        at = np.flatnonzero(begins)
        doc = np.searchsorted(ends, at, side="right")
        self.piece = np.cumsum(kind == _CUT)[at] + doc
        chars = d[inside]
        offsets = np.append((np.cumsum(inside) - 1)[at], len(chars)).astype(np.int32)
        words = pa.Array.from_buffers(pa.string(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(chars)]).dictionary_encode()
        self.words = words.dictionary
        self.word = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        names = sorted(set(langs))
        number = {name: i for i, name in enumerate(names)}
        self.langs = pa.array(names, pa.string())
        self.lang = np.array([number[x] for x in langs], np.int64)[doc]

    def within(self, size: int) -> np.ndarray:
        """Where n-grams of this size begin."""
        last = self.piece[size - 1 :]
        return np.flatnonzero(self.piece[: len(last)] == last)

    def hashes(self, size: int) -> Iterator[np.ndarray]:
        """Hashes of the n-grams of 1, 2, ... ``size`` words from every word on."""
        words = np.array([xxhash.xxh64_intdigest(w) for w in self.words.cast(pa.binary()).to_pylist()], np.uint64)
        langs = np.array([xxhash.xxh64_intdigest(x, 1) for x in self.langs.to_pylist()], np.uint64)
        one = got = _mixed(words[self.word] ^ langs[self.lang])
        yield one
        for n in range(2, size + 1):
            got = _mixed(got[: max(0, len(one) - n + 1)] * np.uint64(0x9E3779B97F4A7C15) + one[n - 1 :])
            yield got


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def blocks(batches: Iterator[pa.RecordBatch], block_bytes: int = BLOCK_BYTES) -> Iterator[Words]:
    """Words of all texts (columns text, lang) in blocks of about
    ``block_bytes``; longer texts are cut where a piece ends."""
    parts: list[np.ndarray] = []
    langs: list[str] = []
    held = 0

    def done() -> Words:
        return Words(np.concatenate(parts), np.cumsum([len(p) for p in parts]), langs)

    for b in batches:
        texts = b.column("text").cast(pa.large_binary())
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
        ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        for i, (lang, ok) in enumerate(zip(b.column("lang").to_pylist(), texts.is_valid().to_pylist(), strict=True)):
            at, end = int(ends[i]), int(ends[i + 1])
            while ok and at < end:
                stop = end
                if end - at > block_bytes:
                    stop = at + block_bytes
                    while stop < end and KIND[data[stop]] != _CUT:
                        stop += 1
                parts.append(data[at:stop])
                langs.append(UNKNOWN if lang is None else lang)
                held += stop - at
                at = stop
                if held >= block_bytes:
                    yield done()
                    parts, langs, held = [], [], 0
        parts = [p.copy() for p in parts]  # the batch's memory goes
    if parts:
        yield done()


def _marked(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes >> np.uint64(64 - MAP_BITS)
    return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Different keys, sorted, and their summed counts."""
    k, c = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(k, kind="stable")
    k, c = k[order], c[order]
    first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.zeros(0, np.int64)
    return k[first], np.add.reduceat(c, first) if len(k) else c


def _packed(keys: np.ndarray) -> bytes:
    """Sorted keys as differences, byte by byte of equal rank: the upper ones
    are zero and compress away."""
    return np.diff(keys, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view("<u8").ravel(), dtype=np.uint64)


_SUMMARY = "part int, kind int, mass long, keys binary, counts binary"


def _local(docs: DataFrame, size: int, part_bits: int, known: Broadcast | None) -> DataFrame:
    """Sums of a task's n-grams by hash partition: a row with the mass
    (kind 0) and one with hashes and counts (kind 1)."""

    def rows(keys: list[np.ndarray], counts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        k, c = _summed(keys, counts)
        cuts = np.searchsorted(k >> np.uint64(64 - part_bits), np.arange((1 << part_bits) + 1, dtype=np.uint64))
        for part in np.flatnonzero(np.diff(cuts)).tolist():
            own = slice(int(cuts[part]), int(cuts[part + 1]))
            n = c[own]
            cols = [pa.array([part, part], pa.int32()), pa.array([0, 1], pa.int32()), pa.array([int(n.sum()), 0]), pa.array([None, _packed(k[own])], pa.binary()), pa.array([None, n.astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes()], pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, ["part", "kind", "mass", "keys", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = None if known is None else np.frombuffer(known.value, np.uint8)
        keys, counts, held = [], [], 0
        for words in blocks(batches):
            shorter, own = [None, *words.hashes(size)][-2:]
            at = words.within(size)
            if bits is not None:
                there = _marked(bits, shorter)
                at = at[there[at] & there[at + 1]]
            # the lower bits would be most of what is sent; equal hashes only add up
            k, c = np.unique(own[at] & np.uint64((1 << 64) - (1 << 64 - SENT_BITS)), return_counts=True)
            keys.append(k)
            counts.append(c)
            held += len(k)
            if held > HELD:
                k, c = _summed(keys, counts)
                keys, counts, held = [k], [c], len(k)
                if held > HELD // 2:
                    yield from rows(keys, counts)
                    keys, counts, held = [], [], 0
        if keys:
            yield from rows(keys, counts)

    return docs.mapInArrow(run, _SUMMARY)


class MisraGries:
    """A summary with at most ``capacity`` counters once it is reduced; no
    counter is too low by more than ``error``."""

    def __init__(self, capacity: int):
        self.capacity, self.error = capacity, 0
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.new: list[tuple[np.ndarray, np.ndarray]] = []
        self.waiting = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.new.append((keys, counts))
        self.waiting += len(keys)
        if self.waiting > self.capacity:
            self.reduce()

    def reduce(self) -> None:
        keys, counts = zip((self.keys, self.counts), *self.new, strict=True)
        self.keys, self.counts = _summed(list(keys), list(counts))
        self.new, self.waiting = [], 0
        over = len(self.keys) - self.capacity
        if over > 0:
            cut = int(np.partition(self.counts, over - 1)[over - 1])  # the largest that finds no room
            self.error += cut
            stays = self.counts > cut
            self.keys, self.counts = self.keys[stays], self.counts[stays] - cut


def _survivors(summaries: DataFrame, part_bits: int, min_count: int, counters: int) -> DataFrame:
    """(part, bits): each partition's stretch of the map of survivors."""
    stretch = 1 << (MAP_BITS - part_bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, mass, summary = None, 0, None

        def done() -> pa.RecordBatch:
            summary.reduce()
            stays = summary.keys[summary.counts + summary.error >= min_count]
            bits = np.zeros(stretch, np.uint8)
            bits[(stays >> np.uint64(64 - MAP_BITS)).astype(np.int64) - part * stretch] = 1
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())], ["part", "bits"])

        for b in batches:
            for at in range(b.num_rows):
                p, kind = b.column("part")[at].as_py(), b.column("kind")[at].as_py()
                if p != part:
                    if summary is not None:
                        yield done()
                    part, mass, summary = p, 0, None
                if kind == 0:
                    mass += b.column("mass")[at].as_py()
                    continue
                if summary is None:
                    summary = MisraGries(max(mass // min_count + 1, counters))
                n = np.ascontiguousarray(np.frombuffer(b.column("counts")[at].as_py(), np.uint8).reshape(8, -1).T).view("<i8").ravel()
                summary.add(_unpacked(b.column("keys")[at].as_py()), n)
        if summary is not None:
            yield done()

    sent = summaries.repartition("part").sortWithinPartitions("part", "kind")
    return sent.mapInArrow(run, "part int, bits binary")


def partition_bits(docs: DataFrame, min_count: int, counters: int) -> int:
    """Hash partitions, as a power of two, in which about ``counters`` counters
    exceed the mass divided by the threshold."""
    # no more words than every other byte of the texts
    words = (docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // 2
    wanted = max(MIN_PARTITIONS, words // (min_count * counters))
    return min(MAP_BITS - 3, (wanted - 1).bit_length())


def survivor_maps(spark: SparkSession, docs: DataFrame, part_bits: int, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, counters: int = COUNTERS) -> list[Broadcast]:
    """One map a size, each of 2 ** MAP_BITS bits, in which every n-gram with
    ``min_count`` occurrences is marked."""
    maps: list[Broadcast] = []
    for size in range(1, max_words + 1):
        summaries = _local(docs, size, part_bits, maps[-1] if maps else None)
        whole = bytearray(1 << (MAP_BITS - 3))
        step = len(whole) >> part_bits
        for r in _survivors(summaries, part_bits, min_count, counters).collect():  # at most the map in all
            whole[r["part"] * step : (r["part"] + 1) * step] = r["bits"]
        maps.append(spark.sparkContext.broadcast(bytes(whole)))
    return maps


_COUNTED = pa.schema([("lang", pa.string()), ("size", pa.int32()), ("phrase", pa.string()), ("f", pa.int64())])
_SENT = "part int, bytes long, data binary"


def _exact(docs: DataFrame, maps: list[Broadcast], part_bits: int) -> DataFrame:
    """Counts of the marked n-grams in each block of text, a row for every hash
    partition with a record batch of language, size, phrase and count, compressed;
    size 0 counts all words of a language."""

    def counted(words: Words) -> Iterator[tuple[np.ndarray, np.ndarray, int, pa.Array, np.ndarray]]:
        langs, n = np.unique(words.lang, return_counts=True)
        yield np.zeros(len(langs), np.int64), langs, 0, pa.array([""] * len(langs), pa.string()), n
        different = len(words.words)
        _, one = np.unique(words.lang * different + words.word, return_inverse=True)
        number, top = one, len(words.word) + 1  # exact number of the n-gram from each word on
        for size, hashes in enumerate(words.hashes(len(maps)), 1):
            at = words.within(size)
            at = at[_marked(np.frombuffer(maps[size - 1].value, np.uint8), hashes[at])]
            if size > 1:
                at = at[number[at] >= 0]
            if not len(at):
                return
            pairs = number[at] * top + one[at + size - 1] if size > 1 else one[at]
            _, first, rank, n = np.unique(pairs, return_index=True, return_inverse=True, return_counts=True)
            number = np.full(len(words.word), -1, np.int64)
            number[at] = rank
            at = at[first]
            taken = [words.words.take(pa.array(words.word[at + i])) for i in range(size)]
            yield (hashes[at] >> np.uint64(64 - part_bits)).astype(np.int64), words.lang[at], size, pc.binary_join_element_wise(*taken, " ") if size > 1 else taken[0], n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words in blocks(batches):
            if not len(words.word):
                continue
            part, langs, sizes, phrases, n = zip(*((p, lang, np.full(len(p), size, np.int32), ph, n) for p, lang, size, ph, n in counted(words)), strict=True)
            part = np.concatenate(part)
            order = np.argsort(part, kind="stable")
            part = part[order]
            first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
            values = [words.langs.take(pa.array(np.concatenate(langs)[order])), pa.array(np.concatenate(sizes)[order]), pa.concat_arrays(phrases).take(pa.array(order)), pa.array(np.concatenate(n)[order].astype(np.int64))]
            rows = pa.RecordBatch.from_arrays(values, schema=_COUNTED)
            sent = [rows.slice(i, n).serialize() for i, n in zip(first.tolist(), np.diff(first, append=len(part)).tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(part[first].astype(np.int32)), pa.array([s.size for s in sent], pa.int64()), pa.array([pa.compress(s, codec="zstd", asbytes=True) for s in sent], pa.binary())], ["part", "bytes", "data"])

    return docs.mapInArrow(run, _SENT)


def _totals(counted: DataFrame, min_count: int) -> DataFrame:
    """(lang, size, phrase, f): the sums of each partition's batches, for phrases
    that come up ``min_count`` times."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, rows = None, [], 0

        def summed() -> pa.Table:
            return pa.concat_tables(held).group_by(["lang", "size", "phrase"]).aggregate([("f", "sum")]).rename_columns(["lang", "size", "phrase", "f"])

        def done() -> Iterator[pa.RecordBatch]:
            t = summed()
            t = t.filter(pc.or_(pc.equal(t["size"], 0), pc.greater_equal(t["f"], min_count)))
            yield from t.select(_COUNTED.names).to_batches(max_chunksize=65_536)

        for b in batches:
            for at in range(b.num_rows):
                p = b.column("part")[at].as_py()
                if p != part and held:
                    yield from done()
                    held, rows = [], 0
                part = p
                data = pa.decompress(b.column("data")[at].as_buffer(), decompressed_size=b.column("bytes")[at].as_py(), codec="zstd")
                held.append(pa.Table.from_batches([pa.ipc.read_record_batch(data, _COUNTED)]))
                rows += len(held[-1])
                if rows > HELD:
                    held = [summed()]
                    rows = len(held[0])
        if held:
            yield from done()

    return counted.repartition("part").sortWithinPartitions("part").mapInArrow(run, "lang string, size int, phrase string, f long")


def frequent(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, counters: int = COUNTERS) -> DataFrame:
    """(lang, size, phrase, f): exact counts of all n-grams of up to
    ``max_words`` words that occur ``min_count`` times in a language; size 0
    (the empty phrase) counts all its words. Stored in the shared folder."""
    if min_count < 1 or max_words < 2:
        raise ValueError("at least one occurrence and two words")
    own = only(docs, "text", "lang").select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    own = own.where("text is not null")
    part_bits = partition_bits(own, min_count, counters)
    maps = survivor_maps(docs.sparkSession, own, part_bits, min_count, max_words, counters)
    out = stored(_totals(_exact(own, maps, part_bits), min_count), "phrases")
    for m in maps:
        m.unpersist()
    return out


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, share: int = SHARE, top: int = TOP, counters: int = COUNTERS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` highest-scoring
    phrases of each language. a, l and r are the counts of the phrase, of its
    first words and of the rest at the cut that scores lowest."""
    counts = frequent(docs, min_count, max_words, counters)
    total = counts.where("size = 0").select("lang", F.col("f").alias("n"))
    known = counts.where("size > 0").select("lang", "phrase", "f")
    candidates = counts.where("size > 1").select("lang", "phrase", "size", F.col("f").alias("a"))
    # cuts after k words
    words = F.split("phrase", " ")
    part = lambda i, n: F.array_join(F.slice(words, i, n), " ")
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.withColumns({"first": part(F.lit(1), F.col("k")), "rest": part(F.col("k") + 1, F.col("size") - F.col("k"))})
    cuts = cuts.join(known.toDF("lang", "first", "l"), ["lang", "first"]).join(known.toDF("lang", "rest", "r"), ["lang", "rest"]).join(total, "lang")
    wide = lambda c: F.col(c).cast("decimal(16,0)")
    above, below = F.lit(1000).cast("decimal(4,0)") * wide("a") * wide("n"), wide("l") * wide("r")
    cuts = cuts.withColumns({"above": above, "below": below}).withColumn("score", F.expr("above div below"))
    lowest = F.min(F.struct("score", "k", "l", "r")).alias("lowest")
    scored = cuts.groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.first("n").alias("n"), lowest)
    # inside a candidate with one word more
    inner = candidates.where("size > 2").withColumn("phrase", F.explode(F.array(part(F.lit(1), F.col("size") - 1), part(F.lit(2), F.col("size") - 1))))
    longer = inner.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = scored.join(longer, ["lang", "phrase"], "left").where(F.expr(f"longer is null or 100 * longer < {int(share)} * a"))
    order = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    out = kept.select("lang", "phrase", "a", F.col("lowest.l").alias("l"), F.col("lowest.r").alias("r"), "n", F.col("lowest.score").alias("score"))
    return out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
