"""SimHash near-duplicates by anchor-point covering (operator 5).

Fingerprints: words are runs of characters other than ASCII white space after
lower-casing A-Z; each run of ``shingle`` words, joined by a space, is hashed
with XXH64 (seed 42); a bit of the fingerprint is set if it is set in over half
of the hashes. Fewer words: the whole sequence is one shingle; none: zero.

Linking: two fingerprints are linked at up to ``DISTANCE`` differing bits.
Anchors are the points of a covering code. The code here is the product of two
binary Golay codes of length 23 over bits 0 to 45; it is perfect, so each half
lies within 3 bits of exactly one codeword, and that pair of codewords is the
fingerprint's home, at most 3 + 3 bits away. A fingerprint within d bits of
another lies within 3 + e and 3 + f bits of the other's home in the two halves,
with e + f <= d. So every distinct fingerprint is sent once to its home and to
every anchor within covering radius plus threshold (about 61 of 2**24 anchors),
and a home is compared with the visitors at its anchor. Each link comes up
exactly once, from the smaller fingerprint's home; no link is lost.

Only distinct fingerprints are compared, so copies cost nothing however many
there are. Components are found on distinct fingerprints and joined back.

Joins whose sides Spark would size too low are merged, by a hint: visits pass for
a table as small as the fingerprints that they come from, and a stored table
for its compressed files. Broadcast, either would be held by the driver.

Defined results: null and empty texts have no words (fingerprint zero) and are
one group like any other; repeated rows and ids are kept, each with its
component; null ids are ignored for the smallest id of a component, which is
null if it has null ids only.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.bpe import slices
from starloom.llm.common import cut, only, stored
from starloom.llm.components import components

SHINGLE = 3
DISTANCE = 2
SEED = 42
GOLAY_BITS, GOLAY_RADIUS = 23, 3
GOLAY_POLY = 0xC75  # fixed value: generator polynomial of the binary Golay code
_BLOCK = 1 << 18  # shingles whose hashes are in memory at a time
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64-bit fingerprint of one whole text, unsigned."""
    words = (text or "").encode(errors="surrogatepass").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    whole = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[:n].tolist()
    stops = ends[min(shingle, len(words)) - 1 :].tolist()
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, _BLOCK):
        hashes = np.array([digest(whole[i:j], SEED) for i, j in zip(starts[at : at + _BLOCK], stops[at : at + _BLOCK], strict=True)], dtype="<u8")
        places = hashes.view(np.uint8).reshape(-1, 8) + np.arange(0, 2048, 256)
        ones += (np.bincount(places.ravel(), minlength=2048).reshape(8, 256) @ _BITS).ravel()
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, keep: Sequence[str] = ("doc_id",), shingle: int = SHINGLE) -> DataFrame:
    """The columns ``keep`` of docs and ``fp``, the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for rows in slices(b):
                fps = np.array([fingerprint(t, shingle) for t in rows.column("_text").to_pylist()], dtype=np.uint64)
                yield pa.RecordBatch.from_arrays([*(rows.column(k) for k in keep), pa.array(fps.view(np.int64))], [*keep, "fp"])

    if "fp" in keep:
        raise ValueError("a column to keep is named fp, which this operator sets itself")
    schema = ", ".join([*(f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keep), "fp long"])
    return docs.select(*[F.col(f"`{k}`") for k in keep], F.col("text").alias("_text")).mapInArrow(run, schema)


def _remainder(words: np.ndarray) -> np.ndarray:
    """Syndrome of 23-bit words: remainder by the generator polynomial."""
    rest = words.astype(np.int64).copy()
    for bit in range(GOLAY_BITS - 1, 10, -1):
        rest = np.where(rest >> bit & 1, rest ^ (GOLAY_POLY << (bit - 11)), rest)
    return rest


@lru_cache(maxsize=4)
def _cosets(distance: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Error patterns of weight up to radius + distance by syndrome: patterns,
    weights, first of each syndrome, number of each syndrome."""
    patterns, weights = [np.zeros(1, np.int64)], [np.zeros(1, np.int64)]
    layer = [(0, -1)]
    for weight in range(1, GOLAY_RADIUS + distance + 1):
        layer = [(p | 1 << b, b) for p, top in layer for b in range(top + 1, GOLAY_BITS)]
        patterns.append(np.array([p for p, _ in layer], np.int64))
        weights.append(np.full(len(layer), weight, np.int64))
    pattern, weight = np.concatenate(patterns), np.concatenate(weights)
    syndrome = _remainder(pattern)
    order = np.lexsort((weight, syndrome))  # the nearest codeword comes first
    count = np.bincount(syndrome, minlength=2048)
    return pattern[order], weight[order], np.cumsum(count) - count, count


def anchors(fps: np.ndarray, distance: int = DISTANCE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(home anchor of each fingerprint; index and anchor of all its visits).
    An anchor is named by its two codewords, 46 bits."""
    pattern, excess, first, count = _cosets(distance)
    excess = np.maximum(0, excess - GOLAY_RADIUS)
    mask = (1 << GOLAY_BITS) - 1
    bits = fps.astype(np.uint64).view(np.int64) if fps.dtype != np.int64 else fps
    low, high = bits & mask, (bits >> GOLAY_BITS) & mask
    s_low, s_high = _remainder(low), _remainder(high)
    home = (low ^ pattern[first[s_low]]) | (high ^ pattern[first[s_high]]) << GOLAY_BITS
    n_low, n_high = count[s_low], count[s_high]
    n = n_low * n_high
    row = np.repeat(np.arange(len(bits)), n)
    nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    i = first[s_low][row] + nth // n_high[row]
    j = first[s_high][row] + nth % n_high[row]
    near = excess[i] + excess[j] <= distance
    row, i, j = row[near], i[near], j[near]
    return home, row, (low[row] ^ pattern[i]) | (high[row] ^ pattern[j]) << GOLAY_BITS


def _homes_and_visits(distinct: DataFrame, distance: int, visits: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for rows in slices(b, 2048):
                fps = rows.column("fp").to_numpy()
                home, row, at = anchors(fps, distance)
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(fps[row])] if visits else [pa.array(home), pa.array(fps)], ["anchor", "fp"])

    return distinct.select("fp").mapInArrow(run, "anchor long, fp long")


def links(distinct: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(a, b), a < b: all pairs of distinct fingerprints (column fp) at up to
    ``distance`` differing bits, each once."""
    home = _homes_and_visits(distinct, distance, False).select("anchor", F.col("fp").alias("a"))
    visit = _homes_and_visits(distinct, distance, True).select("anchor", F.col("fp").alias("b"))
    close = (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance)
    return home.join(visit.hint("merge"), (home["anchor"] == visit["anchor"]) & close).select("a", "b")


def groups(fps: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(fp, root) for every distinct fingerprint: root is the smallest
    fingerprint reachable over links."""
    distinct = cut(fps.select("fp").distinct())
    roots = components(links(distinct, distance)).select(F.col("node").alias("fp"), "root")
    return distinct.join(roots.hint("merge"), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """(doc_id, fp, component_id) for every row: component_id is the smallest
    doc_id reachable over links, the document's own included."""
    fps = stored(fingerprints(only(docs, "doc_id", "text"), shingle=shingle), "fingerprints")
    least = fps.groupBy("fp").agg(F.min("doc_id").alias("least"))
    rooted = cut(groups(fps, distance).join(least.hint("merge"), "fp"))
    component = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    by_fp = cut(rooted.join(component, "root").select("fp", "component_id"))
    return fps.join(by_fp.hint("merge"), "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """docs with one row of each near-duplicate group: the one with the
    smallest doc_id (null ids last; of rows with the same id, the first read)."""
    names = docs.columns
    own = docs.toDF(*[f"c{i}" for i in range(len(names))])
    own = own.withColumns({"text": F.col(f"c{names.index('text')}"), "_row": F.monotonically_increasing_id()})
    rows = stored(fingerprints(own, keep=[c for c in own.columns if c != "text"], shingle=shingle), "rows")
    doc_id = F.col(f"c{names.index('doc_id')}")
    first = F.min(F.struct(doc_id.isNull().alias("no_id"), doc_id.alias("id"), F.col("_row")))
    best = cut(rows.groupBy("fp").agg(first.alias("best")).join(groups(rows, distance).hint("merge"), "fp"))
    chosen = cut(best.groupBy("root").agg(F.min("best").alias("best")).select(F.col("best._row").alias("_row")))
    return rows.join(chosen, "_row", "left_semi").select(*[F.col(f"c{i}").alias(n) for i, n in enumerate(names)])
