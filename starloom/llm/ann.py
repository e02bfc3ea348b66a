"""Approximate nearest neighbours by multiprobe p-stable hashing (operator 2).

Nearness is the largest inner product. Vectors of one length are split into
bands of norm, an octave each. In a band they are scaled by its largest norm
and given one more component that brings them to unit length; queries are
scaled to unit length and get a zero. The nearest vectors by Euclidean distance
are then those of the band with the largest inner product, and p-stable hashing
applies: a hash is floor((a . x + b) / w) with Gaussian a and uniform b, and a
bucket of a table is the tuple of ``HASHES`` such values. One scale for all
norms would squeeze the short vectors into a few buckets.

A query visits its own bucket in each table and a number of perturbed ones. A
perturbation moves some hashes by one, to the side at which the query lies near
the edge of its slot; perturbation sets are visited in the order of their
estimated success (the expected squared distances to the edges, so the order is
one list for all queries, applied to each query's own sorted distances). It does
so in every band.

Hashes, tables, probes and width are chosen for the data, from ``SETTINGS``. A
sample of ``SAMPLE_QUERIES`` queries is compared with all vectors; a setting's
recall is the part of their nearest that lie in buckets they visit, and its cost
follows from its copies and from the part of ``SAMPLE_VECTORS`` vectors in the
buckets visited. The cheapest setting with a recall of ``RECALL`` is taken; if
none has it, a band is one bucket and the search is exact.

Queries that found fewer than k + 1 different vectors while there are more of
their length are compared with all of them.

Vectors and visits meet by bucket in blocks: a bucket with more than ``BLOCK``
vectors or visits is dealt into a grid of blocks by hashes, so none grows with
the data. In a block scores are one matrix product; all that reach the ``k`` + 1st
best of a query, less the rounding error, are scored again as plain
double-precision sums, and the best ``k`` + 1 go on. Candidates
of all tables are merged per query.

Equal vectors are one candidate with its k + 1 smallest ids, and queries with
equal vectors are one query, so a vector that a third of the rows share costs
no more than any other.

Defined results: null, empty and zero vectors, those with a null or non-finite
component and rows without id take no part; vectors are compared with those of
the same length only; rows with the same id and vector count once, and a query
never returns its own id; ties go to the smaller id.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starloom.llm.common import cut, only
from starloom.operators.joins import small_side

K = 20
HASHES, TABLES, PROBES, WIDTH = 3, 8, 16, 1.0
# (hashes, tables, probes, width) that a search chooses from
SETTINGS = (
    (16, 4, 32, 1.0), (12, 2, 8, 1.0), (12, 8, 32, 1.0), (10, 2, 16, 1.0), (8, 2, 16, 1.0), (8, 4, 32, 1.0), (8, 8, 48, 1.0),
    (6, 4, 32, 1.0), (6, 8, 48, 1.0), (8, 4, 48, 2.0), (6, 4, 48, 2.0), (4, 2, 48, 2.0), (3, 2, 16, 2.0), (2, 2, 9, 2.0), (3, 8, 16, 1.0),
)
RECALL = 0.97
SAMPLE_QUERIES, SAMPLE_VECTORS = 100, 2000
PAIRS_PER_COPY = 400  # products of two vectors that cost as much as a vector sent to a bucket
BLOCK = 8_192
SEED = 11
_CELLS = 4_000_000  # numbers of candidate vectors scored again at a time
_HELD = 1_000_000  # candidates held by a task before it keeps the best of each query


@dataclass(frozen=True)
class Index:
    """Parameters of the hash tables."""

    hashes: int = HASHES
    tables: int = TABLES
    probes: int = PROBES
    width: float = WIDTH
    seed: int = SEED


@lru_cache(maxsize=16)
def probing_order(hashes: int, probes: int) -> list[tuple[int, ...]]:
    """Perturbation sets by estimated success. A set names positions (from 1)
    in a query's list of its 2 * hashes edge distances, sorted; positions j and
    2 * hashes + 1 - j are the two sides of one hash and exclude each other."""
    m = hashes
    expected = [0.0, *(j * (j + 1) / (4 * (m + 1) * (m + 2)) for j in range(1, m + 1)), *(1 - (2 * m + 1 - j) / (m + 1) + (2 * m + 1 - j) * (2 * m + 2 - j) / (4 * (m + 1) * (m + 2)) for j in range(m + 1, 2 * m + 1))]
    out: list[tuple[int, ...]] = [()]
    heap = [(expected[1], (1,))]
    while heap and len(out) < probes:
        score, moves = heapq.heappop(heap)
        if not any(2 * m + 1 - j in moves for j in moves):
            out.append(moves)
        top = moves[-1]
        if top < 2 * m:
            heapq.heappush(heap, (score - expected[top] + expected[top + 1], (*moves[:-1], top + 1)))
            heapq.heappush(heap, (score + expected[top + 1], (*moves, top + 1)))
    return out


@lru_cache(maxsize=64)
def _functions(index: Index, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Directions, shifts and bucket-name factors for vectors of this length."""
    rng = np.random.default_rng([index.seed, length])
    n = index.hashes * index.tables
    return rng.normal(size=(length + 1, n)), rng.uniform(0, index.width, n), rng.integers(1, 1 << 62, n) * 2 + 1


def _names(slots: np.ndarray, factors: np.ndarray, index: Index) -> np.ndarray:
    """64-bit bucket name of each table; tables have factors of their own."""
    with np.errstate(over="ignore"):
        mixed = slots.astype(np.int64) * factors + factors // 3
        parts = (mixed ^ (mixed >> 29)).reshape(len(slots), index.tables, index.hashes) * np.int64(-7046029254386353131)
        return parts.sum(axis=2)


def buckets(x: np.ndarray, largest: float, index: Index) -> np.ndarray:
    """Bucket names of vectors, one column per table."""
    a, b, factors = _functions(index, x.shape[1])
    x = x / largest
    more = np.sqrt(np.maximum(0, 1 - (x * x).sum(axis=1)))
    return _names(np.floor((np.column_stack([x, more]) @ a + b) / index.width), factors, index)


def visits(q: np.ndarray, index: Index) -> np.ndarray:
    """Bucket names each query visits, in probing order: (query, probe, table)."""
    a, b, factors = _functions(index, q.shape[1])
    q = q / np.abs(q).max(axis=1, keepdims=True)
    q = q / np.linalg.norm(q, axis=1, keepdims=True)
    place = (np.column_stack([q, np.zeros(len(q))]) @ a + b) / index.width
    slot = np.floor(place)
    m = index.hashes
    low = (place - slot).reshape(len(q), index.tables, m)
    order = np.argsort(np.concatenate([low, 1 - low], axis=2), axis=2, kind="stable")  # below m: down, else up
    out = []
    for moves in probing_order(m, index.probes):
        step = np.zeros((len(q), index.tables, m))
        for j in moves:
            side = order[:, :, j - 1]
            np.put_along_axis(step, (side % m)[:, :, None], np.where(side < m, -1.0, 1.0)[:, :, None], axis=2)
        out.append(_names(slot + step.reshape(slot.shape), factors, index))
    return np.stack(out, axis=1)


def _shift(band: int) -> int:
    """What a norm band adds to its bucket names, modulo 2 ** 64; 0 for band 0."""
    return (band * 0x9E3779B97F4A7C15 + (1 << 63)) % (1 << 64) - (1 << 63)


def _whole(dim: int, band: int) -> int:
    """Name of the one bucket of a band that is not hashed."""
    return ~_shift((band << 32) + dim)


def _hashed(scale: float, index: Index | None) -> bool:
    return index is not None and 0 < scale < math.inf


def _placed(x: np.ndarray, band: int, scale: float, index: Index | None) -> np.ndarray:
    """Bucket names of vectors of one band; without index it is one bucket."""
    if not _hashed(scale, index):
        return np.full((len(x), 1), _whole(x.shape[1], band))
    return buckets(x, scale, index) + np.int64(_shift(band))


def _visited(q: np.ndarray, bands: list[tuple[int, float]], index: Index | None) -> Iterator[np.ndarray]:
    """Bucket names each query visits, band by band."""
    near = visits(q, index).reshape(len(q), -1) if any(_hashed(scale, index) for _, scale in bands) else None
    for band, scale in bands:
        yield near + np.int64(_shift(band)) if _hashed(scale, index) else np.full((len(q), 1), _whole(q.shape[1], band))


def _norm(v: np.ndarray) -> tuple[float, int]:
    """Norm of a vector (infinite if a double can't hold it) and its band: the
    nearest power of two."""
    most = float(np.abs(v).max())
    part = float(np.linalg.norm(v / most))
    return most * part, round(math.log2(most) + math.log2(part))


def _usable(rows: DataFrame) -> tuple[DataFrame, str]:
    """(vec_id, dim, vec, norm, band), usable vectors as bytes; and their type."""
    kind = rows.schema["embedding"].dataType.elementType.simpleString()
    dtype = "<f4" if kind == "float" else "<f8"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, dims, vecs, norms = [], [], [], []
            lists = b.column("embedding")
            values = lists.values.to_numpy(zero_copy_only=False).astype(dtype)
            at = lists.offsets.to_numpy()
            for i, (id_, ok) in enumerate(zip(b.column("vec_id").to_pylist(), lists.is_valid().to_pylist(), strict=True)):
                v = values[at[i] : at[i + 1]]
                if ok and id_ is not None and v.any() and np.isfinite(v).all():
                    ids.append(id_)
                    dims.append(len(v))
                    vecs.append(v.tobytes())
                    norms.append(_norm(v.astype(np.float64)))
            cols = [pa.array(ids, pa.int64()), pa.array(dims, pa.int32()), pa.array(vecs, pa.binary()), pa.array([n for n, _ in norms], pa.float64()), pa.array([band for _, band in norms], pa.int32())]
            yield pa.RecordBatch.from_arrays(cols, ["vec_id", "dim", "vec", "norm", "band"])

    own = only(rows, "vec_id", "embedding").withColumn("vec_id", F.col("vec_id").cast("long"))
    if kind not in ("float", "double"):
        own = own.withColumn("embedding", F.col("embedding").cast("array<double>"))
    return own.mapInArrow(run, "vec_id long, dim int, vec binary, norm double, band int"), dtype


def _matrix(vecs: pa.Array, dtype: str, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(vecs.to_pylist()), dtype).reshape(-1, dim).astype(np.float64)


def _with_bands(classes: DataFrame) -> DataFrame:
    """Classes with ``scale``, the largest norm of their band, and, where they
    ask, ``bands``: all bands of their length with their scales, and ``there``,
    the number of classes of it. A length has no more bands than doubles have
    exponents."""
    sums = cut(classes.groupBy("dim", "band").agg(F.count(F.lit(1)).alias("n"), F.max("norm").alias("scale")))
    lengths = sums.groupBy("dim").agg(F.sort_array(F.collect_list(F.struct("band", "scale"))).alias("bands"), F.sum("n").alias("there"))
    rows = classes.drop("norm").join(small_side(sums.drop("n")), ["dim", "band"]).join(small_side(cut(lengths)), "dim")
    return rows.withColumn("bands", F.when(F.col("asks"), F.col("bands")))


def _entries(classes: DataFrame, index: Index | None, dtype: str, with_vectors: bool) -> DataFrame:
    """A row for each bucket a vector is in (kind 1) and each that a query
    visits (kind 0)."""

    def named(part: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, pa.Array, np.ndarray]]:
        dims, bands, scales = (part.column(c).to_numpy() for c in ("dim", "band", "scale"))
        asks = np.array(part.column("asks").to_pylist(), bool)
        for dim in np.unique(dims).tolist():
            for band in np.unique(bands[dims == dim]).tolist():
                rows = np.flatnonzero((dims == dim) & (bands == band))
                vecs = part.column("vec").take(pa.array(rows))
                yield 1, rows, vecs, _placed(_matrix(vecs, dtype, dim), band, float(scales[rows[0]]), index)
            rows = np.flatnonzero((dims == dim) & asks)
            if len(rows):
                vecs = part.column("vec").take(pa.array(rows))
                all_bands = [(b["band"], b["scale"]) for b in part.column("bands")[int(rows[0])].as_py()]
                for names in _visited(_matrix(vecs, dtype, dim), all_bands, index):
                    yield 0, rows, vecs, names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                for kind, rows, vecs, names in named(part):
                    for step in range(0, names.shape[1], 16):
                        block = names[:, step : step + 16]
                        take = pa.array(np.repeat(np.arange(len(rows)), block.shape[1]))
                        cols = [pa.array(block.ravel()), pa.array(np.full(block.size, kind, np.int32))]
                        cols += [part.column(c).take(pa.array(rows)).take(take) for c in ("cls", "least", "dim")]
                        yield pa.RecordBatch.from_arrays([*cols, *([vecs.take(take)] if with_vectors else [])], ["bucket", "kind", "cls", "least", "dim", *(["vec"] if with_vectors else [])])

    return classes.mapInArrow(run, "bucket long, kind int, cls long, least long, dim int" + (", vec binary" if with_vectors else ""))


def _sample_truth(classes: DataFrame, sample: list, dtype: str, k: int) -> DataFrame:
    """(q, vec, band, scale): the k nearest of each sampled query's vector
    (number q of the sample) among all classes; a task sends its best k."""
    by_dim: dict[int, list[int]] = {}
    for q, r in enumerate(sample):
        by_dim.setdefault(r["dim"], []).append(q)
    asked = {dim: np.frombuffer(b"".join(bytes(sample[q]["vec"]) for q in qs), dtype).reshape(-1, dim).astype(np.float64) for dim, qs in by_dim.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims = b.column("dim").to_numpy()
            for dim, qs in by_dim.items():
                rows = np.flatnonzero(dims == dim)
                if not len(rows):
                    continue
                scores = asked[dim] @ _matrix(b.column("vec").take(pa.array(rows)), dtype, dim).T
                n = min(k, len(rows))
                best = np.argpartition(-scores, n - 1, axis=1)[:, :n]
                i = np.repeat(np.arange(len(qs)), n)
                at = pa.array(rows[best.ravel()])
                cols = [pa.array(np.array(qs, np.int32)[i]), pa.array(scores[i, best.ravel()])]
                yield pa.RecordBatch.from_arrays([*cols, *(b.column(c).take(at) for c in ("least", "vec", "band", "scale"))], ["q", "score", "least", "vec", "band", "scale"])

    found = classes.select("dim", "least", "vec", "band", "scale").mapInArrow(run, "q int, score double, least long, vec binary, band int, scale double")
    nearest = W.partitionBy("q").orderBy(F.desc("score"), "least")
    return found.withColumn("nth", F.row_number().over(nearest)).where(F.col("nth") <= k)


def choose(classes: DataFrame, dtype: str, k: int, settings: Sequence[tuple[int, int, int, float]] = SETTINGS, recall: float = RECALL) -> Index | None:
    """The cheapest setting whose recall on the sample is high enough, or none."""
    few = classes.where("asks").orderBy(F.xxhash64("vec"), "vec").limit(SAMPLE_QUERIES).select("dim", "vec").collect()
    if not few:
        return None
    truth = _sample_truth(classes, few, dtype, k + 1).collect()  # k + 1 vectors a query
    some = classes.orderBy(F.xxhash64("vec", F.lit(1)), "vec").limit(SAMPLE_VECTORS).select("dim", "band", "scale", "vec").collect()
    n, asking = classes.agg(F.count(F.lit(1)), F.count_if("asks")).first()
    read = lambda rows, dim: np.frombuffer(b"".join(bytes(r["vec"]) for r in rows), dtype).reshape(-1, dim).astype(np.float64)

    def grouped(rows: list) -> list[tuple[int, int, float, list]]:
        """Rows by length and band: what has one scale."""
        out: dict = {}
        for r in rows:
            out.setdefault((r["dim"] if "dim" in r else few[r["q"]]["dim"], r["band"], r["scale"]), []).append(r)
        return [(*key, own) for key, own in out.items() if 0 < key[2] < math.inf]

    dims = sorted({r["dim"] for r in few})
    best: tuple[float, Index] | None = None
    for hashes, tables, probes, width in settings:
        index = Index(hashes, tables, probes, width)
        near = {}  # visits of each sampled query, a sorted list a table
        for dim in dims:
            own = [q for q, r in enumerate(few) if r["dim"] == dim]
            for q, seen in zip(own, visits(read([few[q] for q in own], dim), index), strict=True):
                near[q] = [np.unique(seen[:, t]) for t in range(tables)]
        met = 0
        for dim, _, scale, own in grouped(truth):
            for r, names in zip(own, buckets(read(own, dim), scale, index), strict=True):
                met += any(names[t] in near[r["q"]][t] for t in range(tables))
        if met < recall * len(truth):
            continue
        pairs = 0
        for dim, _, scale, own in grouped(some):
            names = buckets(read(own, dim), scale, index)
            pairs += sum(int(np.isin(names[:, t], near[q][t]).sum()) for q in near if few[q]["dim"] == dim for t in range(tables))
        share = pairs / (len(few) * max(1, len(some)))
        cost = tables * (n + asking * probes) + asking * n * share / PAIRS_PER_COPY
        if best is None or cost < best[0]:
            best = cost, index
    return best and best[1]


def _best(found: list[tuple], k: int) -> tuple[np.ndarray, ...]:
    """The k best different candidates of each query; ties to the smaller id."""
    q, c, least, score = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((c, least, -score, q))
    q, c, least, score = q[order], c[order], least[order], score[order]
    new = np.ones(len(q), bool)
    new[1:] = (q[1:] != q[:-1]) | (c[1:] != c[:-1])
    q, c, least, score = q[new], c[new], least[new], score[new]
    first = np.flatnonzero(np.concatenate([[True], q[1:] != q[:-1]]))
    nth = np.arange(len(q)) - np.repeat(first, np.diff(np.append(first, len(q))))
    return tuple(x[nth < k] for x in (q, c, least, score))


def _score_blocks(entries: DataFrame, dtype: str, k: int) -> DataFrame:
    """Best candidates of each query in a task's blocks, one row a query with
    lists (q, c, least, score). Rows come sorted by block, visits first."""

    def block(rows: list[pa.RecordBatch]) -> tuple | None:
        t = pa.Table.from_batches(rows)
        kind = t.column("kind").to_numpy()
        n = int((kind == 0).sum())
        if not n or n == len(kind):
            return None
        x = _matrix(t.column("vec").combine_chunks(), dtype, t.column("dim")[0].as_py())
        cls, least = t.column("cls").to_numpy(), t.column("least").to_numpy()
        found = []
        rounding = 4 * x.shape[1] * np.finfo(np.float64).eps * np.linalg.norm(x[n:], axis=1).max()
        for at in range(0, n, 1024):
            asked, scores = x[at : min(n, at + 1024)], x[at : min(n, at + 1024)] @ x[n:].T
            last = scores.shape[1] - min(k, scores.shape[1])
            low = np.partition(scores, last, axis=1)[:, last] - rounding * np.linalg.norm(asked, axis=1)
            i, j = np.nonzero(~(scores < low[:, None]))  # ties at the cut too: ids decide among them
            step = max(1, _CELLS // x.shape[1])
            for part in range(0, len(i), step):
                u, w = i[part : part + step], j[part : part + step]
                found.append(_best([(cls[at + u], cls[n + w], least[n + w], (asked[u] * x[n + w]).sum(axis=1))], k))
        return tuple(np.concatenate(f) for f in zip(*found, strict=True))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple] = []
        held, rows, last = 0, [], None
        for b in batches:
            key = np.column_stack([b.column(c).to_numpy() for c in ("bucket", "dim", "v", "q")])
            if not len(key):
                continue
            cuts = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1).tolist(), len(key)]
            for i, j in zip(cuts[:-1], cuts[1:], strict=True):
                if rows and tuple(key[i]) != last and (got := block(rows)):
                    found.append(got)
                    held += len(got[0])
                if tuple(key[i]) != last:
                    rows, last = [], tuple(key[i])
                rows.append(b.slice(i, j - i))
                if held > _HELD:
                    found = [_best(found, k)]
                    held = 0
        if rows and (got := block(rows)):
            found.append(got)
        if found:
            yield from _listed(*_best(found, k))

    return entries.mapInArrow(run, _LISTS)


_LISTS = "q long, c array<long>, least array<long>, score array<double>"


def _listed(q: np.ndarray, *values: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One row a query; values come sorted by query."""
    first = np.flatnonzero(np.concatenate([[True], q[1:] != q[:-1]]))
    ends = np.append(first[1:], len(q))
    for at in range(0, len(first), 4096):
        i, j = first[at : at + 4096], ends[at : at + 4096]
        offsets = pa.array(np.append(i - i[0], j[-1] - i[0]).astype(np.int32))
        lists = [pa.ListArray.from_arrays(offsets, pa.array(v[i[0] : j[-1]])) for v in values]
        yield pa.RecordBatch.from_arrays([pa.array(q[i]), *lists], ["q", "c", "least", "score"])


def _merge(lists: DataFrame, k: int) -> DataFrame:
    """(q, c, score): the k best of each query over the lists of all tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[tuple] = []

        def rows(found: list[tuple]) -> pa.RecordBatch:
            q, c, _, score = _best(found, k)
            return pa.RecordBatch.from_arrays([pa.array(q), pa.array(c), pa.array(score)], ["q", "c", "score"])

        for b in batches:
            if not b.num_rows:
                continue
            n = np.diff(b.column("c").offsets.to_numpy())
            new = (np.repeat(b.column("q").to_numpy(), n), *(b.column(x).flatten().to_numpy() for x in ("c", "least", "score")))
            rest.append(new)
            last = new[0] == new[0][-1]  # sorted by query: all others are complete
            if not last.all() or rest[0][0][0] != new[0][-1]:
                done = [tuple(x[~last] for x in new)]
                yield rows([*rest[:-1], *done])
                rest = [tuple(x[last] for x in new)]
        if rest:
            yield rows(rest)

    return lists.repartition("q").sortWithinPartitions("q").mapInArrow(run, "q long, c long, score double")


def _found(classes: DataFrame, index: Index | None, dtype: str, k: int, block: int) -> DataFrame:
    """(q, c, score): the k + 1 nearest classes that each asking class meets."""
    entries = _entries(classes, index, dtype, False)
    parts = [F.ceil(F.sum((F.col("kind") == kind).cast("long")) / block).cast("int").alias(name) for kind, name in ((1, "v_parts"), (0, "q_parts"))]
    large = cut(entries.groupBy("bucket").agg(*parts).where("v_parts > 1 or q_parts > 1"))
    dealt = _entries(classes, index, dtype, True).join(large, "bucket", "left")
    v_parts, q_parts = (F.greatest(F.lit(1), F.coalesce(c, F.lit(1))) for c in ("v_parts", "q_parts"))
    mine = lambda parts: F.array(F.pmod(F.xxhash64("cls"), parts).cast("int"))
    every = lambda parts: F.sequence(F.lit(0), parts - 1)
    grid = dealt.withColumn("v", F.explode(F.when(F.col("kind") == 1, mine(v_parts)).otherwise(every(v_parts))))
    grid = grid.withColumn("q", F.explode(F.when(F.col("kind") == 0, mine(q_parts)).otherwise(every(q_parts)))).drop("v_parts", "q_parts")
    blocks = grid.repartition("bucket", "v", "q").sortWithinPartitions("bucket", "dim", "v", "q", "kind")
    return _merge(_score_blocks(blocks, dtype, k + 1), k + 1)


def search(rows: DataFrame, asks: Column, k: int = K, index: Index | None = None, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found for every row of
    (vec_id, embedding) where ``asks`` (a condition on vec_id) holds. ``index``
    sets the parameters instead of choosing them."""
    usable, dtype = _usable(rows)
    usable = cut(usable.distinct())
    is_query = F.coalesce(asks, F.lit(False))
    classes = cut(usable.groupBy("dim", "vec").agg(F.min("vec_id").alias("least"), F.max(is_query).alias("asks"), F.first("norm").alias("norm"), F.first("band").alias("band")))
    classes = cut(_with_bands(classes.withColumn("cls", F.monotonically_increasing_id())))
    index = index or choose(classes, dtype, k)
    near = cut(_found(classes, index, dtype, k, block))
    if index is not None:
        counts = near.groupBy(F.col("q").alias("cls")).agg(F.count(F.lit(1)).alias("n"))
        few = F.coalesce("n", F.lit(0)) < F.least("there", F.lit(k + 1))
        short = cut(classes.where("asks").select("cls", "dim", "there").join(counts, "cls", "left").where(few).select("cls", "dim"))
        if not short.isEmpty():
            asking = short.select("cls", F.lit(True).alias("short"))
            own = classes.join(small_side(short.select("dim").distinct()), "dim", "left_semi")
            again = own.join(asking, "cls", "left").withColumn("asks", F.coalesce("short", F.lit(False))).drop("short")
            whole = _found(cut(again), None, dtype, k, block)
            near = cut(near.join(short.select(F.col("cls").alias("q")), "q", "left_anti").unionByName(whole))
    named = usable.join(classes.select("dim", "vec", "cls"), ["dim", "vec"]).select("vec_id", "cls")
    first = W.partitionBy("cls").orderBy("vec_id")
    members = named.withColumn("n", F.row_number().over(first)).where(F.col("n") <= k + 1).select(F.col("cls").alias("c"), "vec_id")
    nearest = W.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    found = cut(near.join(members, "c").withColumn("n", F.row_number().over(nearest)).where(F.col("n") <= k + 1).select("q", "vec_id", "score"))
    askers = cut(named.where(is_query).select(F.col("vec_id").alias("query_id"), F.col("cls").alias("q")).distinct())
    own = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    out = askers.join(found, "q").where("query_id <> vec_id").withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= k)
    return out.select("query_id", "rank", "vec_id", "score")
