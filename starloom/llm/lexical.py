r"""Ranked lexical search by dual trees (operator 12).

Every item is a query; all documents with a positive score are ranked for it.
Terms are runs of ASCII digits and letters and of characters beyond ASCII, A-Z
lower-cased. With N documents that have a term, L terms in all and n in one
document, df documents with a term and tf its occurrences in one:

    w = floor(1000 ln((2 N + 2) / (2 df + 1)))
    m = 100 - 90 + (90 n N) div L
    coordinate = w ((1000000000 tf) div (1000 tf + 8 m))

and a document's score is the sum of its coordinates at the item's terms, whole
numbers throughout.

1. One pass over the texts keeps of each document n and the occurrences of the
   terms that any item has; N, L and df come from these vectors.
2. Documents form trees: ``BATCH`` vectors, ordered by their commonest and their
   heaviest term, are the root of groups and these of leaves; every node holds the largest value of
   each coordinate below it. Items form a tree of the same kind. The
   coordinates' weights make the sum over the terms of an item node of a
   document node's maxima a bound for every score of the two.
3. First round: in every batch each item looks into the one leaf with the best
   bound. The k-th best score found so far is a floor for the k-th best of all.
4. Second round: both trees are descended together from their roots. A pair of
   nodes whose bound is below the weakest floor of the node's items is dropped,
   with all documents and items below it; floors rise as scores come in. What is left
   is scored exactly. Equal bounds are kept, so ties are decided by id.

The pruning is exact: a dropped pair holds no document of any top k. A batch
sends its best k per item, and only scores that reach the floor; a window per
item merges them.

Items come in groups of at most ``GROUP_TERMS`` terms in all and ``GROUP_ITEMS`` items, so that a group's tree, broadcast to all tasks, is
bounded; each group is a search of its own over all documents.

Defined results: null texts have no terms; an item without terms that occur
finds nothing; items with the same id are one item with the terms of all, also
null ids; repeated documents are each ranked; equal scores go by id, nulls
last; an empty table of items or documents gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starloom.llm.bpe import slices
from starloom.llm.common import cut, only, stored

K = 10
BATCH, FAN, LEAF = 2048, 8, 16  # documents of a tree, of a group of leaves (times LEAF), of a leaf
ITEM_FAN = 16  # items of a lower item node
GROUP_TERMS, GROUP_ITEMS = 1_000_000, 512
COLUMNS = 4096  # terms of a dense block
CHUNK_BYTES = 4 << 20
_EXACT = 1 << 53  # whole numbers up to here are exact in doubles


def _terms_table() -> bytes:
    """Maps A-Z to a-z and every byte that is in no term to a space."""
    out = bytearray(range(256))
    for i in range(128):
        c = chr(i)
        out[i] = ord(c.lower()) if c.isalnum() else 0x20
    return bytes(out)


TERMS = _terms_table()


def term_counts(text: str | None, counts: Counter | None = None) -> tuple[int, Counter]:
    """(number of terms, occurrences of each as UTF-8) of one whole text."""
    counts = Counter() if counts is None else counts
    n, data = 0, (text or "").encode(errors="surrogatepass").translate(TERMS)
    at = 0
    while at < len(data):
        stop = len(data)
        if stop - at > CHUNK_BYTES:  # a long text chunk by chunk, cut between terms
            gap = data.find(b" ", at + CHUNK_BYTES)
            stop = len(data) if gap < 0 else gap
        words = data[at:stop].split()
        n += len(words)
        counts.update(words)
        at = stop
    return n, counts


@dataclass(frozen=True)
class Items:
    """A group of items: their ids and sorted terms (numbers of ``terms``)."""

    ids: list
    rows: list[np.ndarray]
    terms: list[bytes]


def _item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term) for the different terms of every item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for rows in slices(b, 64):
                ids, terms = [], []
                for i, text in enumerate(rows.column("text").to_pylist()):
                    found = term_counts(text)[1]
                    ids.extend([i] * len(found))
                    terms.extend(found)
                yield pa.RecordBatch.from_arrays([rows.column("item_id").take(pa.array(ids, pa.int64())), pa.array(terms, pa.binary())], ["item_id", "term"])

    own = only(items, "item_id", "text")
    own = own.withColumn("text", F.col("text").cast("string"))
    return own.mapInArrow(run, f"item_id {items.schema['item_id'].dataType.simpleString()}, term binary").distinct()


def _groups(item_terms: DataFrame, group_terms: int, group_items: int) -> Iterator[Items]:
    """Items in groups of bounded size, read from the driver one at a time."""
    sizes = cut(item_terms.groupBy("item_id").agg(F.count(F.lit(1)).alias("n")))
    total, items = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    # by hash, with room for uneven groups; an item's terms stay together
    groups = max(1, math.ceil(total * 1.5 / group_terms), math.ceil(items * 1.5 / group_items) if items > group_items else 1)
    place = F.pmod(F.xxhash64("item_id"), F.lit(groups))
    for group in range(groups):
        rows = item_terms.where(place == group).collect()
        terms = sorted({bytes(r["term"]) for r in rows})
        number = {t: i for i, t in enumerate(terms)}
        own: dict = {}
        for r in rows:
            own.setdefault(r["item_id"], []).append(number[bytes(r["term"])])
        if own:
            yield Items(list(own), [np.array(sorted(x), np.int64) for x in own.values()], terms)


_VECTORS = "n long, terms array<int>, tfs array<long>"


def _vectors(docs: DataFrame, terms: list[bytes]) -> DataFrame:
    """(doc_id, n, terms, tfs) of every document with a term: occurrences of
    the terms that items have."""
    sent = docs.sparkSession.sparkContext.broadcast({t: i for i, t in enumerate(terms)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = sent.value
        for b in batches:
            for rows in slices(b):
                ns, keys, tfs, keep = [], [], [], []
                for i, text in enumerate(rows.column("text").to_pylist()):
                    n, counts = term_counts(text)
                    if n:
                        found = counts.keys() & number.keys()
                        keep.append(i)
                        ns.append(n)
                        keys.append([number[t] for t in found])
                        tfs.append([counts[t] for t in found])
                cols = [rows.column("doc_id").take(pa.array(keep, pa.int64())), pa.array(ns, pa.int64()), pa.array(keys, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n", "terms", "tfs"])

    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {_VECTORS}")


def weight(df: int, n_docs: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


@dataclass(frozen=True)
class Statistics:
    n_docs: int
    n_terms: int
    weights: np.ndarray


class _Sparse:
    """Rows of (column, value), columns sorted within a row."""

    def __init__(self, rows: np.ndarray, cols: np.ndarray, values: np.ndarray, n: int, ordered: bool = False):
        if not ordered:
            order = np.lexsort((cols, rows))
            rows, cols, values = rows[order], cols[order], values[order]
        self.rows, self.cols, self.values, self.n = rows, cols, values, n
        self.starts = np.searchsorted(self.rows, np.arange(n + 1))

    def taken(self, rows: np.ndarray) -> "_Sparse":
        """These rows, numbered from 0."""
        n = self.starts[rows + 1] - self.starts[rows]
        at = np.repeat(self.starts[rows] - np.cumsum(n) + n, n) + np.arange(n.sum())
        return _Sparse(np.repeat(np.arange(len(rows)), n), self.cols[at], self.values[at], len(rows), True)

    def maxima(self, node_of: np.ndarray, n_nodes: int) -> "_Sparse":
        """Largest value of each column in the rows of each node."""
        node = node_of[self.rows]
        order = np.lexsort((self.cols, node))
        node, cols, values = node[order], self.cols[order], self.values[order]
        new = np.flatnonzero(np.concatenate([[True], (node[1:] != node[:-1]) | (cols[1:] != cols[:-1])])) if len(node) else np.zeros(0, np.int64)
        return _Sparse(node[new], cols[new], np.maximum.reduceat(values, new) if len(new) else values, n_nodes, True)


def products(a: _Sparse, b: _Sparse) -> np.ndarray:
    """Inner products of all rows of a with all rows of b, exact whole numbers:
    doubles hold them, or else integers do."""
    used = np.intersect1d(a.cols, b.cols)
    largest = float(np.abs(a.values).max(initial=0)) * float(np.abs(b.values).max(initial=0)) * len(used)
    kind = np.float64 if largest < _EXACT else np.int64
    out = np.zeros((a.n, b.n), kind)
    for at in range(0, len(used), COLUMNS):
        block = used[at : at + COLUMNS]
        sides = []
        for s in (a, b):
            place = np.searchsorted(block, s.cols)
            there = np.flatnonzero((place < len(block)) & (block[np.minimum(place, len(block) - 1)] == s.cols))
            dense = np.zeros((s.n, len(block)), kind)
            dense[s.rows[there], place[there]] = s.values[there]
            sides.append(dense)
        out += sides[0] @ sides[1].T
    return out.astype(np.int64)


class _Tree:
    """Levels from the root down to the rows: the vectors of each level's nodes
    and the first child of each node, one past the last at the end."""

    def __init__(self, leaves: _Sparse, widths: list[int]):
        """``widths``: rows of a node, level by level, root first."""
        self.levels = [leaves.maxima(np.arange(leaves.n) // w, -(-leaves.n // w)) for w in widths] + [leaves]
        sizes = [*widths, 1]
        self.children = [np.minimum(np.arange(level.n + 1) * (sizes[i] // sizes[i + 1]), self.levels[i + 1].n) for i, level in enumerate(self.levels[:-1])]

    def below(self, level: int, nodes: np.ndarray) -> np.ndarray:
        first, last = self.children[level][nodes], self.children[level][nodes + 1]
        return np.concatenate([np.arange(a, z) for a, z in zip(first, last, strict=True)]) if len(nodes) else nodes


class ItemTree:
    """The items of a group, ordered so that neighbours share common terms. An
    item's vector is 1 at its terms: the weights are in the documents'."""

    def __init__(self, items: Items, weights: np.ndarray):
        def common(row: np.ndarray) -> tuple:
            return tuple(row[np.lexsort((row, weights[row]))][:4].tolist())

        self.order = sorted(range(len(items.rows)), key=lambda i: common(items.rows[i]))
        rows = [items.rows[i] for i in self.order]
        n = np.array([len(r) for r in rows])
        ones = _Sparse(np.repeat(np.arange(len(rows)), n), np.concatenate(rows), np.ones(n.sum(), np.int64), len(rows))
        top = ITEM_FAN * ITEM_FAN * 64
        self.tree = _Tree(ones, [top, ITEM_FAN * ITEM_FAN, ITEM_FAN])


def _coordinates(tf: np.ndarray, n: np.ndarray, term: np.ndarray, stats: Statistics) -> np.ndarray:
    m = 10 + (90 * n * stats.n_docs) // stats.n_terms
    return stats.weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


class _Best:
    """The k best documents of each item found so far, and the floor each
    item's score must reach."""

    def __init__(self, n_items: int, k: int, floors: np.ndarray):
        self.k, self.floors = k, floors.copy()
        self.found: list[list[tuple]] = [[] for _ in range(n_items)]

    def add(self, item: int, scores: np.ndarray, docs: list) -> None:
        good = np.flatnonzero((scores >= self.floors[item]) & (scores > 0))
        if len(good):
            got = self.found[item] + [(-int(scores[i]), docs[i] is None, docs[i] if docs[i] is not None else 0) for i in good]
            self.found[item] = sorted(got)[: self.k]
            if len(self.found[item]) == self.k:
                self.floors[item] = max(self.floors[item], -self.found[item][-1][0])


def _doc_tree(doc_ids: list, vectors: pa.RecordBatch, stats: Statistics) -> tuple[list, _Tree]:
    lists = vectors.column("terms")
    n = np.diff(lists.offsets.to_numpy())
    term, tf = lists.flatten().to_numpy().astype(np.int64), vectors.column("tfs").flatten().to_numpy()
    row = np.repeat(np.arange(len(n)), n)
    value = _coordinates(tf, vectors.column("n").to_numpy()[row], term, stats)
    # ordered by the commonest term, then by the heaviest: leaves hold documents
    # of one language that share what scores most

    def first(*order: np.ndarray) -> np.ndarray:
        by = np.lexsort((*order, row))
        at = np.searchsorted(row[by], np.arange(len(n)))
        return np.where(n > 0, term[by][np.minimum(at, max(0, len(by) - 1))] if len(by) else -1, -1)

    by = np.lexsort((first(-value), first(stats.weights[term], -tf)))
    place = np.empty(len(n), np.int64)
    place[by] = np.arange(len(n))
    return [doc_ids[i] for i in by], _Tree(_Sparse(place[row], term, value, len(n)), [BATCH, FAN * LEAF, LEAF])


def _pilot(docs: _Tree, ids: list, items: ItemTree, best: _Best) -> None:
    """Every item scores the documents of its one most promising leaf."""
    last = len(items.tree.levels) - 1
    bounds = products(items.tree.levels[last], docs.levels[2])
    leaf = bounds.argmax(axis=1)
    for node in np.unique(leaf[bounds.max(axis=1) > 0]).tolist():
        own = np.flatnonzero(leaf == node)
        _score(docs, node, own, ids, items, best)


def _score(docs: _Tree, leaf: int, own: np.ndarray, ids: list, items: ItemTree, best: _Best) -> int:
    rows = docs.below(2, np.array([leaf]))
    scores = products(items.tree.levels[-1].taken(own), docs.levels[-1].taken(rows))
    names = [ids[i] for i in rows]
    for at, item in enumerate(own.tolist()):
        best.add(item, scores[at], names)
    return scores.size


def _descend(docs: _Tree, ids: list, items: ItemTree, best: _Best) -> int:
    """Both trees together; returns how many pairs of items and documents were
    scored, of all."""
    scored = 0
    stack = [(0, 0, np.arange(items.tree.levels[0].n))]  # (level, document node, item nodes of that level)
    while stack:
        level, node, nodes = stack.pop()
        item_vectors = items.tree.levels[level]
        bound = products(item_vectors.taken(nodes), docs.levels[level].taken(np.array([node])))[:, 0]
        floor = best.floors
        for below in range(len(items.tree.levels) - 2, level - 1, -1):
            floor = np.minimum.reduceat(floor, items.tree.children[below][:-1])
        nodes = nodes[(bound >= floor[nodes]) & (bound > 0)]
        if not len(nodes):
            continue
        children = items.tree.below(level, nodes)
        if level < 2:
            inner = docs.below(level, np.array([node]))
            hope = products(items.tree.levels[level + 1].taken(children), docs.levels[level + 1].taken(inner)).max(axis=0)
            for i in np.argsort(hope, kind="stable").tolist():  # the most promising one is taken next
                stack.append((level + 1, int(inner[i]), children))
            continue
        last = items.tree.levels[-1].taken(children)
        bound = products(last, docs.levels[2].taken(np.array([node])))[:, 0]
        own = children[(bound >= best.floors[children]) & (bound > 0)]
        if len(own):
            scored += _score(docs, node, own, ids, items, best)
    return scored


def _round(vectors: DataFrame, items: Items, stats: Statistics, floors: np.ndarray, k: int, pilot: bool) -> DataFrame:
    """(item, score, doc_id): the best k of each task's documents per item."""
    sent = vectors.sparkSession.sparkContext.broadcast((items, stats, floors))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, stats, floors = sent.value
        tree = ItemTree(items, stats.weights)
        best = _Best(len(items.ids), k, floors[tree.order])
        kind = pa.int64()
        for b in batches:
            kind = b.schema.field("doc_id").type
            for part in slices(b, BATCH):
                if part.num_rows:
                    ids, docs = _doc_tree(part.column("doc_id").to_pylist(), part, stats)
                    (_pilot if pilot else _descend)(docs, ids, tree, best)
        rows = [(tree.order[i], -s, None if null else d) for i, found in enumerate(best.found) for s, null, d in found]
        if rows:
            item, score, doc = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(score, pa.int64()), pa.array(doc, kind)], ["item", "score", "doc_id"])

    return vectors.mapInArrow(run, f"item int, score long, doc_id {vectors.schema['doc_id'].dataType.simpleString()}")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _searched(docs: DataFrame, items: Items, id_type: str, k: int) -> DataFrame:
    vectors = stored(_vectors(docs, items.terms), "vectors")
    spark = docs.sparkSession
    n_docs, n_terms = vectors.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    # one number for each term of the group
    df = {r["t"]: r["n"] for r in vectors.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("n")).collect()}
    stats = Statistics(n_docs, max(1, n_terms), np.array([weight(df.get(i, 0), n_docs) for i in range(len(items.terms))], np.int64))
    floors = np.zeros(len(items.ids), np.int64)
    # one number for each item of the group
    for r in _ranked(_round(vectors, items, stats, floors, k, True), k).where(F.col("rank") == k).collect():
        floors[r["item"]] = r["score"]
    found = _ranked(_round(vectors, items, stats, floors, k, False), k)
    names = spark.createDataFrame([(i, id_) for i, id_ in enumerate(items.ids)], f"item int, item_id {id_type}")
    return found.join(F.broadcast(names), "item").select("item_id", F.col("rank"), "doc_id", "score")


def search(items: DataFrame, docs: DataFrame, k: int = K, group_terms: int = GROUP_TERMS, group_items: int = GROUP_ITEMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents (doc_id, text) of
    every item (item_id, text) with a score above 0, best first."""
    id_type = items.schema["item_id"].dataType.simpleString()
    own = only(docs, "doc_id", "text")
    own = own.withColumn("text", F.col("text").cast("string")).where("text is not null")
    out = None
    for group in _groups(cut(_item_terms(items)), group_terms, group_items):
        got = cut(_searched(own, group, id_type, k))
        out = got if out is None else out.unionByName(got)
    if out is None:
        kind = docs.schema["doc_id"].dataType.simpleString()
        return docs.sparkSession.createDataFrame([], f"item_id {id_type}, rank int, doc_id {kind}, score long")
    return out
