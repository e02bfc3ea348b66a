"""Harmonic packing of documents into fixed-length sequences (operator 3).

Lengths fall into reciprocal-capacity classes: class k holds lengths in
(capacity / (k + 1), capacity / k], and a bin of class k is full with exactly k
pieces. A bin therefore needs no search: the piece joins the open bin of its
class, and the k-th piece closes it. Every worker keeps its own open bins, one
per class, so partitions are packed independently and nothing is shuffled.

Documents may be cut, which removes most of the padding a harmonic packing has:

* whole sequences come off a long document first (class 1);
* a remainder that leaves more than ``slack`` of its class's share unused is
  cut at the next smaller share, capacity // (k + 1), and what is left goes
  through the same rule again;
* the bins still open when a partition ends hold less than one bin per class.
  Their pieces are poured together into full sequences, cut at the edges; the
  last rest is cut into powers of two, which are not padded at all.

A worker holds the ids of its open bins only: fewer than ``capacity`` ids per
class and at most ``2 * sqrt(capacity)`` classes in use, whatever the input is.

Defined results: a null text counts as empty and is its end id alone; repeated
rows are packed each on its own; an empty table gives no rows. Sequence ids
carry the partition above ``SEQ_BITS`` and are unique; the input must come in
the same order when a partition is computed again (files do).
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from starloom.llm.bpe import encoder, slices
from starloom.llm.common import only

CAPACITY = 2048
END_ID = 1
SLACK = 1 / 64  # largest unused part of a class's share that is left as padding
SEQ_BITS = 33  # sequence_id = partition index << 33 | number in the partition


@dataclass
class Piece:
    doc: int  # place of the document in the partition's order
    start: int
    ids: np.ndarray
    sequence: int = -1
    offset: int = -1


@dataclass
class HarmonicPacker:
    """Packs a stream of documents; pieces come out once their bin is closed."""

    capacity: int = CAPACITY
    slack: float = SLACK
    closed: int = 0
    open: dict[int, list[Piece]] = field(default_factory=dict)

    def cut(self, n: int) -> list[int]:
        """Lengths of the pieces of a document of n ids."""
        out = [self.capacity] * (n // self.capacity)
        n %= self.capacity
        while n:
            k = self.capacity // n
            share = self.capacity // k
            if share - n <= self.slack * share:
                out.append(n)
                break
            out.append(self.capacity // (k + 1))
            n -= out[-1]
        return out

    def _close(self, pieces: Iterable[Piece]) -> list[Piece]:
        done, at = [], 0
        for p in pieces:
            p.sequence, p.offset = self.closed, at
            at += len(p.ids)
            done.append(p)
        self.closed += 1
        return done

    def add(self, doc: int, ids: np.ndarray) -> Iterator[Piece]:
        at = 0
        for n in self.cut(len(ids)):
            part = ids[at : at + n]
            piece = Piece(doc, at, part if n == self.capacity else part.copy())  # a waiting piece keeps no long document alive
            at += n
            k = self.capacity // n
            bin_ = self.open.setdefault(k, [])
            bin_.append(piece)
            if len(bin_) == k:
                yield from self._close(self.open.pop(k))

    def finish(self) -> Iterator[Piece]:
        """Pours the pieces of all open bins together."""
        rest = [p for k in sorted(self.open) for p in self.open.pop(k)]
        total = sum(len(p.ids) for p in rest)
        sizes = [self.capacity] * (total // self.capacity)
        left = total % self.capacity
        sizes += [1 << b for b in range(left.bit_length() - 1, -1, -1) if left >> b & 1]
        parts = iter(rest)
        piece = next(parts, None)
        for size in sizes:
            bin_, room = [], size
            while room and piece is not None:
                take = min(room, len(piece.ids))
                bin_.append(Piece(piece.doc, piece.start, piece.ids[:take]))
                room -= take
                piece = Piece(piece.doc, piece.start + take, piece.ids[take:]) if take < len(piece.ids) else next(parts, None)
            yield from self._close(bin_)


def pack(docs: DataFrame, encode: Callable[[list[str | None]], Iterable[np.ndarray]], capacity: int = CAPACITY, end_id: int = END_ID, slack: float = SLACK, checksums: bool = False, sequences: str | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id,
    offset and ids (array<int>), or with ``checksums`` instead of the ids their
    CRC-32 as little-endian unsigned 32-bit integers. ``encode`` gives the ids
    of each text of a list; ``end_id`` ends each document. With ``sequences`` (a
    numpy type such as "<u2") there is one row per sequence instead:
    sequence_id, length and its ids as bytes of that type."""

    extra, extra_type = ("ids_crc32", "long") if checksums else ("ids", "array<int>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = HarmonicPacker(capacity, slack)
        base = TaskContext.get().partitionId() << SEQ_BITS
        pending: dict[int, list] = {}  # documents with pieces in open bins: doc_id, tokens, ids not yet placed

        def rows(pieces: list[Piece]) -> pa.RecordBatch:
            docs_, tokens = [], []
            for p in pieces:
                known = pending[p.doc]
                docs_.append(known[0])
                tokens.append(known[1])
                known[2] -= len(p.ids)
                if not known[2]:
                    del pending[p.doc]
            longs = [pa.array(c, pa.int64()) for c in ([p.start for p in pieces], [len(p.ids) for p in pieces], tokens, [base + p.sequence for p in pieces], [p.offset for p in pieces])]
            if sequences:
                whole: dict[int, list[np.ndarray]] = {}
                for p in pieces:
                    whole.setdefault(p.sequence, []).append(p.ids)
                return pa.RecordBatch.from_arrays([pa.array([base + s for s in whole], pa.int64()), pa.array([sum(map(len, v)) for v in whole.values()], pa.int64()), pa.array([np.concatenate(v).astype(sequences).tobytes() for v in whole.values()], pa.binary())], ["sequence_id", "length", "tokens"])
            if checksums:
                last = pa.array([zlib.crc32(p.ids.astype("<u4", copy=False).tobytes()) for p in pieces], pa.int64())
            else:
                flat = pa.array(np.concatenate([p.ids for p in pieces]).astype(np.int32))
                last = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *(len(p.ids) for p in pieces)]).astype(np.int32)), flat)
            return pa.RecordBatch.from_arrays([pa.array(docs_, kind), *longs, last], NAMES + [extra])

        n = 0
        for b in batches:
            kind = b.schema.field("doc_id").type
            for part in slices(b):
                done: list[Piece] = []
                for doc, ids in zip(part.column("doc_id").to_pylist(), encode(part.column("text").to_pylist()), strict=True):
                    ids = np.append(ids, np.uint32(end_id))
                    pending[n] = [doc, len(ids), len(ids)]
                    done += packer.add(n, ids)
                    n += 1
                if done:
                    yield rows(done)
        if done := list(packer.finish()):
            yield rows(done)

    kind = docs.schema["doc_id"].dataType.simpleString()
    if sequences:
        return only(docs, "doc_id", "text").mapInArrow(run, "sequence_id long, length long, tokens binary")
    return only(docs, "doc_id", "text").mapInArrow(run, f"doc_id {kind}, start long, length long, doc_tokens long, sequence_id long, offset long, {extra} {extra_type}")


NAMES = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset"]


def pack_documents(docs: DataFrame, path: str, **options) -> DataFrame:
    """:func:`pack` with a tokenizer file."""
    return pack(docs, lambda texts: encoder(path).encode_many(texts), **options)
