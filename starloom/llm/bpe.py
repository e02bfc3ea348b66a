"""BPE encoding and decoding by forced-boundary splitting (operator 7).

A merge can only build a vocabulary token, so two neighbouring symbols that
stand side by side in no token can never end up in one token: between them a
cut is certain. The text is cut there, each fragment is encoded on its own and
the ids are concatenated; the result equals the encoding of the whole text.

The cuts come in two sizes. White space is in no token, and the tokenizer's own
pre-tokens never cross it, so every text falls apart into pre-tokens first.
Inside a pre-token the table of neighbouring symbols taken from the vocabulary
marks the rest. Both pre-tokens and fragments repeat a lot, so each worker keeps
a bounded memo of them; it only saves time.

The tokenizer is a file of the ``tokenizers`` library: a BPE model with an
end-of-word suffix, byte-level symbols and the normaliser and pre-tokeniser
that the file names. Characters up to U+00FF are normalised and pre-tokenised
by one regular expression with the same classes; a white-space-free piece that
holds anything else, or the text of an added token, goes through the library's
own normaliser and pre-tokeniser.

Defined results: null text is encoded like the empty text (no ids, empty
decoded text); repeated rows give repeated rows; texts are never cut short.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from array import array
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from tokenizers import Tokenizer, models, pre_tokenizers

from starloom.llm.common import only

# The pre-token pattern the tokenizer file must carry.
LIBRARY_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# Not for the short way: what lies beyond U+00FF, and the characters up to
# there that only one of the two sides counts as white space.
OTHER = re.compile("[^\x00-\x1b\x20-\x84\x86-\x9f\xa1-\xff]")
PIECE = re.compile("[^ \t-\r]+")
MEMO_WORDS = 400_000  # memo entries per worker; a full memo is started anew
MEMO_LENGTH = 40  # bytes; longer words are not kept
BLOCK_CHARS = 4_000_000  # texts are taken together up to this many characters

_GAP, _LETTER, _NUMBER, _MARK = range(4)


def _latin_tables() -> tuple[np.ndarray, np.ndarray]:
    """Lower case and pre-token class of the characters up to U+00FF."""
    lower = np.array([ord(chr(i).lower()) for i in range(256)], dtype=np.uint8)
    kind = np.full(256, _MARK, dtype=np.int8)
    for i in range(256):
        if chr(i).isalpha():
            kind[i] = _LETTER
        elif chr(i).isnumeric():
            kind[i] = _NUMBER
    kind[[0x20, *range(9, 14)]] = _GAP
    return lower, kind


LATIN_LOWER, LATIN_KIND = _latin_tables()


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level BPE:
    printable Latin-1 stands for itself, the rest follow from U+0100 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b if b in own else next(rest)) for b in range(256)]


def latin_pretokens(data: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Lower-cased pre-tokens of Latin-1 bytes and where each begins."""
    d = LATIN_LOWER[np.concatenate([data, np.full(4, 0x20, np.uint8)])]
    kind = LATIN_KIND[d]
    before = np.concatenate([np.full(1, _GAP, np.int8), kind[:-1]])
    start = (kind != _GAP) & ((kind != before) | (kind == _NUMBER))
    quote = np.flatnonzero(start & (d == 0x27))
    if len(quote):  # contractions: a quote that begins a pre-token takes one or two letters along
        one, two = d[quote + 1], d[quote + 2]
        short = np.isin(one, np.frombuffer(b"stmd", np.uint8))
        long = (np.isin(one, np.frombuffer(b"rv", np.uint8)) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
        for at, n in ((quote[short], 2), (quote[long], 3)):
            start[at + 1] = False
            start[at + n] = kind[at + n] != _GAP
    at = np.flatnonzero(start)
    keep = kind != _GAP
    words = d[keep]
    offsets = np.append((np.cumsum(keep, dtype=np.int32) - 1)[at], np.int32(len(words))).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(words)]), at


class ForcedBpe:
    """Encoder and decoder of one tokenizer file."""

    def __init__(self, path: str, memo_words: int = MEMO_WORDS):
        self.lib = Tokenizer.from_file(path)
        self.lib.no_truncation()
        self.lib.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        patterns = [p.get("pattern", {}).get("Regex") for p in (spec["pre_tokenizer"] or {}).get("pretokenizers", [])]
        if model["type"] != "BPE" or LIBRARY_SPLIT not in patterns:
            raise ValueError(f"{path}: not a BPE tokenizer with the expected pre-token pattern")
        self.suffix = model.get("end_of_word_suffix") or ""
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.symbols = byte_symbols()
        self.byte_of = {c: b for b, c in enumerate(self.symbols)}
        self.inside, self.at_end = self._neighbours(model["vocab"])
        self.bulk = {}  # by whether the fragment ends its word
        for final in (True, False):
            own = {"end_of_word_suffix": self.suffix} if final and self.suffix else {}
            self.bulk[final] = Tokenizer(models.BPE(model["vocab"], merges, **own))
            self.bulk[final].pre_tokenizer = pre_tokenizers.Split("\n", "removed")
        self.added = {a["content"]: a["id"] for a in spec["added_tokens"]}
        self.added_split = re.compile("(" + ("|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) or "(?!)") + ")")
        self.strings = [self.lib.id_to_token(i) or "" for i in range(self.lib.get_vocab_size())]
        self.memo_words = memo_words
        self._forget()

    def _neighbours(self, vocab: Iterable[str]) -> tuple[np.ndarray, np.ndarray]:
        """Which two bytes stand side by side inside some token; apart from
        them, which do so where the second one ends a word."""
        inside, at_end = np.zeros((256, 256), bool), np.zeros((256, 256), bool)
        for token in vocab:
            ends = bool(self.suffix) and token.endswith(self.suffix)
            body = [self.byte_of[c] for c in (token[: -len(self.suffix)] if ends else token) if c in self.byte_of]
            for i in range(1, len(body)):
                (at_end if ends and i == len(body) - 1 else inside)[body[i - 1], body[i]] = True
        return inside, at_end if self.suffix else inside

    def _forget(self) -> None:
        self.words: dict[bytes, int] = {}
        self.ids, self.starts, self.lengths = array("I"), array("q"), array("q")

    def cuts(self, data: np.ndarray, last: np.ndarray) -> np.ndarray:
        """For each byte whether a certain boundary follows it; ``last`` marks
        the bytes that end a word."""
        cut = last.copy()
        if len(data) > 1:
            a, b = data[:-1], data[1:]
            cut[:-1] |= ~np.where(last[1:], self.at_end[a, b], self.inside[a, b])
        return cut

    def _encode_words(self, words: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in a row, and how many each has: cut, encode the
        fragments, concatenate."""
        if not words:
            return np.empty(0, np.uint32), np.empty(0, np.int64)
        data = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        last = np.zeros(len(data), bool)
        last[ends - 1] = True
        cut = self.cuts(data, last)
        stop = np.flatnonzero(cut) + 1
        final = last[stop - 1]
        begin = np.concatenate([[0], stop[:-1]])
        text = data.tobytes().decode("latin-1").translate(self.symbols)
        n, got = np.zeros(len(stop), np.int64), {}
        for kind in (True, False):
            at = np.flatnonzero(final == kind)
            if len(at):
                code = self.bulk[kind].encode("\n".join([text[i:j] for i, j in zip(begin[at].tolist(), stop[at].tolist(), strict=True)]), add_special_tokens=False)
                got[kind] = at, np.array(code.ids, np.uint32)
                n[at] = np.bincount(np.array(code.word_ids, np.int64), minlength=len(at))
        first = np.cumsum(n) - n
        flat = np.empty(int(n.sum()), np.uint32)
        for at, ids in got.values():
            m = n[at]
            flat[np.repeat(first[at] - np.cumsum(m) + m, m) + np.arange(len(ids))] = ids
        return flat, np.add.reduceat(n, np.concatenate([[0], np.flatnonzero(final)[:-1] + 1]))

    def _encode_piece(self, piece: str) -> np.ndarray:
        """A white-space-free piece by the library's normaliser and pre-tokeniser."""
        ids: list[np.ndarray] = [np.empty(0, np.uint32)]
        for part in self.added_split.split(piece):
            if part in self.added:
                ids.append(np.array([self.added[part]], np.uint32))
            elif part:
                normal = self.lib.normalizer.normalize_str(part)
                ids.append(self._encode_words([bytes(map(self.byte_of.__getitem__, w)) for w, _ in self.lib.pre_tokenizer.pre_tokenize_str(normal)])[0])
        return np.concatenate(ids)

    def _lookup(self, distinct: list[bytes]) -> np.ndarray:
        """Memo places of Latin-1 pre-tokens; new ones are encoded together."""
        at = np.fromiter((self.words.get(w, -1) for w in distinct), np.int64, len(distinct))
        new = np.flatnonzero(at < 0)
        words = [distinct[i] for i in new.tolist()]
        ids, n = self._encode_words([w if w.isascii() else w.decode("latin-1").encode() for w in words])
        at[new] = len(self.starts) + np.arange(len(new))
        self.words.update((w, i) for w, i in zip(words, at[new].tolist(), strict=True) if len(w) <= MEMO_LENGTH)
        self.starts.frombytes((len(self.ids) + np.cumsum(n) - n).tobytes())
        self.lengths.frombytes(n.tobytes())
        self.ids.frombytes(ids.tobytes())
        return at

    def _encode_latin(self, runs: list[bytes]) -> list[np.ndarray]:
        """Ids of each run of Latin-1 bytes."""
        if len(self.words) > self.memo_words or len(self.ids) > 16 * self.memo_words:
            self._forget()
        data = np.frombuffer(b" ".join(runs), np.uint8)
        tokens, at = latin_pretokens(data)
        coded = tokens.dictionary_encode()
        place = self._lookup(coded.dictionary.to_pylist())[coded.indices.to_numpy(zero_copy_only=False)] if len(tokens) else np.empty(0, np.int64)
        ids, starts, lengths = (np.frombuffer(a, d) if len(a) else np.empty(0, d) for a, d in ((self.ids, np.uint32), (self.starts, np.int64), (self.lengths, np.int64)))
        n = lengths[place].astype(np.int32)
        ends = np.concatenate([[0], np.cumsum(n)])
        flat = ids[np.repeat(starts[place] - ends[:-1], n) + np.arange(ends[-1])]
        begin = np.cumsum([0, *[len(r) + 1 for r in runs[:-1]]])
        return np.split(flat, ends[np.searchsorted(at, begin[1:])]) if runs else []

    def _runs(self, text: str) -> list[bytes | str]:
        """The text as Latin-1 runs and, as str, the pieces that are not."""
        if not OTHER.search(text) and not any(a in text for a in self.added):
            return [text.encode("latin-1")]
        out: list[bytes | str] = []
        plain: list[str] = []
        for piece in PIECE.findall(text):
            if OTHER.search(piece) or any(a in piece for a in self.added):
                if plain:
                    out.append(" ".join(plain).encode("latin-1"))
                    plain = []
                out.append(piece)
            else:
                plain.append(piece)
        return [*out, " ".join(plain).encode("latin-1")] if plain else out

    def _encode_block(self, texts: list[str]) -> Iterator[np.ndarray]:
        runs = [self._runs(t) for t in texts]
        latin = iter(self._encode_latin([r for parts in runs for r in parts if isinstance(r, bytes)]))
        for parts in runs:
            got = [next(latin) if isinstance(r, bytes) else self._encode_piece(r) for r in parts]
            yield got[0] if len(got) == 1 else np.concatenate(got) if got else np.empty(0, np.uint32)

    def encode_many(self, texts: Iterable[str | None]) -> Iterator[np.ndarray]:
        """Ids of each whole text, as unsigned 32-bit integers, in order."""
        block: list[str] = []
        chars = 0
        for t in texts:
            block.append(t or "")
            chars += len(block[-1])
            if chars >= BLOCK_CHARS:
                yield from self._encode_block(block)
                block, chars = [], 0
        yield from self._encode_block(block)

    def encode(self, text: str | None) -> np.ndarray:
        return next(self.encode_many([text]))

    def decode(self, ids: np.ndarray) -> str:
        """The library's decode with special tokens kept. Without a decoder in
        the file that is the tokens joined by spaces."""
        if self.lib.decoder is not None:
            return self.lib.decode(ids.tolist(), skip_special_tokens=False)
        return " ".join(map(self.strings.__getitem__, ids.tolist()))


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> ForcedBpe:
    """One encoder per worker process and file."""
    return ForcedBpe(path)


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids): the ids of every whole text as array<int>."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for b in batches:
            for rows in slices(b):
                ids = [i.astype(np.int32) for i in bpe.encode_many(rows.column("text").to_pylist())]
                offsets = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int32)
                flat = pa.array(np.concatenate(ids) if ids else np.empty(0, np.int32), pa.int32())
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.ListArray.from_arrays(pa.array(offsets), flat)], ["doc_id", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return only(docs, "doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids array<int>")


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) from (doc_id, ids); null ids decode to the empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for b in batches:
            texts = [bpe.decode(np.array(i or [], dtype=np.int64)) for i in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return only(encoded, "doc_id", "ids").mapInArrow(run, f"doc_id {kind}, text string")


def slices(batch: pa.RecordBatch, rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """Short runs of a batch, so that only few texts are unpacked at a time."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Round trip of every whole text in one pass: (doc_id, n_tokens,
    ids_sha256, decoded_sha256). Ids are hashed as little-endian unsigned
    32-bit integers, the decoded text as UTF-8."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for b in batches:
            for rows in slices(b):
                n, ids_hash, text_hash = [], [], []
                for ids in bpe.encode_many(rows.column("text").to_pylist()):
                    n.append(len(ids))
                    ids_hash.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
                    text_hash.append(hashlib.sha256(bpe.decode(ids).encode()).hexdigest())
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids_hash, pa.string()), pa.array(text_hash, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return only(docs, "doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
