"""Language identification by compression (operator 8).

Each language has a zstandard raw-content dictionary: bytes of that language,
joined. A text is encoded with every dictionary; the one that leaves the fewest
bytes names the language, because its frequent strings are found there. Whole
texts are encoded in chunks of ``CHUNK_BYTES``, each on its own, and the sizes
added: otherwise a long text would soon find its own beginning more useful than
any dictionary, and the sizes would draw level.

``margin`` is the part of the second smallest size that the smallest one saves.
A text whose margin is below ``min_margin`` is rejected (``accepted`` false);
its nearest language is still named.

Dictionaries are learned from a bounded sample of labelled rows: the
``SAMPLE_DOCS`` different texts of a language with the smallest hashes (all, if
fewer), and of each a run of ``SAMPLE_CHARS`` characters at a place picked by
the same hash. Equal texts are one, so a text that a third of the rows repeat
fills no sample, and every language that has a text is learned. The runs are
short because a passage that many documents share may stand in documents of
another language: a whole copy of it in a dictionary would win over its own
language. Only runs and hashes are shuffled, and the smallest are taken before
that in every task. At most ``MAX_LANGUAGES`` languages: beyond that it is an
error, as dictionaries are sent to every task. Predicting covers all rows.

Defined results: a null text or one without a letter is ``und`` with score 0
and not accepted, and so is every text if no labelled row with a letter exists; with a single
learned language the score is 1; equal sizes go to the first language by name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property, lru_cache

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starloom.llm.bpe import slices
from starloom.llm.common import cut, only

UNKNOWN = "und"
SAMPLE_DOCS = 3000
SAMPLE_CHARS = 48
MAX_LANGUAGES = 256
CHUNK_BYTES = 2048
LEVEL = 6
MIN_MARGIN = 0.002


@dataclass(frozen=True)
class LanguageModel:
    """Dictionaries by language; small and of fixed size."""

    languages: tuple[str, ...]
    dictionaries: tuple[bytes, ...]
    chunk_bytes: int = CHUNK_BYTES
    level: int = LEVEL

    @cached_property
    def key(self) -> str:
        return hashlib.sha256(repr((self.languages, self.chunk_bytes, self.level)).encode() + b"".join(self.dictionaries)).hexdigest()


def held_out(doc_id: Column | str) -> Column:
    """Whether a document is kept from learning: crc32 of its id as text leaves
    1 when divided by 3."""
    id_ = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.pmod(F.crc32(id_.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def learn(labelled: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_chars: int = SAMPLE_CHARS) -> LanguageModel:
    """Dictionaries from rows (doc_id, text, lang); rows without a letter,
    label or id teach nothing."""
    rows = only(labelled, "doc_id", "text", "lang").where("lang is not null and doc_id is not null").where(F.col("text").rlike(r"\p{L}"))
    start = F.pmod(F.hash("h"), F.greatest(F.length("text") - sample_chars, F.lit(0)) + 1) + 1
    runs = rows.withColumn("h", F.xxhash64("text")).select("lang", "h", F.substring("text", start, F.lit(sample_chars)).alias("run")).distinct()
    least = W.partitionBy("lang").orderBy("h", "run")
    picked = cut(runs.withColumn("nth", F.row_number().over(least)).where(F.col("nth") <= sample_docs))
    languages = [r["lang"] for r in picked.where("nth = 1").select("lang").limit(MAX_LANGUAGES + 1).collect()]
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    parts: dict[str, list[str]] = {lang: [] for lang in sorted(languages)}
    for r in sorted(picked.collect(), key=lambda r: (r["lang"], r["nth"])):  # at most sample_docs runs a language
        parts[r["lang"]].append(r["run"].lower())
    return LanguageModel(tuple(parts), tuple("\n".join(p).encode() for p in parts.values()))


@lru_cache(maxsize=2)
def _compressors(key: str, dictionaries: tuple[bytes, ...], level: int) -> list[zstandard.ZstdCompressor]:
    out = []
    for raw in dictionaries:
        if len(raw) < 8:
            out.append(zstandard.ZstdCompressor(level=level, write_content_size=False))
            continue
        d = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(level=level)
        out.append(zstandard.ZstdCompressor(level=level, dict_data=d, write_content_size=False, write_dict_id=False))
    return out


def classify(text: str | None, model: LanguageModel) -> tuple[str, float, float]:
    """(language, score, margin) of one whole text."""
    if not text or not model.languages or not any(map(str.isalpha, text)):
        return UNKNOWN, 0.0, 0.0
    return _classify(text, model, _compressors(model.key, model.dictionaries, model.level))


def _classify(text: str, model: LanguageModel, coders: list[zstandard.ZstdCompressor]) -> tuple[str, float, float]:
    data = text.lower().encode(errors="replace")
    sizes = [0] * len(coders)
    for at in range(0, len(data), model.chunk_bytes):
        chunk = data[at : at + model.chunk_bytes]
        for i, c in enumerate(coders):
            sizes[i] += len(c.compress(chunk))
    best = min(range(len(sizes)), key=sizes.__getitem__)
    if len(sizes) == 1:
        return model.languages[0], 1.0, 1.0
    second = min(s for i, s in enumerate(sizes) if i != best)
    margin = (second - sizes[best]) / second
    return model.languages[best], min(1.0, 0.5 + margin / 2), margin


def identify(docs: DataFrame, model: LanguageModel, keep: Sequence[str] = ("doc_id",), min_margin: float = MIN_MARGIN) -> DataFrame:
    """The columns ``keep`` of docs and lang_pred, score (0 to 1, 0.5 where two
    languages draw level), margin and accepted. One pass, nothing is shuffled."""
    clash = set(keep) & {"lang_pred", "score", "margin", "accepted"}
    if clash:
        raise ValueError(f"columns to keep that this operator sets itself: {sorted(clash)}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for rows in slices(b):
                got = [classify(t, model) for t in rows.column("_text").to_pylist()]
                accepted = [lang != UNKNOWN and margin >= min_margin for lang, _, margin in got]
                own = [pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64()), pa.array([g[2] for g in got], pa.float64()), pa.array(accepted, pa.bool_())]
                yield pa.RecordBatch.from_arrays([*(rows.column(k) for k in keep), *own], [*keep, "lang_pred", "score", "margin", "accepted"])

    schema = ", ".join([f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keep] + ["lang_pred string, score double, margin double, accepted boolean"])
    return docs.select(*[F.col(f"`{k}`") for k in keep], F.col("text").alias("_text")).mapInArrow(run, schema)
