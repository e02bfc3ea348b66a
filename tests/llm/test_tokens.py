"""BPE, packing and training order against the library and brute force."""

import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from starloom.llm import bpe, packing, training_order
from starloom.llm.common import shared_path
from starloom.llm.queries import QUERIES, tokenizer_path

SF = "/root/testdata/sf0.001"
LIB = Tokenizer.from_file(tokenizer_path())
TEXTS = [
    None, "", " \t\n", "It's THE end.", "It's THE end.", "\x1ca\x1db a\x85b\xa0c", "İ ΣΑΣ ÅÉé", "<|endoftext|>x <|ENDOFTEXT|>",
    "日本語 ١٢ ½²µ", "a" * 30_000, "word " * 20_000, "'s's't''ll 'LLx", "Ａ ﬁ ſ ẞ 🙂a",
]
ROWS = [(i, t, "clash") for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], "clash"), (None, "no id", None)]
SCHEMA = "doc_id long, text string, ids string"


def lib_ids(text):
    return LIB.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="aA'sStd1½ \t\n.!<|>endoftextß\u0301\xa0ΣÅ🙂ſ中\x1c\x85", max_size=40))
def test_encoding_equals_the_library(text):
    assert bpe.encoder(tokenizer_path()).encode(text).tolist() == lib_ids(text)


def test_no_token_spans_a_cut():
    coder = bpe.encoder(tokenizer_path())
    words = ["xqz", "the", "zzxqj"]
    data = np.frombuffer("".join(words).encode(), np.uint8)
    last = np.zeros(len(data), bool)
    last[np.cumsum([len(w) for w in words]) - 1] = True
    cut = coder.cuts(data, last)
    assert cut[last].all()
    beside = set()  # neighbours in a token, and whether the second one ends a word
    for t in LIB.get_vocab():
        body = t.removesuffix("</w>")
        beside |= {(body[i : i + 2], body != t and i + 2 == len(body)) for i in range(len(body) - 1)}
    for i in range(len(data) - 1):
        if not last[i]:
            assert cut[i] == ((chr(data[i]) + chr(data[i + 1]), bool(last[i + 1])) not in beside)
    assert (cut & ~last).any()


def test_bpe_rows(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    got = sorted(map(tuple, bpe.digests(docs, tokenizer_path()).collect()), key=repr)
    want = []
    for id_, text, _ in ROWS:
        ids = lib_ids(text)
        want.append((id_, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(LIB.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert got == sorted(want, key=repr)
    back = bpe.decode_documents(bpe.encode_documents(docs.where("doc_id = 3"), tokenizer_path()), tokenizer_path())
    assert [r.text for r in back.collect()] == [LIB.decode(lib_ids(TEXTS[3]))] * 2
    assert bpe.digests(docs.limit(0), tokenizer_path()).count() == 0


def check_pieces(rows, docs, capacity=2048):
    """Every id in one piece, sequences gapless, little padding."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault((r.doc_id, r.doc_tokens), []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for (id_, n), pieces in by_doc.items():
        ids = np.array([*lib_ids(docs[id_]), 1], "<u4")
        assert n == len(ids)
        covered = np.zeros(n, int)
        for p in pieces:
            assert p.ids_crc32 == zlib.crc32(ids[p.start : p.start + p.length].tobytes())
            covered[p.start : p.start + p.length] += 1
        assert (covered == covered[0]).all() and covered[0] >= 1  # repeated rows are each packed whole
    padding = total = 0
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at <= capacity
        total += at
        padding += 0 if at & (at - 1) == 0 else capacity - at
    return padding, total


def test_packing_rows(spark):
    docs = spark.createDataFrame([r for r in ROWS if r[0] is not None], SCHEMA).repartition(3)
    rows = packing.pack_documents(docs, tokenizer_path(), checksums=True).collect()
    padding, total = check_pieces(rows, dict(enumerate(TEXTS)))
    assert padding <= 0.02 * total
    assert sum(r.length for r in rows) == sum(len(lib_ids(t)) + 1 for i, t, _ in ROWS if i is not None)
    assert packing.pack_documents(docs.limit(0), tokenizer_path()).count() == 0


def test_packing_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op3_packing"](spark, SF).collect()
    assert {r.doc_id for r in rows} == set(docs)
    padding, total = check_pieces(rows, docs)
    assert padding <= 0.02 * total


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 5000), max_size=60), st.sampled_from([64, 2048]))
def test_harmonic_classes(lengths, capacity):
    packer = packing.HarmonicPacker(capacity)
    closed = []
    for i, n in enumerate(lengths):
        closed += packer.add(i, np.arange(n, dtype=np.uint32))
    for k, pieces in packer.open.items():
        assert len(pieces) < k and all(capacity // (k + 1) < len(p.ids) <= capacity // k for p in pieces)
    per_bin = {}
    for p in closed:
        per_bin.setdefault(p.sequence, []).append(capacity // len(p.ids))
    assert all(set(ks) == {len(ks)} for ks in per_bin.values())  # a full bin of class k has k pieces
    closed += packer.finish()
    for i, n in enumerate(lengths):
        assert sorted(x for p in closed if p.doc == i for x in p.ids.tolist()) == list(range(n))


@pytest.mark.parametrize("n", [1, 2, 3, 7, 100, 1000, 4097])
def test_permutation(n):
    order = training_order.Permutation(n, "k")
    slots = order.slot(np.arange(n))
    assert sorted(slots.tolist()) == list(range(n))
    assert order.index(slots).tolist() == list(range(n))
    if n >= 100:
        assert slots.tolist() != training_order.Permutation(n, "other").slot(np.arange(n)).tolist()
        assert abs(np.corrcoef(np.arange(n), slots)[0, 1]) < 0.4


def test_training_order_round_trip(spark):
    rows = [(np.arange(1, n % 17 + 1, dtype="<u2").tobytes(),) for n in range(103)] + [(None,), (b"",), (b"\n\x00" * 16,)]
    sequences = spark.createDataFrame(rows, "tokens binary").repartition(4)
    path = shared_path(spark, "test-order")
    layout = training_order.write_shards(sequences, path, "k", 16, shard_rows=10)
    assert layout.n == len(rows) and training_order.read_layout(spark, path) == layout
    got = training_order.read_slots(spark, path).collect()
    assert [r.slot for r in sorted(got)] == list(range(len(rows)))
    assert sorted(bytes(r.tokens) for r in got) == sorted(r[0] or b"" for r in rows)
    assert all(r.shard == r.slot // 10 and r.offset == r.slot % 10 * layout.record for r in got)
    some = training_order.read_slots(spark, path, 37, 52).collect()
    assert sorted(map(tuple, some)) == sorted(tuple(r) for r in got if 37 <= r.slot < 52)
    index = {r.sequence_index for r in training_order.described(training_order.read_slots(spark, path), layout).collect()}
    assert index == set(range(len(rows)))
    with pytest.raises(Exception, match="longer than the stride"):
        training_order.write_shards(sequences, shared_path(spark, "t"), "k", 4)


def test_training_order_of_nothing(spark):
    path = shared_path(spark, "test-order")
    training_order.write_shards(spark.createDataFrame([], "tokens binary"), path, "k", 16)
    assert training_order.read_slots(spark, path).count() == 0


def test_training_order_query(spark):
    rows = QUERIES["op1_training_order"](spark, SF).collect()
    packed = QUERIES["op3_packing"](spark, SF)
    assert len(rows) == packed.agg(F.count_distinct("sequence_id")).first()[0]
    assert sum(r.n_tokens for r in rows) == packed.agg(F.sum("length")).first()[0]
    assert sorted(r.slot for r in rows) == sorted(r.sequence_index for r in rows) == list(range(len(rows)))


def plain_slot(index, n, key, rounds=8):
    """The permutation once more, in plain integers."""
    half = max(1, ((n - 1).bit_length() + 1) // 2)
    mask, word = (1 << half) - 1, (1 << 64) - 1
    x = index
    while True:
        left, right = x >> half, x & mask
        for r in range(rounds):
            m = right + int.from_bytes(hashlib.sha256(f"{key}/{r}".encode()).digest()[:8], "little") & word
            m = (m ^ m >> 30) * 0xBF58476D1CE4E5B9 & word
            m = (m ^ m >> 27) * 0x94D049BB133111EB & word
            left, right = right, left ^ (m ^ m >> 31) & mask
        x = left << half | right
        if x < n:
            return x


@pytest.mark.parametrize("n", [1, 5, 64, 1000])
def test_permutation_equals_plain_integers(n):
    slots = training_order.Permutation(n, "epoch-3").slot(np.arange(n))
    assert slots.tolist() == [plain_slot(i, n, "epoch-3") for i in range(n)]


def test_every_sequence_is_in_its_slot(spark):
    """The ids in slot(i) are those of sequence i, the i-th row of the input as stored."""
    rows = [(np.array([i + 1, i + 7], "<u2").tobytes(),) for i in range(211)]
    sequences = spark.createDataFrame(rows, "tokens binary").coalesce(1)
    path = shared_path(spark, "test-order")
    training_order.write_shards(sequences, path, "k9", 16, shard_rows=10)
    got = {r.slot: np.frombuffer(bytes(r.tokens), "<u2").tolist() for r in training_order.read_slots(spark, path).collect()}
    assert [got[plain_slot(i, 211, "k9")] for i in range(211)] == [[i + 1, i + 7] for i in range(211)]


def test_slots_are_described_by_the_worker_that_reads_them(spark, tmp_path):
    rows = spark.createDataFrame([(np.arange(i % 9, dtype="<u2").tobytes(),) for i in range(40)], "tokens binary")
    layout = training_order.write_shards(rows, str(tmp_path / "order"), "k", 8, shard_rows=16)
    once = training_order.read_slots(spark, str(tmp_path / "order"), 3, 39, describe=True)
    assert once._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    twice = training_order.described(training_order.read_slots(spark, str(tmp_path / "order"), 3, 39), layout)
    assert sorted(once.collect()) == sorted(twice.collect()) and once.count() == 36
