"""Phrase collocations against brute force."""

import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from starloom.llm import phrases
from starloom.llm.queries import ORACLES, QUERIES


def brute(rows, min_count, share=100, top=2000, max_words=5):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, max_words + 1):
                for i in range(len(words) - size + 1):
                    f[lang, tuple(words[i : i + size])] += 1
    candidates = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= min_count}
    out = {}
    for (lang, p), a in candidates.items():
        cuts = [(1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        inside = any(len(q) > len(p) and lq == lang and 100 * b >= share * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)) for (lq, q), b in candidates.items())
        if not inside:
            out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), " ".join(p), a, f[lang, p[:k]], f[lang, p[k:]], n[lang], score))
    return sorted((lang, rank, *r[3:]) for lang, found in out.items() for rank, r in enumerate(sorted(found)[:top], 1))


def mined(spark, rows, **options):
    df = spark.createDataFrame([(t, lang, 1, i) for i, (t, lang) in enumerate(rows)], "text string, lang string, f int, size long").repartition(4)
    return sorted(map(tuple, phrases.collocations(df, **options).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()))


def corpus(seed, n=300):
    rng = random.Random(seed)
    words = ["the", "The", "of", "é", "ß\x85x", "a\x0bb", "x", "yy", "zzz", "new", "york", "city"]
    rows = []
    for _ in range(n):
        parts = [rng.choice(words) if rng.random() < 0.8 else "new york city hall" for _ in range(rng.randrange(0, 25))]
        rows.append(("".join(p + rng.choice([" ", "  ", "\t", ", ", ".", "\n", " "]) for p in parts), rng.choice(["en", "fr", None, "und"])))
    return rows + [(None, "en"), ("", None), (" ,.; ", "fr"), ("new york " * 200, "de"), ("new york " * 200, "de")]


@pytest.mark.parametrize("counters", [250_000, 40])
def test_collocations_equal_brute_force(spark, counters):
    rows = corpus(1)
    assert mined(spark, rows, min_count=8, counters=counters) == brute(rows, 8)
    assert mined(spark, rows, min_count=5, share=80, top=7, counters=counters) == brute(rows, 5, 80, 7)


def test_no_text(spark):
    assert mined(spark, []) == [] and mined(spark, [(None, "en"), ("..", None)]) == [] and mined(spark, [("a b", "en")]) == []
    with pytest.raises(ValueError):
        mined(spark, [("a b", "en")], min_count=0)


def test_long_texts_are_cut_between_pieces(monkeypatch, spark):
    import pyarrow as pa

    rows = corpus(5, 120)
    batch = pa.RecordBatch.from_arrays([pa.array([t for t, _ in rows], pa.string()), pa.array([x for _, x in rows], pa.string())], ["text", "lang"])

    def counted(block_bytes):
        out = Counter()
        for w in phrases.blocks(iter([batch, batch.slice(3, 0)]), block_bytes):
            words = w.words.to_pylist()
            for size in range(1, 4):
                for i in w.within(size).tolist():
                    out[w.langs[int(w.lang[i])].as_py(), tuple(words[int(w.word[i + k])] for k in range(size))] += 1
        return out

    assert counted(64) == counted(8 << 20) and sum(counted(64).values()) > 1000


@pytest.mark.parametrize("seed", range(5))
def test_misra_gries_keeps_what_is_frequent(seed):
    """With more counters than mass / threshold nothing frequent is lost, however the stream is cut and merged."""
    rng = np.random.default_rng(seed)
    stream = rng.zipf(1.3, 20_000).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    threshold = 100
    summary = phrases.MisraGries(len(stream) // threshold + 1)
    for part in np.split(stream, np.sort(rng.integers(0, len(stream), 30))):
        summary.add(*(x.astype(t) for x, t in zip(np.unique(part, return_counts=True), (np.uint64, np.int64))))
    summary.reduce()
    exact = dict(zip(*(x.tolist() for x in np.unique(stream, return_counts=True))))
    kept = dict(zip(summary.keys.tolist(), summary.counts.tolist()))
    assert 0 < summary.error < threshold and len(kept) <= summary.capacity
    for key, n in exact.items():
        assert n - summary.error <= kept.get(key, 0) <= n
        assert n < threshold or kept[key] + summary.error >= threshold


def test_packed_hashes():
    keys = np.unique(np.random.default_rng(0).integers(0, 1 << 63, 1000).astype(np.uint64) * np.uint64(2) + np.uint64(1))
    assert phrases._unpacked(phrases._packed(keys)).tolist() == keys.tolist()


def test_phrases_oracle(spark):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf}/documents.parquet'")
    want = con.execute(ORACLES["op13_phrases"]).fetchall()
    got = QUERIES["op13_phrases"](spark, sf).select(*[d[0] for d in con.description]).collect()
    assert sorted(map(tuple, got)) == sorted(want) and len(got) > 20


def test_summaries_carry_short_hashes(spark):
    docs = spark.createDataFrame([(f"w{i} x{i % 7} y{i}", "en") for i in range(300)], "text string, lang string")
    rows = phrases._local(docs, 1, 2, None).where("kind = 1").collect()
    keys = np.concatenate([phrases._unpacked(bytes(r["keys"])) for r in rows])
    assert len(set(keys.tolist())) == 607 and not (keys & np.uint64((1 << 64 - phrases.SENT_BITS) - 1)).any()


def test_counts_travel_compressed(spark):
    docs = spark.createDataFrame([("some words come again and again, " * 400, "en")], "text string, lang string")
    maps = [spark.sparkContext.broadcast(b"\xff" * (1 << phrases.MAP_BITS - 3)) for _ in range(2)]
    counted = phrases._exact(docs, maps, 0)
    (row,) = counted.collect()
    assert row["bytes"] > len(row["data"])
    got = {(r["size"], r["phrase"]): r["f"] for r in phrases._totals(counted, 1).collect()}
    assert got[0, ""] == 2400 and got[2, "again and"] == 400 and got[1, "again"] == 800
