"""Ranked lexical search against brute force."""

import math
import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.llm import lexical
from starloom.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(items, docs, k=10):
    found = [(d, terms(t)) for d, t in docs]
    found = [(d, t) for d, t in found if t]
    n_docs, n_terms = len(found), sum(len(t) for _, t in found)
    out = []
    asked = {}
    for i, text in items:
        asked.setdefault(i, set()).update(terms(text))
    for i, want in asked.items():
        weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * sum(t in own for _, own in found) + 1))) for t in want}
        scores = []
        for d, own in found:
            m = 10 + 90 * len(own) * n_docs // n_terms
            score = sum(weight[t] * (1_000_000_000 * own.count(t) // (1000 * own.count(t) + 8 * m)) for t in want if t in own)
            if score > 0:
                scores.append((-score, d is None, d or 0))
        out += [(i, r, None if null else d, -s) for r, (s, null, d) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


def found(spark, items, docs, **options):
    i = spark.createDataFrame([(*x, 1) for x in items], "item_id long, text string, doc_id int")
    d = spark.createDataFrame([(*x, "e") for x in docs], "doc_id long, text string, n string").repartition(3)
    return sorted(map(tuple, lexical.search(i, d, **options).select("item_id", "rank", "doc_id", "score").collect()), key=repr)


@pytest.mark.parametrize("seed", [0, 1])
def test_search_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)] + ["Été", "a.b", "X9"]
    draw = lambda n: " ".join(words[min(int(rng.paretovariate(0.6)) - 1, len(words) - 1)] for _ in range(n))
    docs = [(i, draw(rng.randrange(1, 80))) for i in range(1_500)] + [(7, "w1 w2"), (7, "w1 w2"), (None, "w1 w2 w3"), (None, None), (3000, ""), (3001, "...")]
    docs += [(4000 + i, "same text w5 w250") for i in range(40)]
    items = [(i, draw(rng.randrange(1, 12))) for i in range(30)] + [(1, "w250"), (50, None), (51, "nowhere"), (52, "w250 w250 W250"), (None, "w5 w6"), (53, " ".join(words))]
    want = brute(items, docs)
    assert found(spark, items, docs) == want
    assert found(spark, items, docs, group_items=8) == want
    assert found(spark, items, docs, group_terms=40, k=3) == brute(items, docs, 3)


def test_pruning_drops_whole_batches_and_nothing_of_a_top_k():
    """Few pairs are scored once floors are known, and the results are those of all pairs."""
    rng = np.random.default_rng(2)
    n, v = 2048, 400
    topic = rng.integers(0, 20, n)
    tf = [dict(zip((20 * t + rng.choice(20, 12, replace=False)).tolist(), rng.integers(1, 9, 12).tolist())) for t in topic.tolist()]
    stats = lexical.Statistics(n, n * 40, rng.integers(100, 9_000, v))
    import pyarrow as pa

    vectors = pa.RecordBatch.from_arrays([pa.array([40] * n), pa.array([list(d) for d in tf], pa.list_(pa.int32())), pa.array([list(d.values()) for d in tf], pa.list_(pa.int64()))], ["n", "terms", "tfs"])
    ids, docs = lexical._doc_tree(list(range(n)), vectors, stats)
    items = lexical.Items(list(range(64)), [np.sort(20 * (i % 20) + rng.choice(20, 3, replace=False)) for i in range(64)], [b""] * v)
    tree = lexical.ItemTree(items, stats.weights)
    full = lexical.products(tree.tree.levels[-1], docs.levels[-1])
    best = lexical._Best(64, 10, np.zeros(64, np.int64))
    lexical._pilot(docs, ids, tree, best)
    again = lexical._Best(64, 10, best.floors)
    scored = lexical._descend(docs, ids, tree, again)
    assert scored < 0.15 * 64 * n
    for i in range(64):
        want = sorted((-int(s), False, ids[d]) for d, s in enumerate(full[i]) if s > 0)[:10]
        assert again.found[i] == want
    for level in range(3):  # every node bounds what lies below it
        bounds = lexical.products(tree.tree.levels[level], docs.levels[level])
        for node in range(docs.levels[level].n):
            rows = np.array([node])
            for below in range(level, 3):
                rows = docs.below(below, rows)
            assert (bounds[:, node].max() >= full[:, rows].max())


def test_products_stay_exact_beyond_doubles():
    big = (1 << 40) + 1
    a = lexical._Sparse(np.array([0, 0]), np.array([1, 5000]), np.array([big, 3]), 1)
    b = lexical._Sparse(np.array([0, 1, 1]), np.array([1, 1, 5000]), np.array([1 << 20, (1 << 20) + 1, 7]), 2)
    assert lexical.products(a, b).tolist() == [[big << 20, big * ((1 << 20) + 1) + 21]]


def test_long_texts_are_counted_whole(monkeypatch):
    monkeypatch.setattr(lexical, "CHUNK_BYTES", 50)
    text = "Alpha beta-é9 " * 100 + "x" * 500
    n, counts = lexical.term_counts(text)
    assert n == len(terms(text)) and counts["x".encode() * 500] == 1 and counts["é9".encode()] == 100


def test_empty_tables(spark):
    docs, items = [(1, "a b")], [(1, "a")]
    assert found(spark, [], docs) == [] and found(spark, items, []) == [] and found(spark, items, [(1, None), (2, "!")]) == []
    assert found(spark, items, docs) == brute(items, docs)


def test_search_oracle(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = con.execute(ORACLES["op12_ranked"]).fetchall()
    got = QUERIES["op12_ranked"](spark, SF).select(*[d[0] for d in con.description]).collect()
    assert sorted(map(tuple, got)) == sorted(want) and len(got) > 50
