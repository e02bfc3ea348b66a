"""Quality rules, language, near duplicates and the pipeline."""

import re

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from starloom.llm import components as components_module
from starloom.llm import langid, quality, simhash
from starloom.llm.components import components
from starloom.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0d]+")
LONG = " ".join(f"w{i % 5000}" for i in range(60_000))
TEXTS = [
    None, "", " \n\t", "a b c d e a b c d e", "x " * 30, "the cat\n\nthe cat\n \nthe dog", "$$$ ### the", "é\x85ü\xa0ß the of and to in is it for on as",
    "The of and to a in is it that for was\nthe end", LONG, "one two three four five six " * 3,
]


def brute_counts(text):
    text = text or ""
    words = WORD.findall(text)
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    number = {}
    for g in grams:
        number[g] = number.get(g, 0) + 1
    covered = {i + k for i, g in enumerate(grams) if number[g] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def test_quality_counts(spark):
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(TEXTS)] + [(4, TEXTS[4], 1), (None, None, 1)], "doc_id long, text string, n_words int")
    rows = quality.quality_rules(docs).collect()
    assert len(rows) == len(TEXTS) + 2
    for r in rows:
        want = brute_counts(None if r.doc_id is None else TEXTS[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, r.doc_id
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert r.kept == (not r.failed) and (not r.base_failed or not r.kept)
    assert {r.doc_id for r in rows if r.kept} == {7, 8}
    assert quality.quality_rules(docs.limit(0)).count() == 0
    with pytest.raises(ValueError, match="n_words"):
        quality.quality_rules(docs, keep=["n_words"])


def test_quality_plan_has_no_python_and_no_shuffle(spark):
    plan = QUERIES["op9_quality"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
    kept = QUERIES["op9_quality"](spark, SF).where("kept")._jdf.queryExecution().executedPlan().toString()
    assert kept.count("split(") <= 3  # a filter on the verdict does not split the text anew


def test_quality_oracle(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    want = con.execute(ORACLES["op9_quality"]).df().sort_values("doc_id").reset_index(drop=True)
    got = QUERIES["op9_quality"](spark, SF).toPandas().sort_values("doc_id").reset_index(drop=True)[list(want.columns)]
    assert got.equals(want)


def test_quality_keeps_clean_documents(spark):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").where("quality = 1")
    rows = QUERIES["op9_quality"](spark, "/root/testdata/sf0.01").join(labels, "doc_id").where("not base_failed")
    assert rows.count() > 100 and rows.where("not kept").count() <= 0.005 * rows.count()


def test_language_accuracy_and_held_out(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = QUERIES["op8_language"](spark, sf).join(docs.select("doc_id", "lang"), "doc_id")
    held = rows.where("held_out")
    assert held.where("lang_pred = lang").count() >= 0.95 * held.count() > 0
    assert rows.where("score < 0 or score > 1 or score is null").count() == 0
    assert rows.where("held_out <> (crc32(cast(cast(doc_id as string) as binary)) % 3 = 1)").count() == 0


def test_language_learns_from_the_rest_only(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    changed = docs.withColumn("lang", F.when(langid.held_out("doc_id"), "xx").otherwise(F.col("lang")))
    assert langid.learn(changed.where(~langid.held_out("doc_id"))) == langid.learn(docs.where(~langid.held_out("doc_id")))


def test_language_edges(spark):
    learn = [(i, t, lang) for i, (t, lang) in enumerate([("the cat and the dog " * 20, "en"), ("le chat et le chien " * 20, "fr"), (None, "de"), ("no label", None), ("", "en")])]
    model = langid.learn(spark.createDataFrame(learn, "doc_id long, text string, lang string"))
    assert model.languages == ("en", "fr")
    rows = [(1, None), (2, ""), (3, "123 !?"), (4, "the dog and the cat"), (4, "the dog and the cat"), (5, "le chien et le chat " * 20_000), (None, "the cat and the dog")]
    docs = spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id long, text string, score double")
    got = [(r.doc_id, r.lang_pred, r.accepted) for r in langid.identify(docs, model).collect()]
    assert sorted(got, key=repr) == sorted([(1, "und", False), (2, "und", False), (3, "und", False), (4, "en", True), (4, "en", True), (5, "fr", True), (None, "en", True)], key=repr)
    with pytest.raises(ValueError, match="score"):
        langid.identify(docs, model, keep=["score"])
    nothing = langid.learn(docs.limit(0).withColumn("lang", F.lit("en")))
    assert {r.lang_pred for r in langid.identify(docs, nothing).collect()} == {"und"}
    assert langid.identify(docs.limit(0), model).count() == 0


def test_language_repeated_rows(spark):
    """A row that a language repeats 100,000 times is one text of its sample."""
    french = spark.range(100_000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("le chat et le chien dans la maison " * 8).alias("text"), F.lit("fr").alias("lang"))
    english = spark.range(4000).select((F.col("id") + 100).alias("doc_id"), F.concat(F.lit("the cat and the dog of house "), F.col("id").cast("string"), F.lit(" was in the garden with it")).alias("text"), F.lit("en").alias("lang"))
    rare = spark.createDataFrame([(1, "der Hund und die Katze", "de"), (2, "", "xx"), (3, "12 34", "yy")], "doc_id long, text string, lang string")
    model = langid.learn(french.unionByName(english).unionByName(rare))
    assert model.languages == ("de", "en", "fr")
    assert len(model.dictionaries[2]) == langid.SAMPLE_CHARS and len(model.dictionaries[1].split(b"\n")) == langid.SAMPLE_DOCS
    assert langid.classify("le chien et le chat dans la maison", model)[0] == "fr"
    assert langid.classify("the dog of the house was in it", model)[0] == "en"


def test_language_count_is_bounded(spark):
    many = spark.range(300).select(F.col("id").alias("doc_id"), F.lit("a text").alias("text"), F.concat(F.lit("l"), "id").alias("lang"))
    with pytest.raises(ValueError, match="languages"):
        langid.learn(many)


def brute_fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = WORD.findall(text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_groups(fps):
    """Smallest id reachable over links of up to two differing bits."""
    ids, bits = list(fps), np.array(list(fps.values()), np.uint64)
    group = {i: i for i in ids}

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(ids)):
        for j in np.flatnonzero(np.bitwise_count(bits[i] ^ bits[:i]) <= 2):
            a, b = sorted((root(ids[i]), root(ids[j])))
            group[b] = a
    return {i: root(i) for i in ids}


@pytest.mark.parametrize("text", [*TEXTS[:9], "a", "A b", "A  B\tc", "É é"])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == brute_fingerprint(text)


def test_covering_finds_every_link(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 300, dtype=np.int64)
    near = [int(x) ^ sum(1 << int(b) for b in rng.choice(63, rng.integers(0, 4), replace=False)) for x in np.repeat(base, 4)]
    fps = np.unique(np.array([*base.tolist(), *near, 0, 1, 3, 7, -1, -2], np.int64))
    got = {(r.a, r.b) for r in simhash.links(spark.createDataFrame([(int(x),) for x in fps], "fp long")).collect()}
    u = fps.view(np.uint64)
    close = np.argwhere(np.bitwise_count(u[:, None] ^ u[None]) <= 2)
    assert got == {(int(fps[i]), int(fps[j])) for i, j in close if fps[i] < fps[j]}


def test_components_of_chains_stars_and_rings(spark):
    chain = [(i, i + 1) for i in range(100)]
    star = [(1000, 1001 + i) for i in range(60)] + [(1500, 1030)]
    links = spark.createDataFrame([*chain, *star, (chain[-1][1], 2000), (3000, 2999), (3000, 3000)], "a long, b long")
    got = {r.node: r.root for r in components(links).collect()}
    want = {**{i: 0 for i in range(1, 101)}, 2000: 0, **{1001 + i: 1000 for i in range(60)}, 1500: 1000, 3000: 2999}
    assert got == want
    assert components(links.limit(0)).count() == 0


def test_roots_of_a_long_chain_keep_a_size_estimate(spark):
    """Checkpointed joins had the product of their sides as size, squared by each jump."""
    links = spark.range(60).select(F.xxhash64("id").alias("a"), F.xxhash64(F.col("id") + 1).alias("b"))
    nodes = {x for r in links.collect() for x in (r.a, r.b)}
    roots = components(links)
    assert {(r.node, r.root) for r in roots.collect()} == {(x, min(nodes)) for x in nodes - {min(nodes)}}
    assert roots._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() < 1 << 30


def test_near_duplicates_broadcast_nothing_by_an_estimate(spark, monkeypatch):
    """Visits are about 61 times the fingerprints, whatever Spark takes them for."""
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.sha1(F.col("id").cast("string")), F.lit("of the"), F.sha1((F.col("id") % 200).cast("string"))).alias("text"))
    plans = []

    def noted(made):
        def run(df, *args):
            plans.append(df._jdf.queryExecution().executedPlan().toString())
            return made(df, *args)

        return run

    for module in (simhash, components_module):
        for name in {"cut", "stored"} & {*dir(module)}:
            monkeypatch.setattr(module, name, noted(getattr(module, name)))
    for df in (simhash.near_duplicates(docs), simhash.keep_one(docs)):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
    assert sum("MapInArrow" in p and "SortMergeJoin" in p for p in plans) == 2
    assert not [p for p in plans if "Broadcast" in p]


def test_near_duplicates_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    fps = {i: brute_fingerprint(t) for i, t in sorted(docs.items())}
    groups = brute_groups(fps)
    got = QUERIES["op5_near_duplicates"](spark, SF).collect()
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in got} == {(i, f"{fps[i]:016x}", groups[i]) for i in docs}
    assert len(got) == len(docs)


def test_near_duplicates_edges(spark):
    rows = [(5, "", 1), (3, None, 2), (3, "a b c d", 3), (9, "A b  c d", 4), (9, "A b  c d", 4), (None, "a b c d", 5), (None, "alone here now", 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp long")
    got = sorted(((r.doc_id, r.component_id) for r in simhash.near_duplicates(docs).collect()), key=repr)
    assert got == sorted([(5, 3), (3, 3), (3, 3), (9, 3), (9, 3), (None, 3), (None, None)], key=repr)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.fp for r in kept.collect()) == [2, 3, 6]
    assert simhash.near_duplicates(docs.limit(0)).count() == 0 and simhash.keep_one(docs.limit(0)).count() == 0


def test_pipeline_against_brute_force(spark):
    """Each stage over all that its predecessor kept, decided row by row."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = kept
        kept = spark.createDataFrame(stage(spark, before, SF).collect(), docs.schema)
        assert kept.columns == docs.columns
        rows = {r.doc_id: r for r in before.collect()}
        assert all(rows[r.doc_id] == r for r in kept.collect())
        ids = {r.doc_id for r in kept.collect()}
        if name == "quality_rules":
            verdict = {r.doc_id: r.kept for r in QUERIES["op9_quality"](spark, SF).collect()}
            assert ids == {i for i in rows if verdict[i]}
        elif name == "language_id":
            model = langid.learn(before.where(~langid.held_out("doc_id")))
            judged = {i: langid.classify(r.text, model) for i, r in rows.items()}
            assert ids == {i for i, (lang, _, margin) in judged.items() if lang != "und" and margin >= langid.MIN_MARGIN}
        else:
            groups = brute_groups({i: brute_fingerprint(rows[i].text) for i in sorted(rows)})
            assert ids == set(groups.values())
    pieces = corpus_pipeline.STAGES[-1][1](spark, kept, SF)
    assert {r.doc_id for r in pieces.select("doc_id").collect()} == {r.doc_id for r in kept.collect()}
    assert corpus_pipeline.run(spark, SF).select("doc_id").distinct().count() == kept.count()


def test_pipeline_edges(spark):
    text = "The of and to a in is it that for was on are as with be"
    rows = [(1, text, "en", "x"), (1, text, "en", "x"), (2, None, "en", None), (3, "", None, "y"), (None, f"{text} one two three", "en", "z"), (4, "la les de du des et un une en que qui est dans", "fr", "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, kept string")
    for data in (docs, docs.limit(0)):
        out = data
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, out, SF)
            assert out.columns == docs.columns
        corpus_pipeline.STAGES[-1][1](spark, out, SF).collect()
    assert corpus_pipeline.STAGES[0][1](spark, docs, SF).count() == 4
