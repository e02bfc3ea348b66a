"""The pipeline without any document to learn a language from."""

import random

import pytest

import corpus_pipeline
from starloom.llm import quality

SF = "/root/testdata/sf0.001"


def test_language_stage_without_labels_is_an_error(spark):
    docs = spark.createDataFrame([(i, "the cat and the dog", None) for i in range(9)], "doc_id long, text string, lang string")
    with pytest.raises(ValueError, match="no language to learn"):
        corpus_pipeline.language_stage(spark, docs, SF)
    wordless = spark.createDataFrame([(1, "123", None), (2, None, None)], "doc_id long, text string, lang string")
    for rows in (docs.limit(0), wordless):
        assert corpus_pipeline.language_stage(spark, rows, SF).count() == 0


def test_a_fifth_language_reaches_language_identification(spark):
    """Italian has no stop-word list here: its documents pass the quality rules
    and are learned and kept; gibberish labelled English is not."""
    rng = random.Random(4)
    words = "nella casa della nonna abbiamo trovato libri antichi sotto tavolo rosso vicino finestra aperta quando arriva estate andiamo insieme verso mare perché ogni giorno porta qualche sorpresa".split()
    plain = "the cat of house is garden and it was on tree for long time with some red door to walk by at night as this".split()

    def text(vocabulary):
        return " ".join(rng.choices(vocabulary, k=90))

    rows = [(i, text(words), "it") for i in range(40)] + [(100 + i, text(plain), "en") for i in range(40)]
    rows += [(200, " ".join(f"qx{i}z" for i in range(90)), "en"), (201, text(words), None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    judged = {r.doc_id: r for r in quality.quality_rules(docs).collect()}
    assert judged[0].n_words > 51 and "stop_words" in judged[0].failed
    kept = corpus_pipeline.quality_stage(spark, docs.where("doc_id <> 200"), "")
    flat = {r.doc_id for r in corpus_pipeline.quality_stage(spark, docs, "").collect()}
    assert 200 not in flat
    wanted = {r.doc_id for r in docs.collect() if set(judged[r.doc_id].failed) <= {"stop_words"}} - {200}
    assert flat == wanted and {0, 39, 201} <= wanted
    languages = {r.doc_id for r in corpus_pipeline.language_stage(spark, kept, "").collect()}
    assert len([i for i in range(40) if i in languages]) >= 38
    assert kept.columns == docs.columns
