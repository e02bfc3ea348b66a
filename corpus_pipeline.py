"""Corpus pipeline: quality rules, language identification, SimHash near-dedup
and packing, each a stage over all that its predecessor kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; the result is
written as Parquet and read again as the next stage's docs. All but the last
return the columns of docs. Null texts have no words and go at the first stage;
repeated rows are judged one by one until near-dedup keeps one of them; an
empty table stays empty; extra columns are carried along.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import langid, packing, quality, simhash
from starloom.llm.common import shared_path, table
from starloom.llm.queries import tokenizer_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _named(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """docs with its other columns renamed, so that no name can clash."""
    names = [c if c in ("doc_id", "text") else f"_c{i}" for i, c in enumerate(docs.columns)]
    return docs.toDF(*names), names


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that every quality rule keeps. The stop-word rule knows the
    function words of some languages only: a document that is labelled with
    another one, or not at all, does not go for lack of them."""
    own, names = _named(docs)
    judged = quality.quality_rules(own, keep=names)
    kept = F.col("kept")
    if "lang" in docs.columns:
        unlisted = ~F.coalesce(F.col(names[docs.columns.index("lang")]).isin(*quality.STOP_WORD_LANGUAGES), F.lit(False))
        kept = kept | (unlisted & (F.col("failed") == F.array(F.lit("stop_words"))))
    return judged.where(kept).select(*names).toDF(*docs.columns)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with an identified language. Dictionaries are learned from
    the documents that are not held out; if none of them is labelled while any
    document has a letter, that is an error: every document would be lost."""
    model = langid.learn(docs.where(~langid.held_out("doc_id")))
    if not model.languages and not docs.where(F.col("text").rlike(r"\p{L}")).isEmpty():
        raise ValueError("no language to learn: no document that is not held out has text, id and lang")
    own, names = _named(docs)
    return langid.identify(own, model, keep=names).where("accepted").select(*names).toDF(*docs.columns)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return simhash.keep_one(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences, with their ids."""
    return packing.pack_documents(docs, tokenizer_path())


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_stage),
    ("language_id", language_stage),
    ("simhash_near_dedup", dedup_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; what each keeps is written to the
    shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


# Compression sizes, SimHash components and packing have no SQL form; the
# stages are tested against brute-force versions.
ORACLE_SQL: str | None = None
