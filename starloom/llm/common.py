"""Shared pieces of the operators: the shared scratch folder, lineage cuts,
word patterns and argument checks."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.session import checkpoint_dir

# ASCII white space as the word contracts define it.
WORD_GAP = r"[\x20\x09-\x0D]+"
NON_GAP = r"[^\x20\x09-\x0D]"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the cluster's shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into the shared checkpoint folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str, level: int = 3) -> DataFrame:
    """Like :func:`cut`, as a table compressed with zstandard at ``level``:
    smaller on disk and pruned by column when read several times."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.option("parquet.compression.codec.zstd.level", level).parquet(path, compression="zstd")
    return spark.read.schema(df.schema).parquet(path)


def only(df: DataFrame, *names: str) -> DataFrame:
    """The named columns alone, so that any extra columns cannot clash."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df.select(*[F.col(f"`{n}`") for n in names])


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)
