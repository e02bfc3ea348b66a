"""Incremental load of an event table as a stream.

New files of a folder are read as a stream. Events that come again within the
watermark are dropped by their id (keyed state, bounded by the watermark);
older ones are late and dropped as well, so a replayed file changes nothing.
Each micro-batch adds one set of partial aggregates to the warehouse:

* its folder is named by the batch id and overwritten, so a batch that runs
  again after a failure replaces what it left;
* it becomes visible by a commit marker that is added once the folder is
  whole; readers take committed batches only.

A rollup of the committed partials (:func:`totals`) then equals an aggregate
over all events, each counted once. Partials are mergeable, so their number can
be reduced at any time (:func:`compacted`).

Rows without an id or a time take no part: neither duplicates nor late rows
could be told.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.operators import lattice


def deduplicated(events: DataFrame, id_column: str, time: str, delay: str) -> DataFrame:
    """The stream without events that came before, by id, within ``delay``. A
    time without zone is taken in the session's, as watermarks need one."""
    if isinstance(events.schema[time].dataType, T.TimestampNTZType):
        events = events.withColumn(time, F.col(time).cast("timestamp"))
    known = events.where(F.col(id_column).isNotNull() & F.col(time).isNotNull())
    return known.withWatermark(time, delay).dropDuplicatesWithinWatermark([id_column])


def _batches(root: str) -> str:
    return f"{root}/batches"


def commit_batch(batch: DataFrame, batch_id: int, root: str, keys: dict[str, Column], measures: Sequence[lattice.Measure]) -> None:
    """Writes the partials of one batch and commits it; doing so again leaves
    the same warehouse."""
    spark = batch.sparkSession
    named = batch.select(*batch.columns, *[c.alias(f"_{name}") for name, c in keys.items()])
    parts = lattice.partials(named, [f"_{name}" for name in keys], measures)
    parts.withColumnsRenamed({f"_{name}": name for name in keys}).write.mode("overwrite").parquet(f"{_batches(root)}/batch_id={batch_id}")
    spark.range(1).select(F.lit(batch_id).cast("long").alias("batch_id")).coalesce(1).write.mode("overwrite").json(f"{root}/commits/{batch_id}")


def committed(spark: SparkSession, root: str) -> list[int]:
    """Ids of the committed batches: one number a batch."""
    try:
        rows = spark.read.schema("batch_id long").option("recursiveFileLookup", True).json(f"{root}/commits")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return []
    return sorted(r["batch_id"] for r in rows.distinct().collect())


def load_available(spark: SparkSession, source: str, schema: T.StructType, root: str, id_column: str, time: str,
                   keys: dict[str, Column], measures: Sequence[lattice.Measure], delay: str = "2 days",
                   files_per_batch: int = 100, timeout: int | None = None) -> int:
    """Loads what has arrived in ``source`` since the last call and returns the
    number of committed batches. The stream's own checkpoint is below ``root``."""
    events = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    # state is kept by id; the aggregate of a batch needs no state of its own
    query = (deduplicated(events, id_column, time, delay).writeStream
             .foreachBatch(lambda batch, batch_id: commit_batch(batch, batch_id, root, keys, measures))
             .option("checkpointLocation", f"{root}/stream").trigger(availableNow=True).start())
    query.awaitTermination(timeout)
    if query.isActive:
        query.stop()
        raise TimeoutError("the stream did not end in time; committed batches stay")
    return len(committed(spark, root))


def partials(spark: SparkSession, root: str) -> DataFrame | None:
    """The partials of all committed batches."""
    ids = committed(spark, root)
    if not ids:
        return None
    return spark.read.option("basePath", _batches(root)).parquet(*[f"{_batches(root)}/batch_id={i}" for i in ids]).drop("batch_id")


def totals(spark: SparkSession, root: str, keys: Sequence[str], measures: Sequence[lattice.Measure]) -> DataFrame:
    """Aggregates over all events loaded so far, by any of the keys."""
    parts = partials(spark, root)
    if parts is None:
        raise ValueError(f"no batch is committed below {root}")
    return lattice.rolled_up(parts, list(keys), measures)


def compacted(spark: SparkSession, root: str, keys: Sequence[str], measures: Sequence[lattice.Measure]) -> DataFrame:
    """The committed partials merged to one row a key, to be stored elsewhere."""
    parts = partials(spark, root)
    if parts is None:
        raise ValueError(f"no batch is committed below {root}")
    return lattice.merged(parts, list(keys), measures)
