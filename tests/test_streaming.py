"""Incremental load as a stream: replays, restarts and late events."""

import datetime
import uuid

import pytest
from pyspark.sql import functions as F

from starloom.operators import lattice
from starloom.streaming import incremental

from conftest import SF_SMALL

T0 = datetime.datetime(2024, 1, 1)
SCHEMA = "event_id long, ts timestamp, user_id long, value double"


def measures():
    return [lattice.rows("n"), lattice.total("hundredths", F.round(F.col("value") * 100).cast("long"))]


def keys():
    return {"user_id": F.col("user_id"), "day": F.to_date("ts")}


def _drop(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def _load(spark, folder, root, delay="2 days", files=1):
    schema = spark.createDataFrame([], SCHEMA).schema
    return incremental.load_available(spark, folder, schema, root, "event_id", "ts", keys(), measures(), delay, files, timeout=120)


def _totals(spark, root):
    return sorted((tuple(r) for r in incremental.totals(spark, root, ["user_id"], measures()).collect()), key=repr)


def test_replays_restarts_and_late_events(spark, tmp_path):
    folder, root = str(tmp_path / "in"), str(tmp_path / "out")
    first = [(i, T0 + datetime.timedelta(hours=i), i % 3, 1.5) for i in range(30)]
    _drop(spark, folder, first)
    _load(spark, folder, root)
    want = [(0, 10, 1500), (1, 10, 1500), (2, 10, 1500)]
    assert _totals(spark, root) == want
    _drop(spark, folder, first)  # the same file again, read by a stream that starts anew
    _load(spark, folder, root)
    assert _totals(spark, root) == want
    _drop(spark, folder, [*first[20:], (100, T0 + datetime.timedelta(days=20), 7, 0.25), (None, T0, 7, 1.0), (101, None, 7, 1.0), (102, T0 + datetime.timedelta(days=20), None, None)])
    _load(spark, folder, root)
    assert _totals(spark, root) == sorted([*want, (7, 1, 25), (None, 1, None)], key=repr)
    _drop(spark, folder, [(3, T0 + datetime.timedelta(hours=3), 0, 1.5), (200, T0, 0, 9.0)])  # older than the watermark
    _load(spark, folder, root)
    assert _totals(spark, root) == sorted([*want, (7, 1, 25), (None, 1, None)], key=repr)


def test_a_batch_that_runs_twice_counts_once(spark, tmp_path):
    root = str(tmp_path / "out")
    batch = spark.createDataFrame([(1, T0, 5, 1.0), (2, T0, 5, 2.0)], SCHEMA)
    assert incremental.committed(spark, root) == []
    with pytest.raises(ValueError, match="committed"):
        incremental.totals(spark, root, ["user_id"], measures())
    for _ in range(2):
        incremental.commit_batch(batch, 0, root, keys(), measures())
    incremental.commit_batch(batch.where("event_id = 1"), 1, root, keys(), measures())
    assert incremental.committed(spark, root) == [0, 1]
    assert _totals(spark, root) == [(5, 3, 400)]
    assert incremental.compacted(spark, root, ["user_id"], measures()).count() == 1


def test_a_batch_without_commit_is_not_seen(spark, tmp_path):
    root = str(tmp_path / "out")
    batch = spark.createDataFrame([(1, T0, 5, 1.0)], SCHEMA)
    incremental.commit_batch(batch, 0, root, keys(), measures())
    batch.select("user_id", F.to_date("ts").alias("day"), F.lit(9).cast("long").alias("_n_0"), F.lit(9).cast("long").alias("_hundredths_0")).write.parquet(f"{root}/batches/batch_id=1")
    assert _totals(spark, root) == [(5, 1, 100)]


def test_events_replayed_twice_give_the_same_warehouse(spark, tmp_path):
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "value")
    folder, root = str(tmp_path / uuid.uuid4().hex), str(tmp_path / "out")
    events.repartition(3).write.parquet(folder)
    _load(spark, folder, root, "60 days")
    once = _totals(spark, root)
    events.repartition(2).write.mode("append").parquet(folder)
    _load(spark, folder, root, "60 days")
    assert _totals(spark, root) == once
    assert sum(r[1] for r in once) == events.count()
