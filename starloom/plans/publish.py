"""Writing the warehouse: full reload into a run directory, then publish.

The original job resets its tables in place and commits per table, so a
failure can leave dimensions without facts. Here every table of a run is
written under ``<root>/runs/<run_id>/<table>`` with its declared schema;
only when all writes succeeded is a pointer file added to
``<root>/pointers``. Pointers are never overwritten or deleted; readers take
the newest one, so at every moment they see a complete warehouse.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom import schemas
from starloom.session import checkpoint_dir

OUTPUT_CONF = "starloom.output.dir"
_OWN_CONF = "starloom.output.own"  # the folder a session got without the setting
TARGET_SCHEMAS = {"product": schemas.PRODUCT, "member": schemas.MEMBER, "room": schemas.ROOM,
                  "time": schemas.TIME, "salesfact": schemas.SALESFACT}


def output_root(spark: SparkSession) -> str:
    """Shared output folder: ``starloom.output.dir``. Without it a session
    gets a folder of its own below its checkpoint folder, which executors share,
    and another one once that is moved; on a cluster without either it is an
    error, as any default may be a folder of one machine."""
    root = spark.conf.get(OUTPUT_CONF, None)
    if root:
        return root.rstrip("/")
    own = f"{checkpoint_dir(spark).rstrip('/')}/out-"
    root = spark.conf.get(_OWN_CONF, None)
    if not (root and root.startswith(own)):
        root = f"{own}{uuid.uuid4().hex}"
        spark.conf.set(_OWN_CONF, root)
    return root


def conform_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def replace_table(spark: SparkSession, df: DataFrame, name: str, root: str | None = None) -> DataFrame:
    """Truncate-and-load of one table: a new version is written, then pointed
    to, so readers see the old rows or the new ones. Read back lazily."""
    base = f"{root or output_root(spark)}/tables/{name}"
    version = uuid.uuid4().hex
    df.write.parquet(f"{base}/versions/{version}")
    _point(spark, base, version)
    return spark.read.parquet(f"{base}/versions/{_pointed(spark, base)}")


def write_run(spark: SparkSession, tables: dict[str, DataFrame], root: str | None = None,
              run_id: str | None = None, fact_partitions: int | None = None, publish: bool = True) -> str:
    """Write all tables of one load, then (with ``publish``) point readers to
    them. Returns the run id."""
    root = root or output_root(spark)
    run_id = run_id or uuid.uuid4().hex
    for name, df in tables.items():
        out = conform_to(df, TARGET_SCHEMAS[name]) if name in TARGET_SCHEMAS else df
        if name == "salesfact" and fact_partitions:
            out = out.repartition(fact_partitions, "timeid")
        out.write.mode("overwrite").parquet(f"{root}/runs/{run_id}/{name}")
    if publish:
        publish_run(spark, run_id, root)
    return run_id


def _point(spark: SparkSession, base: str, run_id: str) -> None:
    """Appends a pointer file, which appears as a whole when its write commits.
    Its sequence number follows the largest one there, so the order of runs
    does not depend on any driver's clock; of two drivers that publish at the
    same moment, the larger run id counts."""
    pointer = spark.range(1).select(F.lit(_last(spark, base)[0] + 1).alias("seq"), F.lit(run_id).alias("run_id"))
    pointer.coalesce(1).write.mode("append").json(f"{base}/pointers")


def _last(spark: SparkSession, base: str) -> tuple[int, str | None]:
    """(sequence number, run id) of the newest pointer; (0, None) without any."""
    try:
        pointers = spark.read.schema("seq long, run_id string").json(f"{base}/pointers")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return 0, None
    last = pointers.agg(F.max(F.struct("seq", "run_id")).alias("last")).first()["last"]
    return (0, None) if last is None else (last["seq"], last["run_id"])


def _pointed(spark: SparkSession, base: str) -> str:
    run_id = _last(spark, base)[1]
    if run_id is None:
        raise ValueError(f"nothing is published below {base}")
    return run_id


def publish_run(spark: SparkSession, run_id: str, root: str | None = None) -> None:
    """Makes a written run the current one."""
    _point(spark, root or output_root(spark), run_id)


def current_run(spark: SparkSession, root: str | None = None) -> str:
    return _pointed(spark, root or output_root(spark))


def read_table(spark: SparkSession, name: str, root: str | None = None, run_id: str | None = None) -> DataFrame:
    root = root or output_root(spark)
    run_id = run_id or current_run(spark, root)
    return spark.read.parquet(f"{root}/runs/{run_id}/{name}")
