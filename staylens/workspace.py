"""Shared scratch space for staged tables, models and stream state.

On a cluster everything written here must be visible to every executor, so the
base is the folder the session names in ``spark.checkpoint.dir``. Only a local
session without that setting falls back to a temporary folder.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

_local_base: list[str] = []


def shared_base(spark: SparkSession) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    if not _local_base:
        _local_base.append(tempfile.mkdtemp(prefix="staylens-"))
    return _local_base[0]


def session_dir(spark: SparkSession) -> str:
    """The folder below the shared base that holds everything this application staged."""
    return f"{shared_base(spark)}/staylens/{spark.sparkContext.applicationId}"


def new_dir(spark: SparkSession, name: str) -> str:
    """A fresh path in the session's folder; nothing is created yet."""
    return f"{session_dir(spark)}/{name}-{uuid.uuid4().hex}"


def release(spark: SparkSession) -> None:
    """Delete what this application staged. Frames and models that read it end here."""
    path = spark._jvm.org.apache.hadoop.fs.Path(session_dir(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stage(df: DataFrame, name: str, schema: StructType | None = None) -> DataFrame:
    """Write ``df`` once as a table in the shared folder and read it back.

    Used where several passes follow (iterative fits, two branches of one plan).
    It cuts lineage, survives the loss of executors, keeps column pruning, and
    gives the planner a true size for its broadcast decisions. ``schema`` names other types
    with the same stored form, as a vector has that of a struct.
    """
    spark = df.sparkSession
    path = new_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(schema or df.schema).parquet(path)


def stage_for_fit(df: DataFrame, name: str, rows_per_task: int = 50_000, schema: StructType | None = None, least: int = 1) -> DataFrame:
    """``stage`` for a frame that a fit reads many times.

    Each iteration merges one gradient or histogram per task, so many tasks with few
    rows each cost more than they save: small tables are read by fewer tasks, without a
    shuffle, but by ``least`` if they have as many partitions. Large ones keep the partitions their files give them.
    """
    staged = stage(df, name, schema)
    tasks = max(least, -(-staged.count() // rows_per_task))
    return staged.coalesce(tasks) if tasks < staged.rdd.getNumPartitions() else staged
