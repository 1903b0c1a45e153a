"""Query registry of this folder and the tables its queries read."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

# Keys with more than one in so many of all rows are joined by broadcast: at most so many rows.
MOST_HOT = 10_000

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query; without ``oracle`` a test compares it with a brute-force version."""

    def register(function: Query) -> Query:
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = oracle
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh folder in the shared space that ``spark.checkpoint.dir`` names."""
    from staylens.workspace import new_dir

    return new_dir(spark, name)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back."""
    from staylens.workspace import stage

    return stage(df, name)


def given_back(result: pa.Table | None = None) -> pa.Table | None:
    """``result``, after the memory that nothing uses any more went back to the system.

    A Python worker serves one task after the other, of later stages too, and would sit beside the
    executor's JVM with all that its largest group or batch ever took.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)
    return result


def leanly(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for ``mapInArrow``; memory goes back when a task's rows are out."""

    def lean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        given_back()

    return lean


def dropped(df: DataFrame) -> None:
    """Delete the folders of a staged table that nothing reads any more."""
    spark = df.sparkSession
    for file in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(file)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
