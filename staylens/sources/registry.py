"""Run registry: an append-only Parquet log of experiment records.

Putting a record appends; reading merges puts of the same key, the last one winning
cell by cell. Appends from several drivers do not disturb each other.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import asdict, dataclass
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staylens.operators import registry_views as views
from staylens.workspace import stage

DETAILS_SCHEMA = T.StructType(
    [
        T.StructField("f1_score", T.DoubleType()),
        T.StructField("macro_f1", T.DoubleType()),
        T.StructField("precision", T.DoubleType()),
        T.StructField("recall", T.DoubleType()),
        T.StructField(
            "confusion_matrix",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("label", T.DoubleType()),
                        T.StructField("prediction", T.DoubleType()),
                        T.StructField("count", T.LongType()),
                    ]
                )
            ),
        ),
    ]
)

PUT_SCHEMA = T.StructType(
    [
        T.StructField("row_key", T.StringType(), False),
        T.StructField("task_name", T.StringType()),
        T.StructField("model_name", T.StringType()),
        T.StructField("run_timestamp", T.TimestampType()),
        T.StructField("training_time_seconds", T.DoubleType()),
        T.StructField("evaluation_score", T.DoubleType()),
        T.StructField("score_type", T.StringType()),
        T.StructField("model_path", T.StringType()),
        T.StructField("details", DETAILS_SCHEMA),
        T.StructField("put_seq", T.LongType(), False),
    ]
)


@dataclass
class RunRecord:
    """One experiment run."""

    row_key: str
    task_name: str
    model_name: str
    run_timestamp: datetime
    training_time_seconds: float | None = None
    evaluation_score: float | None = None
    score_type: str | None = None
    model_path: str | None = None
    details: dict | None = None


def utc_now() -> datetime:
    return datetime.now(timezone.utc)


class RunRegistry:
    """Registry at a path that driver and executors share.

    With ``buckets`` the files lie in that many folders by a hash of the row key, sorted by key and
    with a Bloom filter on it: looking up keys opens only their folders. Open a path with the number
    it was written with; ``compact`` makes such a registry from a plain one.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None):
        self.spark = spark
        self.path = path
        self.buckets = buckets

    def put(self, records: Sequence[RunRecord]) -> None:
        """Append records built by the driver, a handful per job."""
        start = time.time_ns()
        rows = [{**asdict(r), "put_seq": start + i} for i, r in enumerate(records)]
        self.put_frame(self.spark.createDataFrame(rows, PUT_SCHEMA).coalesce(1))

    def put_frame(self, puts: DataFrame) -> None:
        """Append any number of puts from a frame; columns it lacks are left as they are.

        ``row_key`` and ``put_seq`` must be there, and a null in them ends the write.
        """
        needed = ["row_key", "put_seq"]
        lacking = [c for c in needed if c not in puts.columns]
        if lacking:
            raise ValueError(f"puts lack {lacking}")
        puts = puts.withColumns({c: F.coalesce(c, F.raise_error(F.lit(f"null {c} in a put"))) for c in needed})
        columns = [
            (F.col(f.name) if f.name in puts.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in PUT_SCHEMA
        ]
        self._write(puts.select(*columns))

    def _write(self, puts: DataFrame) -> None:
        if self.buckets is None:
            puts.write.mode("append").parquet(self.path)
            return
        placed = puts.withColumn(views.BUCKET, views.key_bucket(F.col(views.KEY), self.buckets))
        # Ranges over bucket and key: few files per folder, and a bucket with very many puts spans tasks.
        dealt = placed.repartitionByRange(views.BUCKET, views.KEY, views.VERSION).sortWithinPartitions(views.BUCKET, views.KEY)
        writer = dealt.write.mode("append").option(f"parquet.bloom.filter.enabled#{views.KEY}", "true")
        writer.partitionBy(views.BUCKET).parquet(self.path)

    def puts(self) -> DataFrame:
        """Every put; empty when nothing has been written yet."""
        return self._placed().select(*PUT_SCHEMA.names)

    def _placed(self) -> DataFrame:
        """Every put, with its folder's bucket where there are folders."""
        bucket = [T.StructField(views.BUCKET, T.LongType())] if self.buckets else []
        schema = T.StructType([*PUT_SCHEMA.fields, *bucket])
        try:
            return self.spark.read.schema(schema).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def read(self) -> DataFrame:
        return views.latest(self.puts())

    def keys(self, limit: int | None = 100) -> DataFrame:
        return views.keys(self.puts(), limit)

    def lookup(self, wanted: DataFrame) -> DataFrame:
        puts = self._placed() if self.buckets is None else views.in_folders_of(self._placed(), wanted, self.buckets)
        return views.lookup(puts.select(*PUT_SCHEMA.names), wanted)

    def get(self, row_keys: Sequence[str]) -> DataFrame:
        puts = self._placed()
        if self.buckets is not None:
            puts = puts.where(F.col(views.BUCKET).isin([views.key_bucket(F.lit(k), self.buckets) for k in row_keys]))
        return views.get(puts.select(*PUT_SCHEMA.names), row_keys)

    def leaderboard(self) -> DataFrame:
        return views.leaderboard(stage(self.read(), "registry"))

    def best_run(self, task_name: str, score_type: str | None = None):
        """The best run of a task as one row.

        Scores of different types do not compare: a task with several of them needs ``score_type``.
        """
        runs = self.read().where(F.col("task_name") == task_name)
        if score_type is not None:
            runs = runs.where(F.col("score_type") == score_type)
        best = views.best_runs(runs).limit(2).collect()
        if not best:
            raise LookupError(f"no scored run of task {task_name!r} in {self.path}")
        if len(best) > 1:
            raise LookupError(f"task {task_name!r} has runs of several score types; name one")
        return best[0]

    def compact(self, path: str, buckets: int | None = None) -> RunRegistry:
        """Write the merged rows to a new path, for logs with many overwritten puts; ``buckets`` makes lookups cheap."""
        compacted = RunRegistry(self.spark, path, buckets)
        compacted._write(self.read().select(*PUT_SCHEMA.names))
        return compacted
