"""Score rows as they arrive."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def read_stream(
    spark: SparkSession, path: str, schema: T.StructType, glob: str | None = None, files_per_trigger: int = 1_000
) -> DataFrame:
    """Parquet files of a folder as a stream, a bounded number of files per batch.

    ``path`` may hold wildcards; one that matches a table's name reads it both as one file and as a folder of files.
    """
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(path)


def score_stream(
    stream: DataFrame, model: PipelineModel, columns: Sequence[str], output: str, checkpoint: str
) -> StreamingQuery:
    """Write predictions of all rows now available, then stop.

    The model is row-wise, so the query keeps no state and needs no watermark. File
    sink and checkpoint in the shared folder make a restart continue without repeats.
    """
    scored = model.transform(stream).select(*columns)
    writer = scored.writeStream.format("parquet").option("path", output).option("checkpointLocation", checkpoint)
    return writer.outputMode("append").trigger(availableNow=True).start()
