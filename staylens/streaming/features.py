"""Author features kept up to date from a stream of reviews."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

USER, BATCH = "user_id", "batch"
SUMS = ["review_count", "text_count", "text_length", "votes_count", "votes"]
SUMS_SCHEMA = T.StructType([T.StructField(USER, T.StringType()), *[T.StructField(c, T.LongType()) for c in SUMS]])


def author_sums(reviews: DataFrame) -> DataFrame:
    """Counts and sums per author, from which all averages follow. The same plan for a table and a stream.

    On a stream the state is one row of five numbers per author, in the state store; each batch
    combines its reviews on the map side first, so that a very busy author is no hot key.
    """
    authored = reviews.where(F.col("author.id").isNotNull())
    votes = F.col("author.num_helpful_votes")
    return authored.groupBy(F.col("author.id").alias(USER)).agg(
        F.count("*").alias("review_count"),
        F.count("text").alias("text_count"),
        F.coalesce(F.sum(F.length("text").cast("long")), F.lit(0)).alias("text_length"),
        F.count(votes).alias("votes_count"),
        F.coalesce(F.sum(votes.cast("long")), F.lit(0)).alias("votes"),
    )


def follow_authors(stream: DataFrame, log: str, checkpoint: str) -> StreamingQuery:
    """Bring the log up to date with all reviews now there, then stop.

    Each batch writes the authors it changed, with their new sums, to a folder of its own number. A
    batch that is run again after a failure replaces that folder, so a restart repeats and loses nothing.
    """

    def put(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{log.rstrip('/')}/{BATCH}={batch}")

    writer = author_sums(stream).writeStream.foreachBatch(put).outputMode("update").option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def read_log(spark: SparkSession, log: str) -> DataFrame:
    """All changes, with the ``batch`` that made them."""
    schema = T.StructType([*SUMS_SCHEMA.fields, T.StructField(BATCH, T.LongType())])
    try:
        return spark.read.schema(schema).parquet(log)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def latest_features(changes: DataFrame) -> DataFrame:
    """The features of ``aggregates.user_features`` from each author's last change.

    ``max_by`` combines on the map side, so authors changed in very many batches cost no more than others.
    """
    last = changes.groupBy(USER).agg(F.max_by(F.struct(*SUMS), BATCH).alias("s")).select(USER, "s.*")

    def mean(total: str, count: str):
        return F.when(F.col(count) > 0, F.col(total) / F.col(count))

    return last.select(
        USER,
        "review_count",
        mean("text_length", "text_count").alias("avg_text_length"),
        mean("votes", "votes_count").alias("avg_helpful_votes"),
    )


def compact_log(spark: SparkSession, log: str, path: str) -> None:
    """Write each author's last change to a new log, under the number of the batch that made it."""
    last = read_log(spark, log).groupBy(USER).agg(F.max_by(F.struct(*SUMS, BATCH), BATCH).alias("s"))
    last.select(USER, "s.*").write.partitionBy(BATCH).parquet(path)
