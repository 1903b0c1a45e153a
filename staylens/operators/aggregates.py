"""Aggregates per entity, author and class.

All of them combine on the map side, so a key that holds a third of the rows
reaches the shuffle as one partial row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.functions.text import word_count


def entity_stats(df: DataFrame, key: str, measures: Sequence[str]) -> DataFrame:
    """Mean and population standard deviation of each measure per entity.

    Rows without a key are left out. A statistic without any value is 0.
    """
    means = [F.avg(m).alias(f"avg_{m}") for m in measures]
    spreads = [F.stddev_pop(m).alias(f"stddev_{m}") for m in measures]
    stats = df.where(F.col(key).isNotNull()).groupBy(key).agg(*means, *spreads)
    return stats.na.fill(0.0, subset=[c for c in stats.columns if c != key])


def user_features(reviews: DataFrame) -> DataFrame:
    """Reviews, mean text length and mean helpful votes per author, in one pass."""
    return measured_users(measured_reviews(reviews))


def measured_reviews(reviews: DataFrame, compat: bool = False) -> DataFrame:
    """What is kept of a review's text and author: a few numbers, so that texts are read once for both levels."""
    return reviews.select(
        F.col("id").alias("review_id"),
        F.col("author.id").alias("user_id"),
        F.col("author.num_helpful_votes").alias("votes"),
        F.length("text").alias("text_length"),
        F.when(F.col("text").isNotNull(), word_count(F.col("text"), compat)).alias("word_count"),
    )


def measured_users(measured: DataFrame) -> DataFrame:
    """``user_features`` of measured reviews."""
    return measured.where(F.col("user_id").isNotNull()).groupBy("user_id").agg(
        F.count("*").alias("review_count"),
        F.avg("text_length").alias("avg_text_length"),
        F.avg("votes").alias("avg_helpful_votes"),
    )


def review_features(reviews: DataFrame, compat: bool = False) -> DataFrame:
    """Text length and word count per review with text; no join, no shuffle."""
    return reviews.where(F.col("text").isNotNull()).select(
        F.col("id").alias("review_id"),
        F.length("text").alias("text_length"),
        word_count(F.col("text"), compat).alias("word_count"),
    )


def measured_texts(measured: DataFrame) -> DataFrame:
    """``review_features`` of measured reviews."""
    return measured.where(F.col("text_length").isNotNull()).select("review_id", "text_length", "word_count")


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count("*").alias("n"))


def row_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows in all and rows with a value per column (nested allowed), in one pass."""
    counts = [F.count(c).alias(f"n_{c.replace('.', '_')}") for c in columns]
    return df.agg(F.count("*").alias("n_rows"), *counts)
