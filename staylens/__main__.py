"""Run jobs over a review table: ``python -m staylens``, or this file with ``spark-submit``.

    python -m staylens segment sentiment --reviews /data/reviews --models /models --registry /registry
    python -m staylens score-sentiment --reviews /data/new --models /models --registry /registry --predictions /data/scored
"""

from __future__ import annotations

import argparse

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens import workspace
from staylens.plans import anomalies, room_experience, scoring, segmentation, sentiment
from staylens.session import get_session, ship_package
from staylens.sources.registry import RunRegistry
from staylens.sources.reviews import RATINGS, read_reviews_json, read_reviews_parquet

READERS = {"json": read_reviews_json, "parquet": read_reviews_parquet, "table": SparkSession.table}


def segment(reviews: DataFrame, **where):
    return segmentation.segment_entities(reviews.select("offering_id", "ratings.*"), "offering_id", RATINGS, **where)


def compare_sentiment(reviews: DataFrame, **where):
    return sentiment.compare_sentiment_models(reviews.select("id", "text", "ratings.overall"), **where)


JOBS = {
    "segment": segment,
    "rooms": room_experience.classify_rooms,
    "sentiment": compare_sentiment,
    "anomalies": anomalies.find_anomalies,
}


def score_sentiment(registry: RunRegistry, reviews: DataFrame) -> DataFrame:
    return scoring.score_batch(registry, sentiment.TASK_NAME, reviews.select("id", "text")).select("id", "prediction")


def score_segments(registry: RunRegistry, reviews: DataFrame) -> DataFrame:
    return scoring.score_segments(registry, reviews.select("offering_id", "ratings.*"), "offering_id", RATINGS)


# Best recorded model of a task on the given reviews; results by name.
SCORES = {
    "score-segments": lambda registry, reviews: {"segments": score_segments(registry, reviews)},
    "score-rooms": lambda registry, reviews: {"rooms": scoring.score_rooms(registry, reviews)},
    "score-sentiment": lambda registry, reviews: {"sentiment": score_sentiment(registry, reviews)},
    "score-anomalies": lambda registry, reviews: dict(zip(("users", "reviews"), scoring.score_reviews(registry, reviews), strict=True)),
}


def plain_columns(df: DataFrame) -> DataFrame:
    """Without the columns that hold a model's vectors."""
    return df.select(*[F.col(f"`{f.name}`") for f in df.schema.fields if not isinstance(f.dataType, VectorUDT)])


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="staylens", description="Review analytics jobs")
    parser.add_argument("jobs", nargs="+", choices=[*JOBS, *SCORES])
    parser.add_argument("--reviews", required=True, help="path or table of reviews")
    parser.add_argument("--format", choices=READERS, default="parquet")
    parser.add_argument("--models", required=True, help="folder for fitted models")
    parser.add_argument("--registry", required=True, help="folder of the run registry")
    parser.add_argument("--predictions", help="folder for predictions; needed by the scores")
    parser.add_argument("--hive", action="store_true", help="use the Hive metastore catalog")
    chosen = parser.parse_args(arguments)
    if chosen.predictions is None and any(job in SCORES for job in chosen.jobs):
        parser.error("scores need --predictions")

    spark = get_session("staylens", hive=chosen.hive)
    if not spark.sparkContext.master.startswith("local["):
        ship_package(spark)
    registry = RunRegistry(spark, chosen.registry)
    reviews = READERS[chosen.format](spark, chosen.reviews)
    try:
        for job in chosen.jobs:
            if job in JOBS:
                runs = JOBS[job](reviews, model_dir=chosen.models, registry=registry).runs
                found = {r.record.row_key: r.predictions for r in runs}
            else:
                found = SCORES[job](registry, reviews)
            if chosen.predictions is not None:
                for name, rows in found.items():
                    plain_columns(rows).write.mode("overwrite").parquet(f"{chosen.predictions.rstrip('/')}/{name}")
        registry.leaderboard().drop("details").orderBy("score_type", "rank").show(100, truncate=False)
    finally:
        workspace.release(spark)


if __name__ == "__main__":
    main()
