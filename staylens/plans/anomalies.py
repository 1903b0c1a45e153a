"""Anomalies: rows far from the centre of their own cluster, per author and review."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.clustering import KMeans
from pyspark.sql import DataFrame

from staylens.functions.vectors import vector_distance
from staylens.operators import aggregates, nulls
from staylens.operators.clusters import flag_anomalies, mean_distance
from staylens.operators.features import scaled_vector_stages
from staylens.plans.experiments import JobResult, Score, run_experiments
from staylens.sources.registry import RunRegistry
from staylens.workspace import stage, stage_for_fit

USER_TASK, REVIEW_TASK = "Task D - User Anomaly", "Task D - Review Anomaly"
USER_COLUMNS = ["review_count", "avg_text_length", "avg_helpful_votes"]
REVIEW_COLUMNS = ["text_length", "word_count"]


def cluster_distances(
    model_name: str,
    task_name: str,
    features: DataFrame,
    columns: Sequence[str],
    k: int = 3,
    seed: int = 42,
    model_dir: str | None = None,
    registry: RunRegistry | None = None,
) -> JobResult:
    """K-means over scaled columns, missing values replaced by the mean.

    Predictions carry each row's ``distance`` to its own centre, the cluster's
    ``threshold`` and ``is_anomaly``; the run's score is the mean distance.
    """
    features = stage_for_fit(features, "anomaly-features")
    if features.isEmpty():
        return JobResult(features.sparkSession)
    filled = nulls.mean_fill_stage(features, columns)
    scaler = Pipeline(stages=[filled, *scaled_vector_stages(columns)]).fit(features)
    scaled = scaler.transform(features)

    def with_distance(model, predictions: DataFrame) -> DataFrame:
        centres = model.clusterCenters()
        placed = predictions.withColumn("distance", vector_distance("features", "cluster", centres))
        return flag_anomalies(placed, len(centres))

    return run_experiments(
        "task_d",
        task_name,
        {model_name: KMeans(k=k, seed=seed, featuresCol="features", predictionCol="cluster")},
        train=scaled,
        test=scaled,
        evaluate=lambda predictions: Score("ClusterDistance", mean_distance(predictions).first()[0]),
        shared_stages=scaler.stages,
        finish=with_distance,
        model_dir=model_dir,
        registry=registry,
    )


def find_anomalies(
    reviews: DataFrame,
    k: int = 3,
    seed: int = 42,
    model_dir: str | None = None,
    registry: RunRegistry | None = None,
) -> JobResult:
    """Anomalous authors, then anomalous reviews; a level without rows has no run. Texts are read and split once."""
    result = JobResult(reviews.sparkSession)
    measured = stage(aggregates.measured_reviews(reviews), "measured-reviews")
    levels = [
        ("KMeans_User", USER_TASK, aggregates.measured_users(measured), USER_COLUMNS),
        ("KMeans_Review", REVIEW_TASK, aggregates.measured_texts(measured), REVIEW_COLUMNS),
    ]
    for model_name, task_name, features, columns in levels:
        level = cluster_distances(model_name, task_name, features, columns, k, seed, model_dir, registry)
        result.runs.extend(level.runs)
    return result
