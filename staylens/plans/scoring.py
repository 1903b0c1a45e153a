"""Apply the best recorded model of a task to new rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.functions.vectors import vector_distance
from staylens.operators import aggregates
from staylens.operators.clusters import flag_anomalies
from staylens.plans import anomalies, room_experience, segmentation
from staylens.sources.models import load_pipeline
from staylens.sources.registry import RunRegistry
from staylens.workspace import stage


def score_batch(registry: RunRegistry, task_name: str, rows: DataFrame) -> DataFrame:
    """Predictions of the task's best model: row-wise stages only, so no shuffle."""
    return load_pipeline(registry.best_run(task_name)["model_path"]).transform(rows)


def score_complete(registry: RunRegistry, task_name: str, rows: DataFrame, features: Sequence[str], outputs: Sequence[str]) -> DataFrame:
    """All rows with the model's ``outputs``; rows without some feature, or with NaN in it, have null there.

    Saved models skip such rows, and a caller would lose them without a word.
    """
    known = reduce(and_, [F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) for c in features])
    scored = score_batch(registry, task_name, rows.where(known)).select(*rows.columns, *outputs)
    return scored.unionByName(rows.where(~known), allowMissingColumns=True)


def score_segments(registry: RunRegistry, df: DataFrame, key: str, measures: Sequence[str]) -> DataFrame:
    """``cluster_id`` of each entity, from the rows that rate it: one aggregate, then the model row by row."""
    stats = aggregates.entity_stats(df, key, measures)
    return score_batch(registry, segmentation.TASK_NAME, stats).select(key, "cluster_id")


def score_rooms(registry: RunRegistry, reviews: DataFrame) -> DataFrame:
    """``prediction`` and ``predicted_label`` of every review, whether it rates the room or not; null where features are missing."""
    rows = room_experience.room_rows(reviews)
    outputs = ["prediction", "predicted_label"]
    return score_complete(registry, room_experience.TASK_NAME, rows, room_experience.FEATURES, outputs).select("review_id", *outputs)


def score_anomalies(registry: RunRegistry, task_name: str, features: DataFrame) -> DataFrame:
    """``cluster``, ``distance``, ``threshold`` and ``is_anomaly`` of each row, by the saved centres.

    Missing values are filled with the training means, as the saved stages do. Thresholds are those of the rows
    scored, which are staged, as they are read for the thresholds and again for the flags.
    """
    model = load_pipeline(registry.best_run(task_name)["model_path"])
    centres = model.stages[-1].clusterCenters()
    placed = model.transform(features).withColumn("distance", vector_distance("features", "cluster", centres))
    kept = stage(placed.select(*features.columns, "cluster", "distance"), "anomaly-distances")
    return flag_anomalies(kept, len(centres))


def score_reviews(registry: RunRegistry, reviews: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Anomalous authors and anomalous reviews among new reviews, whose texts are read once."""
    measured = stage(aggregates.measured_reviews(reviews), "measured-reviews")
    users = score_anomalies(registry, anomalies.USER_TASK, aggregates.measured_users(measured))
    return users, score_anomalies(registry, anomalies.REVIEW_TASK, aggregates.measured_texts(measured))
