"""The composed jobs, each with saved models and registry records."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from staylens.catalog.base import query
from staylens.catalog.models import entity_ratings, rated_documents, train_sentiment
from staylens.operators import metrics
from staylens.plans import anomalies, room_experience, segmentation, sentiment
from staylens.sources.registry import RunRegistry
from staylens.sources.reviews import RATINGS, reviews_from_orders
from staylens.workspace import new_dir, stage


def recorded_runs(registry):
    """What the registry holds after a job."""
    return registry.leaderboard().select(
        "task_name",
        "model_name",
        "score_type",
        "evaluation_score",
        "rank",
        F.col("model_path").isNotNull().alias("saved"),
        F.to_json("details").alias("details"),
    )


def run_recorded(spark, job, *args):
    """Run a job with a registry and a model folder of its own."""
    registry = RunRegistry(spark, new_dir(spark, "registry"))
    job(*args, model_dir=new_dir(spark, "models"), registry=registry)
    return recorded_runs(registry)


@query("job_segment")
def job_segment(spark, sf_dir):
    return run_recorded(spark, segmentation.segment_entities, entity_ratings(spark, sf_dir), "offering_id", RATINGS)


@query("job_classify")
def job_classify(spark, sf_dir):
    return run_recorded(spark, room_experience.classify_rooms, reviews_from_orders(spark, sf_dir, with_text=False))


@query("job_sentiment")
def job_sentiment(spark, sf_dir):
    return recorded_runs(train_sentiment(spark, sf_dir))


@query("job_anomaly")
def job_anomaly(spark, sf_dir):
    return run_recorded(spark, anomalies.find_anomalies, reviews_from_orders(spark, sf_dir))


RECORDS_SQL = " UNION ALL ".join(
    f"SELECT '{task}' AS task_name, '{model}' AS model_name, '{score}' AS score_type, true AS saved, true AS score_agrees"
    for task, models, score in (
        (segmentation.TASK_NAME, ("KMeans", "GMM"), "Silhouette"),
        (room_experience.TASK_NAME, ("DecisionTree", "NaiveBayes"), "WeightedF1"),
        (sentiment.TASK_NAME, ("LogisticRegression", "LinearSVM"), "AUC"),
        (anomalies.USER_TASK, ("KMeans_User",), "ClusterDistance"),
        (anomalies.REVIEW_TASK, ("KMeans_Review",), "ClusterDistance"),
    )
    for model in models
)


@query("job_records", RECORDS_SQL)
def job_records(spark, sf_dir):
    """Every run of the four jobs, and whether its recorded score is the one our own metrics give its predictions.

    Silhouettes come from cluster sums, F1 from the confusion matrix, AUC from running totals over scores, and
    distances from the saved centres; the jobs' evaluators take no part.
    """
    registry, models = RunRegistry(spark, new_dir(spark, "registry")), new_dir(spark, "models")
    where = {"model_dir": models, "registry": registry}
    reviews = reviews_from_orders(spark, sf_dir)
    jobs = [
        segmentation.segment_entities(entity_ratings(spark, sf_dir), "offering_id", RATINGS, **where),
        room_experience.classify_rooms(reviews_from_orders(spark, sf_dir, with_text=False), **where),
        sentiment.compare_sentiment_models(rated_documents(spark, sf_dir), **where),
        anomalies.find_anomalies(reviews, **where),
    ]

    def again(run):
        rows = run.predictions
        if run.record.score_type == "Silhouette":
            size = run.model.stages[-1].clusterCenters()[0].size if hasattr(run.model.stages[-1], "clusterCenters") else len(run.model.stages[-1].gaussiansDF.first()["mean"])
            columns = [f"x{i}" for i in range(size)]
            flat = rows.select("cluster_id", vector_to_array("features").alias("x"))
            flat = flat.select("cluster_id", *[F.get("x", F.lit(i)).alias(c) for i, c in enumerate(columns)])
            return metrics.silhouette(stage(flat, "clustered"), columns, "cluster_id")
        if run.record.score_type == "WeightedF1":
            return metrics.f1_scores(rows).select("weighted_f1")
        if run.record.score_type == "AUC":
            scored = rows.select("label", F.get(vector_to_array("rawPrediction"), F.lit(1)).alias("score"))
            return metrics.auc(stage(scored, "raw-scores"), "score")
        return rows.agg(F.avg("distance"))

    found = [(run.record.row_key, float(again(run).first()[0])) for job in jobs for run in job.runs]
    recomputed = spark.createDataFrame(found, "row_key string, again double")
    agrees = F.abs(F.col("evaluation_score") - F.col("again")) <= 0.0001
    runs = registry.leaderboard().join(recomputed, "row_key")
    return runs.select("task_name", "model_name", "score_type", F.col("model_path").isNotNull().alias("saved"), agrees.alias("score_agrees"))
