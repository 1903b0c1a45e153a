"""Review sentiment: predict from the text whether the overall rating is good."""

from __future__ import annotations

from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.ml.feature import IDF
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.functions.keys import hash_bucket
from staylens.functions.ratings import sentiment_label
from staylens.operators.sampling import Bucket, hash_split
from staylens.operators.text_features import TERM_BUCKETS, staged_term_vectors, term_vector_stages
from staylens.plans.experiments import JobResult, run_experiments, sentiment_score
from staylens.sources.registry import RunRegistry

TASK_NAME = "Task C - Sentiment Analysis"


def estimators() -> dict:
    settings = dict(featuresCol="features", labelCol="label")
    return {"LogisticRegression": LogisticRegression(**settings), "LinearSVM": LinearSVC(**settings)}


def compare_sentiment_models(
    reviews: DataFrame,
    key: str = "id",
    text: str = "text",
    overall: str = "overall",
    null_is_negative: bool = False,
    models: dict | None = None,
    buckets: int = TERM_BUCKETS,
    bucket: Bucket = hash_bucket,
    model_dir: str | None = None,
    registry: RunRegistry | None = None,
) -> JobResult:
    """Logistic regression and linear SVM over TF-IDF vectors, scored by AUC.

    Texts are read and split once, into staged term vectors. The IDF weights come from
    the training part only. A saved model holds all stages, so it takes plain text.
    Reviews are split by a hash of their key, which ``bucket`` computes.
    """
    labelled = reviews.select(
        F.col(key).alias("id"),
        F.col(text).alias("text"),
        sentiment_label(F.col(overall), null_is_negative=null_is_negative).alias("label"),
    ).where(F.col("label").isNotNull())
    terms = term_vector_stages("text", buckets=buckets)
    train, test = hash_split(staged_term_vectors(labelled, "text", buckets=buckets), "id", bucket=bucket)
    idf = IDF(inputCol="raw_features", outputCol="features").fit(train)
    return run_experiments(
        "task_c",
        TASK_NAME,
        models or estimators(),
        train=idf.transform(train),
        test=idf.transform(test),
        evaluate=sentiment_score,
        shared_stages=[*terms, idf],
        model_dir=model_dir,
        registry=registry,
    )
