"""Room experience: predict the third a room rating falls into."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, NaiveBayes
from pyspark.ml.feature import IndexToString, StringIndexerModel, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.functions.keys import hash_bucket
from staylens.functions.ratings import quantile_label
from staylens.operators import nulls, projection, sampling
from staylens.operators.features import fit_label_index
from staylens.operators.quantiles import THIRDS, quantile_struct
from staylens.plans.experiments import JobResult, run_experiments, weighted_f1_score
from staylens.sources.registry import RunRegistry
from staylens.sources.reviews import RATINGS
from staylens.workspace import stage, stage_for_fit

TASK_NAME = "Task B - Room Experience Classification"
FEATURES = [f"{r}_rating" for r in RATINGS if r != "rooms"] + ["month", "year"]


def estimators() -> dict:
    settings = dict(labelCol="label", featuresCol="features")
    return {"DecisionTree": DecisionTreeClassifier(maxDepth=5, **settings), "NaiveBayes": NaiveBayes(smoothing=1.0, **settings)}


def rating_rows(reviews: DataFrame) -> DataFrame:
    """Ratings as doubles, with the id and the date."""
    return reviews.select(*projection.rating_columns(reviews, RATINGS), "date_stayed", F.col("id").alias("review_id"))


def rated_rooms(reviews: DataFrame) -> DataFrame:
    """Ratings as doubles of the reviews that rate the room."""
    return rating_rows(projection.not_null(reviews, ["ratings.rooms"]))


def room_rows(reviews: DataFrame) -> DataFrame:
    """The features of any review, also of those that do not rate the room or lack some."""
    return projection.stay_date(rating_rows(reviews)).select("review_id", *FEATURES)


@dataclass
class RoomParts:
    """Labelled rooms with their features, split; the training part is balanced."""

    train: DataFrame
    test: DataFrame
    index: StringIndexerModel
    assembler: VectorAssembler


def room_parts(reviews: DataFrame, balance_before_split: bool = False, bucket: sampling.Bucket = hash_bucket) -> RoomParts:
    """Reviews that rate the room, with its third as ``rooms_label`` and ``label``, and ``features``.

    Classes are balanced in the training part only, so no copy of a review is in both
    parts; ``balance_before_split`` balances everything first. Reviews are split by a
    hash of their id, which ``bucket`` computes.
    """
    rooms = rated_rooms(reviews)
    # A sketch with the rank error of 1 % that the thirds are asked for; it reads one field.
    cuts = quantile_struct(rooms, "rooms_rating", THIRDS, accuracy=100).first()["q"]
    label = quantile_label(F.col("rooms_rating"), F.lit(cuts["q0"]), F.lit(cuts["q1"]))
    labelled = rooms.withColumn("rooms_label", label)

    def balanced(df: DataFrame) -> DataFrame:
        return sampling.oversample_near(df, "rooms_label", "review_id", bucket).drop("copy")

    if balance_before_split:
        labelled = balanced(labelled)
    dated = nulls.drop_incomplete(projection.with_stay_date(labelled), FEATURES)
    featured = stage(dated.select("review_id", "rooms_label", *FEATURES), "room-features")
    index = fit_label_index(featured, "rooms_label")
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features", handleInvalid="skip")
    prepared = PipelineModel([index, assembler]).transform(featured)
    train, test = sampling.hash_split(prepared, "review_id", bucket=bucket)
    if not balance_before_split:
        train = balanced(train)
    return RoomParts(train, test, index, assembler)


def classify_rooms(
    reviews: DataFrame,
    balance_before_split: bool = False,
    bucket: sampling.Bucket = hash_bucket,
    model_dir: str | None = None,
    registry: RunRegistry | None = None,
) -> JobResult:
    """Decision tree and naive Bayes, scored by weighted F1 on held-out reviews; parts as in ``room_parts``."""
    parts = room_parts(reviews, balance_before_split, bucket)
    columns = ["label", "features"]
    return run_experiments(
        "task_b",
        TASK_NAME,
        estimators(),
        train=stage_for_fit(parts.train.select(*columns), "rooms-train"),
        test=parts.test.select("review_id", "rooms_label", *columns),
        evaluate=weighted_f1_score,
        # New rows have no label, so the index is left out; its names turn predictions into classes.
        shared_stages=[parts.assembler],
        closing_stages=[IndexToString(inputCol="prediction", outputCol="predicted_label", labels=parts.index.labels)],
        model_dir=model_dir,
        registry=registry,
    )
