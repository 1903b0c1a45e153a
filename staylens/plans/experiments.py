"""Fit, predict, score, save and record; one experiment per estimator."""

from __future__ import annotations

import math
import time
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import FIRST_EXCEPTION, ThreadPoolExecutor, wait
from dataclasses import dataclass, field

from pyspark.ml import Estimator, PipelineModel, Transformer
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import DataFrame, SparkSession
from pyspark.util import inheritable_thread_target

from staylens.operators import metrics
from staylens.sources.models import save_model
from staylens.sources.registry import PUT_SCHEMA, RunRecord, RunRegistry, utc_now


@dataclass
class Score:
    """The one score a run is ranked by, and details kept next to it."""

    score_type: str
    value: float | None
    details: dict | None = None


@dataclass
class Run:
    record: RunRecord
    model: PipelineModel
    predictions: DataFrame


@dataclass
class JobResult:
    """Runs of a job; the frames in it are lazy."""

    spark: SparkSession
    runs: list[Run] = field(default_factory=list)

    def records(self) -> DataFrame:
        """One row per run: the records as they went into the registry."""
        rows = [(*vars(r.record).values(), i) for i, r in enumerate(self.runs)]
        return self.spark.createDataFrame(rows, PUT_SCHEMA).drop("put_seq")

    def predictions(self, model_name: str) -> DataFrame:
        return next(r.predictions for r in self.runs if r.record.model_name == model_name)


def run_experiments(
    task: str,
    task_name: str,
    estimators: dict[str, Estimator],
    train: DataFrame,
    test: DataFrame,
    evaluate: Callable[[DataFrame], Score],
    shared_stages: Sequence[Transformer] = (),
    closing_stages: Sequence[Transformer] = (),
    finish: Callable[[Transformer, DataFrame], DataFrame] | None = None,
    model_dir: str | None = None,
    registry: RunRegistry | None = None,
    parallel: int = 2,
) -> JobResult:
    """Run each estimator on the same frames, up to ``parallel`` of them at once.

    A fit waits for the driver between its iterations, and small late stages leave executors idle, which
    another fit uses. Training times are those of fits that share the cluster.

    ``shared_stages`` are fitted stages whose output the frames hold already. They are
    put in front of each fitted model, so that what is saved takes raw rows;
    ``closing_stages`` follow the model in what is saved. ``finish`` adds to the predictions what depends on the fitted model.
    """
    spark = train.sparkSession

    def run_one(model_name: str, estimator: Estimator) -> Run:
        spark.sparkContext.setJobGroup(f"{group}-{model_name}", f"{task_name}: {model_name}", interruptOnCancel=True)
        started = time.perf_counter()
        model = estimator.fit(train)
        seconds = time.perf_counter() - started
        predictions = model.transform(test)
        if finish is not None:
            predictions = finish(model, predictions)
        score = evaluate(predictions)
        stamp = utc_now()
        # The suffix keeps runs within the same second apart.
        name = f"{task}_{model_name.lower()}_{stamp:%Y%m%d%H%M%S}_{uuid.uuid4().hex[:8]}"
        whole = PipelineModel([*shared_stages, model, *closing_stages])
        path = save_model(whole, f"{model_dir}/{name}") if model_dir else None
        # Without held-out rows there is no score, and the run is recorded without one.
        rounded = None if score.value is None or math.isnan(score.value) else round(score.value, 4)
        record = RunRecord(
            name, task_name, model_name, stamp, round(seconds, 2), rounded, score.score_type, path, score.details
        )
        return Run(record, whole, predictions)

    group = uuid.uuid4().hex
    if parallel <= 1 or len(estimators) <= 1:
        runs = [run_one(*pair) for pair in estimators.items()]
    else:
        runs = _run_together(spark, group, run_one, estimators, parallel)
    if registry is not None:
        registry.put([r.record for r in runs])
    return JobResult(spark, runs)


def _run_together(
    spark: SparkSession, group: str, run_one: Callable[[str, Estimator], Run], estimators: dict[str, Estimator], parallel: int
) -> list[Run]:
    """Runs in the order of the estimators, from threads that carry the caller's job properties.

    When one fails, the jobs of the others are cancelled and its error is raised.
    """
    with ThreadPoolExecutor(min(parallel, len(estimators))) as pool:
        waiting = [pool.submit(inheritable_thread_target(spark)(run_one), *pair) for pair in estimators.items()]
        done, pending = wait(waiting, return_when=FIRST_EXCEPTION)
        failed = next((f for f in done if f.exception() is not None), None)
        if failed is not None:
            for future, name in zip(waiting, estimators, strict=True):
                future.cancel()
                spark.sparkContext.cancelJobGroup(f"{group}-{name}")
            raise failed.exception()
        return [f.result() for f in waiting]


def weighted_f1_score(predictions: DataFrame) -> Score:
    """Weighted F1, named as what it is, with precision, recall and confusion matrix."""
    details = metrics.metrics_record(predictions).first()["details"].asDict(recursive=True)
    return Score("WeightedF1", details["f1_score"], details)


def sentiment_score(predictions: DataFrame) -> Score:
    """Area under ROC with weighted F1, precision, recall and the confusion matrix.

    ``numBins=0`` keeps every threshold; the default would thin the curve out.
    """
    area = BinaryClassificationEvaluator(rawPredictionCol="rawPrediction", labelCol="label", numBins=0)
    details = metrics.metrics_record(predictions).first()["details"].asDict(recursive=True)
    # Without rows the evaluator fails; the scores are null then.
    return Score("AUC", None if details["f1_score"] is None else area.evaluate(predictions), details)
