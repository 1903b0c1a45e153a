from __future__ import annotations

import math

import pytest
from conftest import rows
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.evaluation import BinaryClassificationEvaluator, ClusteringEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import StandardScaler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from staylens.catalog.models import entity_ratings, rated_documents
from staylens.functions.vectors import vector_columns, vector_distance
from staylens.operators import clusters, features, metrics, nulls
from staylens.plans import anomalies, room_experience, scoring, segmentation, sentiment
from staylens.sources.models import load_pipeline
from staylens.sources.registry import RunRegistry
from staylens.sources.reviews import RATINGS, reviews_from_orders
from staylens.sources.tables import read_table
from staylens.workspace import new_dir


@pytest.fixture(scope="module")
def pairs(spark):
    return spark.createDataFrame(
        [(0.0, 0.0), (0.0, 1.0), (1.0, 1.0), (1.0, 1.0), (2.0, 1.0), (2.0, 0.0), (1.0, 0.0), (0.0, 0.0)],
        "label double, prediction double",
    )


def test_f1_equals_mllib(spark, pairs):
    ours = metrics.f1_scores(pairs).first()
    names = {
        "weighted_f1": "f1",
        "weighted_precision": "weightedPrecision",
        "weighted_recall": "weightedRecall",
        "accuracy": "accuracy",
    }
    for mine, theirs in names.items():
        expected = MulticlassClassificationEvaluator(metricName=theirs).evaluate(pairs)
        assert ours[mine] == pytest.approx(expected, abs=1e-12)


def test_confusion_matrix_omits_absent_cells(spark, pairs):
    cells = {(r.label, r.prediction): r.n for r in metrics.confusion_matrix(pairs).collect()}
    assert cells == {(0, 0): 2, (0, 1): 1, (1, 1): 2, (1, 0): 1, (2, 1): 1, (2, 0): 1}
    details = metrics.metrics_record(pairs).first().details
    assert [c["count"] for c in details.confusion_matrix] == [2, 1, 1, 2, 1, 1]


def test_auc_equals_mllib_with_ties(spark):
    df = spark.range(500).select(
        (F.col("id") * 7919 % 37).cast("double").alias("rawPrediction"), (F.col("id") * 31 % 10 < 4).cast("double").alias("label")
    )
    exact = BinaryClassificationEvaluator(numBins=0).evaluate(df)
    assert metrics.auc(df, "rawPrediction").first().auc == pytest.approx(exact, abs=1e-12)
    one_class = df.where("label = 1")
    assert metrics.auc(one_class, "rawPrediction").first().auc is None


def test_auc_brute_force(spark):
    data = [(0.1, 0), (0.4, 1), (0.4, 0), (0.8, 1), (0.9, 0)]
    df = spark.createDataFrame([(s, float(y)) for s, y in data], "s double, label double")
    pos, neg = [s for s, y in data if y], [s for s, y in data if not y]
    wins = sum((p > n) + (p == n) / 2 for p in pos for n in neg)
    assert metrics.auc(df, "s").first().auc == pytest.approx(wins / (len(pos) * len(neg)))


def test_silhouette_equals_mllib(spark):
    df = spark.range(90).select(
        (F.col("id") % 9).cast("double").alias("a"),
        (F.col("id") * 7 % 13).cast("double").alias("b"),
        (F.col("id") % 3).cast("int").alias("prediction"),
    )
    vectors = nulls.assemble(df, ["a", "b"], "features")
    assert metrics.silhouette(df, ["a", "b"], "prediction").first()[0] == pytest.approx(ClusteringEvaluator().evaluate(vectors), abs=1e-12)


def test_silhouette_limits(spark):
    df = spark.createDataFrame([(1.0, 0), (2.0, 0), (9.0, 1)], "x double, c int")
    found = {r.x: r.silhouette for r in metrics.silhouette_rows(df, ["x"], "c").collect()}
    assert found[9.0] == 0.0 and found[1.0] == pytest.approx(1 - 1 / 64)
    with pytest.raises(Exception, match="at least two clusters"):
        metrics.silhouette(df.where("c = 0"), ["x"], "c").collect()
    with pytest.raises(Exception, match="more than 1 clusters"):
        metrics.silhouette_rows(df, ["x"], "c", max_clusters=1).collect()


def test_scaling_equals_mllib(spark, sf_dir):
    df = read_table(spark, sf_dir, "lineitem").select("l_quantity", "l_tax", F.lit(3.0).alias("constant"))
    columns = df.columns
    scaler = StandardScaler(inputCol="v", outputCol="s", withMean=True, withStd=True)
    vectors = nulls.assemble(df, columns, "v")
    expected = scaler.fit(vectors).transform(vectors).select(*vector_columns("s", columns))
    gap = [F.sum(F.abs(c)).alias(c) for c in columns]
    ours = features.standard_scale(df, columns)
    assert [round(x, 6) for x in ours.agg(*gap).first()] == [round(x, 6) for x in expected.agg(*gap).first()]
    assert ours.select("constant").distinct().collect() == [(0.0,)]


def test_label_index_order(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "s string")
    assert list(features.fit_label_index(df, "s").labels) == ["c", "a", "b"]


def test_naive_bayes_equals_mllib(spark):
    df = spark.range(60).select(
        (F.col("id") % 3).cast("double").alias("label"),
        (F.col("id") % 5).cast("double").alias("a"),
        (F.col("id") * 3 % 7).cast("double").alias("b"),
    )
    model = NaiveBayes(smoothing=1.0).fit(nulls.assemble(df, ["a", "b"], "features"))
    for row in clusters.naive_bayes_parameters(df, "label", ["a", "b"]).collect():
        assert row.pi == pytest.approx(model.pi[int(row.label)], abs=1e-9)
        assert row.theta == pytest.approx(model.theta.toArray()[int(row.label)][["a", "b"].index(row.feature)], abs=1e-9)


def test_distances(spark):
    df = spark.createDataFrame([(0.0, 0.0), (3.0, 4.0), (5.0, 5.0)], "x double, y double")
    centres = [(0.0, 0.0), (6.0, 8.0)]
    placed = clusters.assign_to_centres(df, ["x", "y"], centres)
    assert [(r.cluster, round(r.distance, 6)) for r in placed.collect()] == [(0, 0.0), (0, 5.0), (1, round(math.sqrt(10), 6))]
    vectors = nulls.assemble(placed, ["x", "y"], "v")
    again = vectors.select("distance", vector_distance("v", "cluster", centres).alias("d")).collect()
    assert all(r.distance == pytest.approx(r.d) for r in again)


def test_anomaly_flags(spark):
    with pytest.raises(Exception, match="more than 1 clusters"):
        clusters.flag_anomalies(spark.createDataFrame([(0, 1.0), (1, 2.0)], "cluster int, distance double"), 1).collect()
    distance = F.when(F.col("id") == 200, 50.0).otherwise(1.0).alias("distance")
    df = spark.range(201).select((F.col("id") % 2).cast("int").alias("cluster"), distance)
    flagged = clusters.flag_anomalies(df, 2)
    assert flagged.count() == 201 and flagged.where("is_anomaly").count() == 1
    assert flagged.where("is_anomaly").first().distance == 50.0


def test_segmentation(spark, sf_dir):
    registry = RunRegistry(spark, new_dir(spark, "registry"))
    job = segmentation.segment_entities(
        entity_ratings(spark, sf_dir), "offering_id", RATINGS, k=3, model_dir=new_dir(spark, "models"), registry=registry
    )
    assert [r.record.model_name for r in job.runs] == ["KMeans", "GMM"]
    for run in job.runs:
        assert {r.cluster_id for r in run.predictions.select("cluster_id").collect()} <= {0, 1, 2}
        assert -1 <= run.record.evaluation_score <= 1
    assert registry.read().count() == 2 == job.records().count()
    kmeans = job.runs[0]
    centres = kmeans.model.stages[-1].clusterCenters()
    for row in kmeans.predictions.select(vector_to_array("features").alias("f"), "cluster_id").collect():
        assert row.cluster_id == min(range(3), key=lambda k: math.dist(row.f, centres[k]))
    loaded = load_pipeline(kmeans.record.model_path)
    stats = kmeans.predictions.drop("raw_features", "features", "cluster_id")
    assert rows(loaded.transform(stats).select("offering_id", "cluster_id")) == rows(
        kmeans.predictions.select("offering_id", "cluster_id")
    )


@pytest.mark.parametrize("balance_before_split", [False, True])
def test_room_classification(spark, sf_dir, balance_before_split):
    reviews = reviews_from_orders(spark, sf_dir, with_text=False)
    job = room_experience.classify_rooms(reviews, balance_before_split, model_dir=new_dir(spark, "models"))
    for run in job.runs:
        assert run.record.score_type == "WeightedF1" and 0 <= run.record.evaluation_score <= 1
        details = run.record.details
        assert sum(c["count"] for c in details["confusion_matrix"]) == run.predictions.count()
    ids = job.runs[0].predictions.select("review_id")
    if not balance_before_split:
        assert ids.distinct().count() == ids.count()
    rated = room_experience.rated_rooms(reviews).limit(5).fillna(1.0).withColumns({"month": F.lit(1), "year": F.lit(2000)})
    assert load_pipeline(job.runs[0].record.model_path).transform(rated).count() == 5


def test_sentiment_and_scoring(spark, sf_dir):
    registry = RunRegistry(spark, new_dir(spark, "registry"))
    job = sentiment.compare_sentiment_models(
        rated_documents(spark, sf_dir), model_dir=new_dir(spark, "models"), registry=registry, buckets=500
    )
    for run in job.runs:
        assert 0 <= run.record.evaluation_score <= 1
        expected = BinaryClassificationEvaluator(numBins=0).evaluate(run.predictions)
        assert run.record.evaluation_score == pytest.approx(expected, abs=1e-4)
    best = registry.best_run(sentiment.TASK_NAME)
    assert best["evaluation_score"] == max(r.record.evaluation_score for r in job.runs)
    new = spark.createDataFrame([(1, "a good stay"), (2, "")], "doc_id long, text string")
    assert scoring.score_batch(registry, sentiment.TASK_NAME, new).select("prediction").count() == 2
    with pytest.raises(LookupError):
        registry.best_run("no such task")


def test_scoring_rooms_keeps_incomplete_reviews(spark, sf_dir):
    registry = RunRegistry(spark, new_dir(spark, "registry"))
    reviews = reviews_from_orders(spark, sf_dir, with_text=False)
    room_experience.classify_rooms(reviews, model_dir=new_dir(spark, "models"), registry=registry)
    new = reviews.limit(30).withColumns(
        {
            "date_stayed": F.when(F.col("id") % 2 == 0, F.lit("May 2014")).when(F.col("id") % 3 == 0, "no date"),
            "ratings": F.struct(*[F.lit(3.0).alias(r) for r in RATINGS if r != "rooms"], F.lit(None).cast("double").alias("rooms")),
        }
    )
    scored = scoring.score_rooms(registry, new)
    assert scored.count() == 30
    known = scored.where("review_id % 2 = 0")
    assert known.where("prediction IS NULL OR predicted_label NOT IN ('Low', 'Medium', 'High')").count() == 0
    assert scored.where("review_id % 2 = 1 AND (prediction IS NOT NULL OR predicted_label IS NOT NULL)").count() == 0


def test_the_package_travels_as_an_archive(spark):
    import io
    import subprocess
    import sys
    import zipfile

    from staylens.session import package_zip, ship_package

    names = zipfile.ZipFile(io.BytesIO(package_zip())).namelist()
    assert "staylens/operators/joins.py" in names and all(n.endswith(".py") for n in names)
    path = ship_package(spark).removeprefix("file:")
    code = f"import sys; sys.path.insert(0, {path!r}); import staylens.operators.ranking as r; assert {path!r} in r.__file__"
    subprocess.run([sys.executable, "-c", code], check=True, cwd="/")


def test_anomaly_job(spark, sf_dir):
    job = anomalies.find_anomalies(reviews_from_orders(spark, sf_dir), model_dir=new_dir(spark, "models"))
    assert [r.record.model_name for r in job.runs] == ["KMeans_User", "KMeans_Review"]
    for run in job.runs:
        kmeans = run.model.stages[-1]
        placed = run.predictions.withColumn("f", vector_to_array("features"))
        for row in placed.limit(20).collect():
            assert row.distance == pytest.approx(math.dist(row.f, kmeans.clusterCenters()[row.cluster]))
        assert run.record.evaluation_score == pytest.approx(run.predictions.agg(F.avg("distance")).first()[0], abs=1e-4)


def test_anomaly_job_without_rows(spark, sf_dir):
    none = reviews_from_orders(spark, sf_dir).where("id < 0")
    job = anomalies.find_anomalies(none)
    assert job.runs == [] and job.records().count() == 0


def test_jobs_from_the_command_line(spark, sf_dir, tmp_path, capsys):
    from staylens.__main__ import main

    reviews, models, registry = (str(tmp_path / n) for n in ("reviews", "models", "registry"))
    reviews_from_orders(spark, sf_dir).write.json(reviews)
    kept = new_dir(spark, "kept")
    options = ["--reviews", reviews, "--format", "json", "--models", models, "--registry", registry]
    main(["segment", "anomalies", *options])
    assert "KMeans_User" in capsys.readouterr().out
    scores = ["score-segments", "score-anomalies"]
    with pytest.raises(SystemExit):
        main([*scores, *options])
    main([*scores, *options, "--predictions", str(tmp_path / "scored")])
    written = {name: spark.read.parquet(f"{tmp_path}/scored/{name}") for name in ("segments", "users", "reviews")}
    assert written["segments"].columns == ["offering_id", "cluster_id"] and written["segments"].count() > 0
    assert written["users"].where("cluster IS NULL OR is_anomaly IS NULL").count() == 0 and written["reviews"].count() > 0
    assert RunRegistry(spark, registry).read().count() == 4
    path = RunRegistry(spark, registry).best_run("Task A - Clustering")["model_path"]
    assert path.startswith(models) and load_pipeline(path).stages
    # What the jobs staged is gone, and nothing else.
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(kept)


def test_streamed_reviews_arrive_in_files_of_bounded_size(spark, sf_dir, monkeypatch):
    from staylens.catalog import models

    plain = sorted(map(tuple, models.stream_user_features(spark, sf_dir).collect()))
    seen, read = [], models.stream_scoring.read_stream

    def counted(spark, folder, schema, files_per_trigger):
        seen.append((spark.read.parquet(folder).inputFiles(), files_per_trigger))
        return read(spark, folder, schema, files_per_trigger=files_per_trigger)

    monkeypatch.setattr(models, "FILE_ROWS", 100)
    monkeypatch.setattr(models.stream_scoring, "read_stream", counted)
    assert sorted(map(tuple, models.stream_user_features(spark, sf_dir).collect())) == plain
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").count()
    files = -(-orders // 200)
    assert [(len(f), n) for f, n in seen] == [(files, -(-files // 2)), (2 * files, -(-files // 2))]
