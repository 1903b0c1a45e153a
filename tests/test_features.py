"""Model certificates, stored sketches, author features on a stream, checked JSON, registry folders, fits at once."""

from __future__ import annotations

import json

import numpy as np
import pytest
from conftest import plan_of, rows
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression
from pyspark.ml.clustering import GaussianMixture
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staylens.operators import aggregates, certificates, ranking, sketches
from staylens.plans import experiments
from staylens.sources.registry import RunRecord, RunRegistry, utc_now
from staylens.sources.reviews import REVIEW_SCHEMA, line_counts, read_review_lines
from staylens.streaming import features as author_stream
from staylens.streaming.scoring import read_stream

RNG = np.random.default_rng(8)


@pytest.mark.parametrize("loss", ["logistic", "hinge"])
def test_linear_certificate_equals_numpy(spark, loss):
    """Sparse rows, one of them empty and one with a repeated index."""
    x = np.where(RNG.random((60, 7)) < 0.4, RNG.normal(size=(60, 7)), 0.0)
    x[5] = 0
    y = (RNG.random(60) < 0.4).astype(float)
    w, b = RNG.normal(size=7), 0.3
    data = [(float(y[i]), [(j, float(x[i, j]) / 2) for j in np.flatnonzero(x[i]).tolist() for _ in range(2)]) for i in range(60)]
    df = spark.createDataFrame(data, "label double, entries array<struct<index: int, value: double>>")

    def expected(w, b):
        m = x @ w + b
        s = 2 * y - 1
        if loss == "logistic":
            return np.log1p(np.exp(-s * m)).mean(), 1 / (1 + np.exp(-m)) - y
        return np.maximum(1 - s * m, 0).mean(), np.where(s * m < 1, -s, 0.0)

    found = certificates.linear_certificate(df, "entries", "label", w, b, loss).first()
    for value, slope, (e_value, e_slope) in (("loss", "gradient", expected(w, b)), ("start_loss", "start_gradient", expected(np.zeros(7), 0))):
        gradient = np.append(x.T @ e_slope, e_slope.sum()) / 60
        assert found[value] == pytest.approx(e_value, abs=1e-12)
        assert found[slope] == pytest.approx(np.abs(gradient).max(), abs=1e-12)


def test_gradient_vanishes_at_the_optimum(spark):
    x = RNG.normal(size=(300, 3))
    y = (x @ [1.0, -2.0, 0.5] + RNG.normal(size=300) > 0).astype(float)
    df = spark.createDataFrame([(float(v), *map(float, r)) for v, r in zip(y, x, strict=True)], "label double, a double, b double, c double")
    model = LogisticRegression(tol=1e-10).fit(VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df))
    entries = F.array(*[F.struct(F.lit(i).alias("index"), F.col(c).alias("value")) for i, c in enumerate("abc")])
    proof = certificates.linear_certificate(df.select("label", entries.alias("entries")), "entries", "label", model.coefficients, model.intercept, "logistic").first()
    assert proof["gradient"] < 1e-6 * proof["start_gradient"] and proof["loss"] < proof["start_loss"]


def test_split_gains_equal_every_split(spark):
    data = [(float(RNG.integers(0, 3)), float(RNG.integers(0, 9)), float(RNG.normal()) if i % 10 else None) for i in range(400)]
    df = spark.createDataFrame(data, "label double, a double, b double")

    def gini(v):
        return 1 - sum((np.sum(v == k) / len(v)) ** 2 for k in range(3))

    expected = set()
    for name, column in (("a", 1), ("b", 2)):
        known = [(r[0], r[column]) for r in data if r[column] is not None]
        y, x = (np.array(v) for v in zip(*known, strict=True))
        for at in np.unique(x)[:-1]:
            left, right = y[x <= at], y[x > at]
            gain = gini(y) - (len(left) * gini(left) + len(right) * gini(right)) / len(y)
            expected.add((name, float(at), len(left), len(right), round(gain, 9)))
    found = certificates.split_gains(df, ["a", "b"], "label", 3)
    assert {(r["feature"], r["at_most"], r["n_left"], r["n_right"], round(r["gain"], 9)) for r in found.collect()} == expected
    full = df.select("label", "a")
    tree = DecisionTreeClassifier(maxDepth=1).fit(VectorAssembler(inputCols=["a"], outputCol="features").transform(full))
    best = certificates.split_gains(full, ["a"], "label", 3).orderBy(F.desc("gain")).first()
    assert best["at_most"] < tree._java_obj.rootNode().split().threshold() < best["at_most"] + 1


def test_mixture_shares_equal_the_model(spark):
    """Rows far from all centres, where plain densities vanish; a singular covariance; a null row."""
    points = [*RNG.normal(size=(150, 2)).tolist(), *(RNG.normal(size=(150, 2)) * 0.3 + 5).tolist(), [400.0, -400.0]]
    df = spark.createDataFrame([(p,) for p in points], "x array<double>")
    vectors = df.select("x", *[F.get("x", F.lit(i)).alias(f"x{i}") for i in range(2)], (F.get("x", F.lit(0)) * 2).alias("x2"))
    assembled = VectorAssembler(inputCols=["x0", "x1", "x2"], outputCol="features").transform(vectors)
    model = GaussianMixture(k=2, seed=3).fit(assembled.where("x0 < 100"))
    fitted = model.transform(assembled).select("prediction", vector_to_array("probability").alias("p"), vector_to_array("features").alias("f"))
    gaussians = model.gaussiansDF.collect()
    matrices = model.weights, [g["mean"].toArray() for g in gaussians], [g["cov"].toArray() for g in gaussians]
    for row in certificates.mixture_shares(fitted, "f", *matrices).collect():
        assert row["shares"] == pytest.approx(row["p"], abs=1e-9) and row["component"] == row["prediction"]
    none = certificates.mixture_shares(spark.createDataFrame([(None,)], "f array<double>"), "f", *matrices).first()
    assert none["shares"] is None and none["component"] is None


def test_merged_sketches_keep_their_rank_error(spark):
    """Two hundred sketches of unlike sizes, merged in steps; ranks against all values."""
    df = spark.range(60_000).select((F.col("id") * 7_919 % 60_013).cast("double").alias("v"), F.floor(F.sqrt("id")).alias("day"))
    stored = sketches.quantile_sketches(df, "v", ["day"], k=400)
    assert stored.count() == 245 and sketches.merged(stored).count() == 1
    values = np.sort([r["v"] for r in df.select("v").collect()])
    found = sketches.sketch_quantiles(stored, [0.01, 0.3333, 0.5, 0.99])
    for row in found.collect():
        share = np.searchsorted(values, row["value"], "right") / len(values)
        assert abs(share - row["p"]) <= sketches.rank_error(400)
    exact = ranking.exact_quantiles(df, "v", [0.5]).first()["value"]
    assert abs(np.searchsorted(values, exact) / len(values) - 0.5) < 1e-4


def test_sketch_store_reads_the_days_asked_for(spark, tmp_path):
    group = T.StructType([T.StructField("g", T.StringType())])
    store = sketches.SketchStore(spark, f"{tmp_path}/sketches", group)
    assert store.quantiles([0.5]).count() == 0
    for day in ("2024-01-01", "2024-01-02", "2024-02-01"):
        store.put(day, spark.range(10).select(F.when(F.col("id") < 5, "a").alias("g"), (F.col("id") + int(day[-4])).alias("v")), "v")
    store.put("2024-01-01", spark.createDataFrame([(None, None), ("a", 7)], "g string, v long"), "v")
    january = store.sketches("2024-01-01", "2024-01-31")
    assert "PartitionFilters: [isnotnull(day" in plan_of(january) and january.agg(F.sum("n")).first()[0] == 11
    assert rows(store.quantiles([0.0, 1.0], last="2024-01-01")) == [("a", 0.0, 7.0), ("a", 1.0, 7.0)]


def review_rows(spark, data):
    rows = [(i, None, text, None, None, (author, votes)) for i, author, text, votes in data]
    return spark.createDataFrame(rows, REVIEW_SCHEMA)


def test_author_stream_equals_batch_after_restarts(spark, tmp_path):
    folder, log, checkpoint = (f"{tmp_path}/{n}" for n in ("reviews", "log", "checkpoint"))
    parts = [
        [(1, "a", "four", 2), (2, None, "nobody", 9), (3, "b", None, None)],
        [(4, "a", "", None), (5, "hot", "x" * 1_000, 1)] + [(i, "hot", "text", i) for i in range(10, 200)],
        [(6, "b", "two words", 5), (7, "c", None, None)],
    ]
    whole = []
    for part in parts:
        review_rows(spark, part).coalesce(1).write.mode("append").parquet(folder)
        whole += part
        for _ in range(2):  # the second start finds nothing new
            author_stream.follow_authors(read_stream(spark, folder, REVIEW_SCHEMA), log, checkpoint).awaitTermination()
        found = author_stream.latest_features(author_stream.read_log(spark, log))
        assert rows(found) == rows(aggregates.user_features(review_rows(spark, whole)))
    batches = author_stream.read_log(spark, log)
    assert batches.select("batch").distinct().count() == 3
    assert batches.where("user_id = 'hot'").count() == 1  # unchanged authors are not written again
    author_stream.compact_log(spark, log, f"{tmp_path}/compact")
    compacted = author_stream.read_log(spark, f"{tmp_path}/compact")
    assert rows(author_stream.latest_features(compacted)) == rows(found) and compacted.count() == 4
    assert author_stream.latest_features(author_stream.read_log(spark, f"{tmp_path}/none")).count() == 0


def test_broken_lines_are_told_apart(spark, tmp_path):
    good = [{"id": 1, "text": "fine\nline", "ratings": {"rooms": 4.0}}, {"id": 2}, {}]
    broken = ['{"id": 3, "text": "cut', "[1, 2]", "no json", '{"id": "word"}', "null", '{"id": 4, "ratings": 7}']
    lines = [*map(json.dumps, good), "", " \t ", *broken]
    (tmp_path / "a.json").write_text("\n".join(lines))
    (tmp_path / "b.json").write_text(broken[0] + "\n")
    reviews, bad = read_review_lines(spark, str(tmp_path))
    assert reviews.schema == REVIEW_SCHEMA
    found = [r.asDict(recursive=True) for r in reviews.collect()]
    assert sorted((str(r["id"]), r["text"]) for r in found) == [("1", "fine\nline"), ("2", None), ("None", None)]
    assert next(r for r in found if r["id"] == 1)["ratings"]["rooms"] == 4.0
    assert sorted(r["line"] for r in bad.collect()) == sorted([*broken, broken[0]])
    assert {r["file"].rsplit("/", 1)[1]: r["n_broken"] for r in line_counts(bad).collect()} == {"a.json": 6, "b.json": 1}
    assert bad.select("file").count() == 7


def scanned_files(df):
    """Files that the first scan of the plan opens."""
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return leaf.metrics().apply("numFiles").value()


def test_lookup_opens_the_folders_of_its_keys(spark, tmp_path):
    plain = RunRegistry(spark, f"{tmp_path}/plain")
    puts = spark.range(5_000).select(
        F.concat(F.lit("key"), F.col("id") % 1_000).alias("row_key"), F.col("id").cast("double").alias("evaluation_score"), F.lit("T").alias("task_name"), F.col("id").alias("put_seq")
    )
    plain.put_frame(puts)
    compacted = plain.compact(f"{tmp_path}/folders", buckets=32)
    assert rows(compacted.read()) == rows(plain.read())
    wanted = spark.createDataFrame([("key5",), ("key77",), ("none",)], "row_key string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        one, whole = compacted.get(["key5"]), compacted.read()
        assert [r["evaluation_score"] for r in one.collect()] == [4_005.0]
        assert scanned_files(one) <= 2 and scanned_files(whole) >= 32
        assert rows(compacted.lookup(wanted)) == rows(plain.lookup(wanted))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    compacted.put([RunRecord("key5", "T", "M", utc_now(), evaluation_score=9.0)])
    assert compacted.get(["key5", "key6"]).where("row_key = 'key5'").first()["evaluation_score"] == 9.0
    assert compacted.get([]).count() == 0


def test_best_run_needs_one_score_type(spark, tmp_path):
    registry = RunRegistry(spark, f"{tmp_path}/registry")
    scores = [("a", 0.95, "WeightedF1"), ("b", 0.9, "AUC"), ("c", 0.4, None), ("d", 0.5, None)]
    registry.put([RunRecord(k, "T", "M", utc_now(), evaluation_score=s, score_type=t) for k, s, t in scores])
    assert {(r["row_key"], r["rank"]) for r in registry.leaderboard().collect()} == {("a", 1), ("b", 1), ("c", 2), ("d", 1)}
    assert registry.best_run("T", "AUC")["row_key"] == "b"
    with pytest.raises(LookupError, match="several score types"):
        registry.best_run("T")


class Waiting(LogisticRegression):
    """Waits for the other fit, so that both only end if they run at the same time."""

    def fit(self, dataset, params=None):
        self.barrier.wait(timeout=60)
        return super().fit(dataset, params)


def test_fits_run_at_the_same_time(spark):
    import threading

    df = spark.createDataFrame([(float(i % 2), float(i), i) for i in range(40)], "label double, a double, id long")
    frame = VectorAssembler(inputCols=["a"], outputCol="features").transform(df)
    barrier = threading.Barrier(2)
    estimators = {name: Waiting() for name in ("First", "Second")}
    for e in estimators.values():
        e.barrier = barrier
    job = experiments.run_experiments("t", "T", estimators, frame, frame, experiments.sentiment_score)
    assert [r.record.model_name for r in job.runs] == ["First", "Second"]
    alone = experiments.run_experiments("t", "T", {"First": LogisticRegression()}, frame, frame, experiments.sentiment_score, parallel=1)
    assert alone.runs[0].record.evaluation_score == job.runs[0].record.evaluation_score


def test_a_failed_fit_is_raised_and_empty_parts_have_no_score(spark, tmp_path):
    df = spark.createDataFrame([(float(i % 2), float(i)) for i in range(40)], "label double, a double")
    frame = VectorAssembler(inputCols=["a"], outputCol="features").transform(df)
    with pytest.raises(Exception, match="nothing"):
        experiments.run_experiments("t", "T", {"Good": LogisticRegression(), "Bad": LogisticRegression(featuresCol="nothing")}, frame, frame, experiments.sentiment_score)
    registry = RunRegistry(spark, f"{tmp_path}/registry")
    none = frame.where("a < 0")
    job = experiments.run_experiments("t", "T", {"Model": LogisticRegression()}, frame, none, experiments.sentiment_score, registry=registry)
    assert job.runs[0].record.evaluation_score is None and registry.leaderboard().count() == 0 and registry.read().count() == 1
